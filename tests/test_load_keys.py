"""Keys of a load against stored days and parents: planted repeats are found, whatever the filter lets pass."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import load_keys
from tallyhouse.plans.pipeline import KeysRejected, Warehouse, load_transactions
from tallyhouse.schemas import TRANSACTIONS
from tests.conftest import plan_of, rows

DAY1, DAY2, DAY3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)
SCHEMA = "id string, merchant string, transaction_date date"


def facts(spark, values):
    return spark.createDataFrame(values, SCHEMA)


def whole_rows(spark, values):
    """(id, day) -> rows with every column of the fact table."""
    given = {"transaction_id_dd", "transaction_date"}
    texts = {"account_id", "customer_id", "channel_id", "transaction_type_id", "currency"}
    rest = [F.lit("x" if f.name in texts else "1" if f.name == "amount" else None).cast(f.dataType).alias(f.name) for f in TRANSACTIONS.fields if f.name not in given | {"is_recurring", "is_salary"}]
    return spark.createDataFrame(values, "transaction_id_dd string, transaction_date date").select("*", *rest)


def test_repeats_across_days_and_within_the_load(spark):
    stored = facts(spark, [("a", "m", DAY1), ("b", "m", DAY1), ("c", "m", DAY2), (None, "m", DAY1)])
    # c is on a day that the load replaces, so it is no repeat; a is, and d is there twice.
    load = facts(spark, [("a", "m", DAY2), ("c", "m", DAY2), ("d", "x", DAY3), ("d", None, DAY3), (None, "m", DAY2)])
    merchants = spark.createDataFrame([("m",), (None,)], "merchant_id string")
    found = load_keys.check_keys(
        load, stored, "id", "transaction_date", [("merchant", "merchants", "merchant_id"), ("id", "absent", "id")],
        {"merchants": merchants}, ["id", "merchant", "transaction_date"], bitmaps=4,
    )
    assert rows(found) == [
        ("held by another day", "id", "a", 1), ("missing", "id", None, 1), ("missing", "merchant", None, 1),
        ("no parent", "merchant", "x", 1), ("repeated in the load", "id", "d", 2),
    ]


@pytest.mark.parametrize("bitmaps", [1, 16])
def test_the_filter_loses_no_key(spark, bitmaps):
    """Also where it is much too small: with one bitmap for 20,000 keys almost every row passes, and the result is the same."""
    draw = random.Random(5)
    old = {f"k{draw.randrange(60_000)}" for _ in range(20_000)}
    new = {f"k{draw.randrange(60_000)}" for _ in range(20_000)}
    stored = facts(spark, [(k, "m", DAY1) for k in old])
    load = facts(spark, [(k, "m", DAY2) for k in new])
    found = load_keys.held_by_other_days(load, stored, "id", "transaction_date", bitmaps)
    assert {r["id"] for r in found.collect()} == old & new
    orphans = load_keys.without_parent(load, "id", stored, "id", bitmaps)
    assert {r["id"] for r in orphans.collect()} == new - old


def test_few_rows_pass_a_filter_of_the_right_size(spark):
    load = spark.range(10_000).select(F.concat(F.lit("new-"), "id").alias("id"))
    stored = spark.range(200_000).select(F.concat(F.lit("old-"), "id").alias("id"))
    hits = load_keys.possible_hits(stored, "id", load_keys.key_filter(load, "id", 16), 16)
    assert hits.count() < 2_000
    assert load_keys.key_filter(load, "id", 16).count() <= 16


def test_the_stored_rows_are_filtered_before_they_are_shuffled(spark, tmp_path, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "0")
    facts(spark, [("a", "m", DAY1)]).write.partitionBy("transaction_date").parquet(f"{tmp_path}/facts")
    stored = spark.read.parquet(f"{tmp_path}/facts")
    load = facts(spark, [("a", "m", DAY2)])
    plan = plan_of(load_keys.held_by_other_days(load, stored, "id", "transaction_date"))
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "ReadSchema: struct<id:string>" in scan
    # From the scan upwards the broadcast join with the bitmaps comes first, then the exchange of what is left.
    above = plan.splitlines()[: plan.splitlines().index(scan)]
    hashed = max(i for i, line in enumerate(above) if "hashpartitioning(held__" in line)
    assert any("bitmap_no__" in line and "BroadcastHashJoin" in line for line in above[hashed:])


def test_wrong_number_of_bitmaps(spark):
    with pytest.raises(ValueError, match="power of two"):
        load_keys.key_filter(facts(spark, []), "id", 3)


def test_empty_load_and_empty_table(spark):
    nothing, some = facts(spark, []), facts(spark, [("a", "m", DAY1)])
    assert rows(load_keys.check_keys(nothing, some, "id", "transaction_date", not_null=["id"])) == []
    assert rows(load_keys.check_keys(some, nothing, "id", "transaction_date")) == []
    assert rows(load_keys.check_keys(some, None, "id", "transaction_date")) == []


def test_a_checked_load_changes_nothing_if_it_is_rejected(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    first = whole_rows(spark, [("t1", DAY1), ("t2", DAY1)])
    load_transactions(first, house, days=[DAY1], checked=True)
    with pytest.raises(KeysRejected, match="held by another day"):
        load_transactions(whole_rows(spark, [("t2", DAY2), ("t3", DAY2)]), house, days=[DAY2], checked=True)
    assert house.loads("transactions").count() == 2
    assert rows(house.loads("violations_transactions").select("rule", "value")) == [("held by another day", "t2")]
    # The same day again is a replacement.
    load_transactions(first, house, days=[DAY1], checked=True)
    assert house.loads("transactions").count() == 2
