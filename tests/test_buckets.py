"""Facts and dimensions in buckets: no shuffle below the join, frequent keys and missing keys apart."""

from datetime import date

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from tallyhouse.plans import colocated, marts
from tallyhouse.sinks import buckets
from tallyhouse.sources.files import read_table
from tallyhouse.stand_in import queries
from tests import bank
from tests.conftest import plan_of, rows

CALENDAR = [("20240105", "January"), ("20240210", "February")]
AS_OF = date(2024, 3, 1)
BUCKETS = 4


@pytest.fixture
def tables(spark):
    """A third of the facts belongs to c0 and some to no customer; one customer is unknown."""
    lines = []
    for i in range(60):
        customer = "c0" if i % 3 == 0 else None if i % 10 == 1 else f"c{i}"
        day = date(2024, 1, 5) if i % 2 else date(2024, 2, 10)
        lines.append((f"t{i}", day, customer, "m1", "4" if i % 7 == 0 else "1", str(i)))
    customers = [(f"c{i}", "A") for i in range(60) if i != 2]
    return {
        "transactions": bank.transactions(spark, lines),
        "customers": bank.customers(spark, customers),
        "calender": spark.createDataFrame(CALENDAR, "date_key string, month string"),
        "transaction_types": bank.types(spark),
    }


def test_a_mart_from_buckets_is_the_mart(spark, tables, tmp_path):
    colocated.store_buckets(tables.__getitem__, str(tmp_path), "customer_monthly", BUCKETS)
    got = colocated.build_from_buckets(spark, tables.__getitem__, str(tmp_path), "customer_monthly", AS_OF, BUCKETS)
    want = marts.customer_monthly(tables["transactions"], tables["calender"], tables["transaction_types"], tables["customers"], AS_OF)
    assert rows(got) == rows(want)


def test_frequent_keys_and_rows_without_a_key_lie_apart(spark, tables, tmp_path):
    facts = tables["transactions"]
    buckets.write_facts(facts, f"{tmp_path}/facts", "customer_id", BUCKETS)
    stored = buckets.read_facts(spark, f"{tmp_path}/facts", "customer_id", BUCKETS)
    assert rows(stored.keys) == [("c0",)]
    assert {r["customer_id"] for r in stored.frequent.collect()} == {"c0", None}
    assert not stored.even.where("customer_id = 'c0' or customer_id is null").count()
    assert rows(stored.even.unionByName(stored.frequent)) == rows(facts)


def test_fewer_frequent_keys_than_buckets(spark):
    keys = spark.range(1000).select((F.col("id") % 7).alias("k"))
    assert buckets.frequent_keys(keys, "k", 4).count() == 0
    assert buckets.frequent_keys(keys, "k", 8).count() == 7
    assert buckets.frequent_keys(keys.where("false"), "k", 8).count() == 0


def test_no_exchange_below_join_and_aggregate(spark, tables, tmp_path, setting):
    # Local relations are broadcast, files are not.
    setting("spark.sql.autoBroadcastJoinThreshold", "0")
    buckets.write_facts(tables["transactions"], f"{tmp_path}/facts", "customer_id", BUCKETS)
    buckets.write_bucketed(tables["customers"], f"{tmp_path}/customers", "customer_id", BUCKETS)
    facts = buckets.read_facts(spark, f"{tmp_path}/facts", "customer_id", BUCKETS)
    customers = buckets.read_bucketed(spark, f"{tmp_path}/customers", "customer_id", BUCKETS)
    summed = facts.even.groupBy("customer_id").agg(F.sum("amount").alias("amount"))
    plan = plan_of(summed.join(customers, "customer_id", "left"))
    assert "SortMergeJoin" in plan
    assert "Exchange" not in plan


def test_the_wide_mart_joins_the_bucketed_accounts_before_the_other_dimensions_shuffle(spark, setting):
    # Between the size of the branches, which hang on the accounts, and that of the accounts.
    setting("spark.sql.autoBroadcastJoinThreshold", "5000")
    plan = plan_of(queries.bucketed_star(spark, "/root/testdata/sf0.001"))
    joins = [line for line in plan.splitlines() if "SortMergeJoin [transaction_account_id#" in line]
    assert joins and "hashpartitioning(transaction_account_id#" not in plan


def test_another_session_learns_of_the_buckets(spark, tables, tmp_path):
    path = f"{tmp_path}/customers"
    buckets.write_bucketed(tables["customers"], path, "customer_id", BUCKETS)
    name = buckets._table_of(path)
    spark.sql(f"DROP TABLE {name}")
    again = buckets.read_bucketed(spark, path, "customer_id", BUCKETS)
    assert rows(again) == rows(tables["customers"])
    assert "Num Buckets" in "".join(r["col_name"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect())


def test_an_empty_table(spark, tables, tmp_path):
    tables["transactions"] = tables["transactions"].where("false")
    colocated.store_buckets(tables.__getitem__, str(tmp_path), "customer_monthly", BUCKETS)
    got = colocated.build_from_buckets(spark, tables.__getitem__, str(tmp_path), "customer_monthly", AS_OF, BUCKETS)
    assert rows(got) == []


def test_the_number_of_buckets_follows_the_rows(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(buckets, "ROWS_PER_BUCKET", 6)
    colocated.store_buckets(tables.__getitem__, str(tmp_path), "customer_monthly", BUCKETS)
    assert not (tmp_path / "transactions__by_customer_id_4").exists()
    even = spark.read.parquet(f"{tmp_path}/transactions__by_customer_id_16/even")
    assert even.groupBy(F.input_file_name()).count().count() > BUCKETS
    got = colocated.build_from_buckets(spark, tables.__getitem__, str(tmp_path), "customer_monthly", AS_OF, BUCKETS)
    want = marts.customer_monthly(tables["transactions"], tables["calender"], tables["transaction_types"], tables["customers"], AS_OF)
    assert rows(got) == rows(want)


def test_a_copy_without_a_note_has_the_buckets_asked_for(spark, tables, tmp_path):
    fact_path, dim_path = colocated._places(str(tmp_path), "customer_id", "customers", BUCKETS)
    buckets.write_facts(tables["transactions"], fact_path, "customer_id", BUCKETS)
    buckets.write_bucketed(tables["customers"], dim_path, "customer_id", BUCKETS)
    got = colocated.build_from_buckets(spark, tables.__getitem__, str(tmp_path), "customer_monthly", AS_OF, BUCKETS)
    want = marts.customer_monthly(tables["transactions"], tables["calender"], tables["transaction_types"], tables["customers"], AS_OF)
    assert rows(got) == rows(want)


def test_the_count_of_all_keys_is_not_drawn_into_one_task(spark, tmp_path, monkeypatch):
    task = F.udf(lambda _: str(TaskContext.get().taskAttemptId()), "string")
    monkeypatch.setattr(buckets, "frequent_keys", lambda df, key, n: spark.range(0, 8, 1, 8).select(task("id").alias(key)))
    buckets.write_facts(spark.createDataFrame([("a",)], "k string"), f"{tmp_path}/facts", "k", BUCKETS)
    assert spark.read.parquet(f"{tmp_path}/facts/keys").distinct().count() == 8


def test_the_wide_mart_from_more_buckets_than_were_asked_for(spark, tables, tmp_path, monkeypatch):
    monkeypatch.setattr(buckets, "ROWS_PER_BUCKET", 300)
    asked = []
    store = colocated.store_buckets
    monkeypatch.setattr(colocated, "store_buckets", lambda table, folder, mart, **options: asked.append(folder) or store(table, folder, mart, **options))
    got = queries.bucketed_star(spark, "/root/testdata/sf0.001")
    assert rows(got) == rows(queries.wide_expense_transactions(spark, "/root/testdata/sf0.001"))
    assert rows(read_table(spark, f"{asked[0]}/buckets__by_account_id_16")) == [(32,)]
