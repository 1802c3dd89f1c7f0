from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.load_filter import in_days, in_window, loadable, parse_days, rejected_days, window_days
from tallyhouse.operators.reconcile import reconcile
from tallyhouse.operators.snapshot import current_snapshot
from tallyhouse.plans.ledger import days_to_load, load_open_days, read_ledger
from tallyhouse.plans.pipeline import Warehouse, build_mart, load_dimension, load_transactions
from tallyhouse.session import scratch_path
from tallyhouse.sinks import tables as sink
from tallyhouse.sources.files import read_table
from tests import bank
from tests.conftest import rows

D1, D2, D3 = date(2024, 4, 14), date(2024, 4, 15), date(2024, 4, 16)


def facts(spark, *lines):
    return spark.createDataFrame(list(lines), "id string, transaction_date date, amount int")


def test_same_days_twice_give_the_same_table(spark, tmp_path):
    path = str(tmp_path / "t")
    df = facts(spark, ("a", D1, 1), ("b", D1, 2), ("c", D2, 3))
    sink.replace_days(df, path)
    once = rows(read_table(spark, path, df.schema))
    sink.replace_days(df, path)
    assert rows(read_table(spark, path, df.schema)) == once


def test_other_days_and_an_empty_load_leave_the_table_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    first = facts(spark, ("a", D1, 1), ("b", D2, 2))
    sink.replace_days(first, path)
    sink.replace_days(facts(spark, ("c", D2, 9), ("d", D3, 4)), path)
    expected = [("a", 1, D1), ("c", 9, D2), ("d", 4, D3)]
    assert rows(read_table(spark, path).select("id", "amount", "transaction_date")) == expected
    sink.replace_days(first.where("amount > 99"), path)
    assert rows(read_table(spark, path).select("id", "amount", "transaction_date")) == expected


def test_empty_load_into_a_new_table(spark, tmp_path):
    path = str(tmp_path / "t")
    df = facts(spark, ("a", D1, 1)).where("amount > 99")
    sink.replace_days(df, path)
    assert read_table(spark, path, df.schema).count() == 0


def test_a_day_that_holds_most_rows_is_written_by_several_tasks(spark, tmp_path, setting):
    setting("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    path = str(tmp_path / "t")
    days = F.when(F.col("id") % 10 < 9, F.lit(D1)).otherwise(F.lit(D2))
    df = spark.range(0, 200_000, 1, 8).select(F.sha2(F.col("id").cast("string"), 256).alias("v"), days.alias("transaction_date"))
    sink.replace_days(df, path)
    stored = read_table(spark, path)
    files = stored.select("transaction_date", F.input_file_name().alias("file")).distinct().groupBy("transaction_date")
    assert {r["transaction_date"]: r["count"] for r in files.count().collect()}[D1] > 1
    assert stored.count() == 200_000


def test_copy_without_day(spark, tmp_path):
    path, new = str(tmp_path / "t"), str(tmp_path / "n")
    sink.replace_days(facts(spark, ("a", D1, 1), ("b", D2, 2)), path)
    sink.copy_without_day(spark, path, new, D1)
    assert rows(read_table(spark, new).select("id")) == [("b",)]


@pytest.fixture
def day_table(spark):
    base = scratch_path(spark, "db")
    name = "d" + base[-10:]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{base}'")
    table = f"{name}.facts"
    sink.create_day_table(spark, table, facts(spark, ("a", D1, 1)).schema)
    yield table
    spark.sql(f"DROP DATABASE {name} CASCADE")


def stored(spark, table):
    return rows(spark.table(table).select("id", "amount", "transaction_date"))


def test_catalog_table_days(spark, day_table):
    sink.replace_table_days(facts(spark, ("a", D1, 1), ("b", D2, 2)), day_table)
    sink.replace_table_days(facts(spark, ("c", D2, 3)), day_table)
    assert stored(spark, day_table) == [("a", 1, D1), ("c", 3, D2)]
    sink.drop_day(spark, day_table, D1)
    sink.drop_day(spark, day_table, D1)
    assert stored(spark, day_table) == [("c", 3, D2)]
    sink.replace_day(facts(spark, ("x", D2, 7), ("y", D3, 8)), day_table, D2)
    assert stored(spark, day_table) == [("x", 7, D2)]
    sink.replace_day(facts(spark, ("y", D3, 8)), day_table, D2)
    assert stored(spark, day_table) == []


def test_failed_and_empty_days_alone_are_tried_again(spark, tmp_path):
    path, seen = str(tmp_path / "ledger"), []

    def load(day):
        seen.append(day)
        if day == D2 and seen.count(D2) == 1:
            raise RuntimeError("source is down")
        return 0 if day == D3 and seen.count(D3) < 3 else 5

    first = load_open_days(spark, path, "facts", [D3, D1, D2, D2], load)
    assert rows(first.select("day", "attempt", "outcome", "rows", "error")) == [
        (D1, 1, "loaded", 5, None), (D2, 1, "failed", None, "source is down"), (D3, 1, "empty", 0, None),
    ]
    load_open_days(spark, path, "facts", [D1, D2, D3], load)
    last = load_open_days(spark, path, "facts", [D1, D2, D3], load)
    assert seen == [D1, D2, D3, D2, D3, D3]
    assert rows(last.select("day", "attempt", "outcome")) == [(D1, 1, "loaded"), (D2, 2, "loaded"), (D3, 3, "loaded")]
    assert read_ledger(spark, path).count() == 6 and days_to_load(spark, path, "other", [D1]) == {D1: 1}


def test_omitted_columns_take_their_defaults_and_others_must_be_there(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"))
    types = spark.sql("SELECT '1' AS transaction_type_id, 'a' AS transaction_type_name, CAST(null AS boolean) AS is_income")
    load_dimension(types, "transaction_types", house, D1)
    assert rows(house.table("transaction_types")) == [("1", "a", False, None)]
    with pytest.raises(ValueError, match="does not match the contract: .*transaction_type_name: missing"):
        load_dimension(types.drop("transaction_type_name"), "transaction_types", house, D1)


def test_window_and_list(spark):
    df = facts(spark, ("a", D1, 1), ("b", D2, 1), ("c", D3, 1), ("d", date(1969, 12, 31), 1), ("e", None, 1))
    day = F.col("transaction_date")
    assert rows(df.where(in_window(day, D1, D2)).select("id")) == [("a",), ("b",)]
    assert rows(df.where(in_window(day, date(1960, 1, 1), D1)).select("id")) == [("a",)]
    assert rows(df.where(in_days(day, parse_days(" 2024-04-14,, 2024-04-16 "))).select("id")) == [("a",), ("c",)]
    assert df.where(in_days(day, [])).count() == 0
    assert window_days(D1, D3) == [D1, D2, D3]
    assert window_days(date(1969, 12, 30), date(1970, 1, 2)) == [date(1970, 1, 1), date(1970, 1, 2)]
    for build in (lambda: in_window(day, D2, D1), lambda: window_days(D2, D1)):
        with pytest.raises(ValueError):
            build()


def test_early_and_missing_days_are_rejected_and_counted(spark):
    df = facts(spark, ("a", D1, 1), ("d", date(1969, 12, 31), 1), ("e", None, 1))
    assert rows(loadable(df).select("id")) == [("a",)]
    assert rejected_days(df).first().asDict() == {"rows_read": 3, "rows_without_day": 1, "rows_before_1970": 1}


def test_reconcile_keeps_days_of_one_side_and_rows_without_day(spark):
    source = facts(spark, ("a", D1, 1), ("b", D1, 1), ("c", D2, 1), ("n", None, 1))
    target = facts(spark, ("a", D1, 1), ("z", D3, 1))
    found = {r["transaction_date"]: (r["source_rows"], r["target_rows"], r["difference"]) for r in reconcile(source, target).collect()}
    assert found == {D1: (2, 1, 1), D2: (1, 0, 1), D3: (0, 1, -1), None: (1, 0, 1)}


def test_snapshot_takes_the_latest_load(spark):
    df = spark.createDataFrame(
        [("1", "old", None, D1), ("1", "new", "x", D2), ("2", "only", None, D1), ("3", "a", None, D2), ("3", "b", None, D2)],
        "k string, v string, w string, etl_date date",
    )
    assert rows(current_snapshot(df, "k")) == [("1", "new", "x", D2), ("2", "only", None, D1), ("3", "b", None, D2)]


def test_warehouse_from_dimension_loads_to_mart(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path))
    people = [("c1", "retirees"), ("c2", "retirees")]
    for as_of in (D1, D1, D2):  # a rerun and a later load
        full = bank.customers(spark, people)
        for c in ("gender", "marital_status", "education_level", "employment_status", "job_title", "housing"):
            full = full.withColumn(c, F.lit("x"))
        for c in (
            "monthly_passive_income_usd", "monthly_rent_in_usd", "monthly_rent_out_usd", "annual_income",
            "monthly_salary_day", "bill_responsible", "bills_due_day", "is_renter", "rent_due_day", "credit_score",
            "num_dependents", "has_passive_income", "has_real_estate_income",
        ):
            full = full.withColumn(c, F.lit("1"))
        load_dimension(full, "customers", house, as_of)
        load_dimension(bank.merchants(spark), "merchants", house, as_of)
        load_dimension(bank.categories(spark), "categories", house, as_of)
    assert house.loads("customers").count() == 4
    assert house.table("customers").count() == 2
    source = bank.transactions(
        spark,
        [
            ("1", D1, "c1", "m1", "1", "10.00"),
            ("2", D2, "c2", "m1", "1", "5.00"),
            ("3", D3, "c2", "m1", "1", "5.00"),
            ("4", date(1969, 1, 1), "c2", "m1", "1", "5.00"),
        ],
    ).withColumn("transaction_time", F.lit("10:00:00"))
    for c in ("account_id", "branch_id", "channel_id", "currency"):
        source = source.withColumn(c, F.lit("1"))
    for c in ("is_recurring", "is_salary", "previous_balance"):
        source = source.withColumn(c, F.lit(None).cast("string"))
    source = source.withColumn("balance_after_transaction", F.lit("zz"))
    report = load_transactions(source, house, start=D1, end=D2, as_of=D3)
    assert rows(report.per_day) == [(D1, 1, 1, 0), (D2, 1, 1, 0)]
    outcomes = {(r["reason"], r["day"]): r["rows"] for r in report.report.outcomes().collect()}
    assert outcomes == {(None, D1): 1, (None, D2): 1, ("before 1970", date(1969, 1, 1)): 1}
    assert rows(report.report.lost_values()) == [("balance_after_transaction", 3)]
    assert rows(house.loads("rejected_transactions").select("transaction_id_dd", "reject_reason")) == [("4", "before 1970")]
    load_transactions(source, house, days=[D3], as_of=D3)
    assert house.table("transactions").count() == 3
    mart = build_mart("segment_category_amount", house.table, D3).collect()
    assert [(r["segment"], r["ATM"]) for r in mart] == [("retirees", D("20.00"))]
    assert house.has("customers") and not house.has("channels")
    with pytest.raises(ValueError):
        load_transactions(source, house)
    with pytest.raises(ValueError):
        load_dimension(source, "transactions", house)


def test_scratch_needs_a_shared_folder_on_a_cluster(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
