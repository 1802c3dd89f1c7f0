from datetime import date, datetime, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions import scalars
from tallyhouse.operators import quality
from tallyhouse.operators.readback import first_rows
from tallyhouse.plans import legacy
from tallyhouse.plans.audit import audit
from tallyhouse.plans.calendar import calendar_dim, days_between, days_covering
from tests.conftest import plan_of, rows


def test_calendar_against_python(spark):
    start, end = date(2023, 12, 25), date(2025, 1, 7)
    found = calendar_dim(days_between(spark, start, end)).orderBy("calender").collect()
    assert len(found) == (end - start).days + 1
    for i, row in enumerate(found):
        d = start + timedelta(days=i)
        quarter = (d.month - 1) // 3
        first = date(d.year, 3 * quarter + 1, 1)
        assert row["calender"] == d and row["date_key"] == d.strftime("%Y%m%d")
        assert (row["year"], row["quarter"], row["day"]) == (d.year, quarter + 1, d.day)
        assert (row["month"], row["weekday"]) == (d.strftime("%B"), d.strftime("%A"))
        assert row["week_of_year"] == d.isocalendar().week
        assert row["isweekend"] == (d.isoweekday() >= 6)
        assert (row["day_in_year"], row["day_in_quarter"]) == (d.timetuple().tm_yday, (d - first).days + 1)
        assert (row["day_in_month"], row["day_in_week"]) == (d.day, d.isoweekday())
        assert row["isholiday"] is False and row["isholiday_in_us"] is False


def test_calendar_holidays_and_bounds(spark):
    holidays = spark.sql("SELECT * FROM VALUES (DATE '2024-01-01', true), (DATE '2024-04-23', false) AS t(holiday, in_us)")
    df = calendar_dim(days_covering(spark.sql("SELECT * FROM VALUES (DATE '2024-01-01'), (DATE '2024-04-24') AS t(d)")), holidays)
    assert df.count() == 115
    marked = rows(df.where("isholiday").select("date_key", "isholiday_in_us"))
    assert marked == [("20240101", True), ("20240423", False)]
    with pytest.raises(ValueError):
        days_between(spark, date(2024, 1, 2), date(2024, 1, 1))


def test_moment_needs_date_and_time(spark):
    df = spark.sql("""
        SELECT * FROM VALUES (DATE '2024-01-05', '17:44:00'), (null, '17:44:00'), (DATE '2024-01-05', null),
          (DATE '2024-01-05', '25:00:00'), (DATE '2024-01-05', '17:44')
        AS t(d, c)
    """)
    got = [r[0] for r in df.select(scalars.moment(F.col("d"), F.col("c"))).collect()]
    assert got == [datetime(2024, 1, 5, 17, 44), None, None, None, None]


def test_small_functions(spark):
    df = spark.sql("SELECT DATE '2024-02-09' AS d, '123' AS i, '123456789012' AS long_id")
    got = df.select(
        scalars.day_id(F.col("d")),
        scalars.month_label(F.col("d")),
        scalars.day_text(F.col("d")),
        scalars.padded_id(F.col("i")),
        scalars.padded_id(F.col("long_id")),
        scalars.age_years(F.col("d"), date(2026, 2, 7)),
        scalars.age_years(F.col("d"), date(2026, 2, 8)),
    ).first()
    assert tuple(got) == ("20240209", "2024_02", "2024-02-09", "00000000123", "123456789012", 1, 2)


LEGACY = "transaction_id string, account_number string, customer_id string, transaction_date string, transaction_time string, transaction_amount string, transaction_type string, category string, location string, channel string"


def legacy_raw(spark):
    return spark.createDataFrame(
        [
            ("7", "A1", "C1", "2025-05-18", "09:30:00", "10.50", "debit", "gas", "Ankara", "POS"),
            ("8", "A1", "C1", "2025-05-18", "10:30:00", "1.25", "credit", "gas", None, "POS"),
            ("9", "A1", "C1", "2025-13-18", "10:30:00", "zz", "debit", None, None, None),
        ],
        LEGACY,
    )


def test_legacy_chain(spark):
    clean = legacy.clean_raw(legacy_raw(spark))
    assert [r["transaction_id"] for r in clean.orderBy("transaction_id").collect()] == ["00000000007", "00000000008", "00000000009"]
    fact = legacy.fact_with_moment(clean)
    assert fact.columns == ["transaction_id", "account_number", "customer_id", "ts", "amount", "type", "category", "location", "channel"]
    assert rows(legacy.daily_account_totals(fact)) == [("A1", "2025-05-18", 2, D("11.75")), ("A1", None, 1, None)]
    text = legacy.fact_with_day_text(clean)
    assert rows(text.select("transaction_date", "amount")) == [("2025-05-18", D("1.25")), ("2025-05-18", D("10.50")), (None, None)]


def test_legacy_layouts_give_the_same_fact(spark):
    apart = legacy.clean_raw(legacy_raw(spark))
    ready = legacy.fact_with_moment(apart)
    again = legacy.fact_with_moment(ready)
    assert rows(again) == rows(ready)


def test_primary_keys(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', 1), ('a', 1), ('b', 1), (null, 1), ('c', null) AS t(k, j)")
    assert rows(quality.pk_violations(df, ["k"])) == [("a", 2), (None, 1)]
    assert rows(quality.pk_violations(df, ["k", "j"])) == [("a", 1, 2), ("c", None, 1), (None, 1, 1)]


def test_foreign_keys(spark):
    child = spark.sql("SELECT * FROM VALUES ('a'), ('x'), ('x'), ('y'), (null) AS t(f)")
    parent = spark.sql("SELECT * FROM VALUES ('a'), ('b'), (null) AS t(k)")
    found = quality.fk_violations(child, "f", parent, "k", "rule")
    assert rows(found) == [("rule", "x", 2), ("rule", "y", 1)]
    assert rows(quality.fk_summary([found])) == [("rule", 2, 3)]


def test_null_profile_defaults_lengths_precision(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 'abcd', 123.456D), (2, null, null), (3, 'ab', 9.99D) AS t(id, name, amount)")
    assert rows(quality.null_profile(df)) == [("amount", 3, 1), ("id", 3, 0), ("name", 3, 1)]
    filled = quality.default_fill(df, {"amount": 0, "is_salary": False})
    assert rows(filled.select("id", "amount", "is_salary")) == [(1, 123.456, False), (2, 0.0, False), (3, 9.99, False)]
    assert rows(quality.length_violations(df, ["id"], {"name": 3})) == [(1, "name", 3, 4)]
    assert rows(quality.precision_violations(df, ["id"], {"amount": (4, 2)})) == [(1, "amount", "decimal(4,2)")]


def test_month_partition_upper_bound_is_exclusive(spark):
    df = spark.sql("SELECT explode(array(DATE '2022-12-31', DATE '2023-01-01', DATE '2026-12-31', DATE '2027-01-01', null)) AS d")
    label = quality.month_partition(F.col("d"), date(2023, 1, 1), date(2027, 1, 1))
    assert [r[0] for r in df.select(label).collect()] == ["default", "2023_01", "2026_12", "default", "default"]


def test_audit_reports_every_rule_with_its_count(spark):
    tables = {
        "cities": spark.sql("SELECT 1 AS city_id, 'Ankara' AS city_name, 'TR' AS country, true AS is_capital"),
        "branches": spark.sql("""
            SELECT * FROM VALUES (1, 'A', 1, DATE '2020-01-01'), (1, null, 9, null)
            AS t(branch_id, branch_name, city_id, branch_start_date)
        """),
    }
    found = {(r["rule"], r["table_name"], r["column_name"]): r["violations"] for r in audit(tables).collect()}
    assert found[("primary_key", "branches", "branch_id")] == 1
    assert found[("foreign_key", "branches", "city_id")] == 1
    assert found[("not_null", "branches", "branch_name")] == 1
    assert found[("not_null", "branches", "branch_start_date")] == 1
    assert found[("max_length", "branches", "branch_name")] == 0
    assert found[("primary_key", "cities", "city_id")] == 0
    with pytest.raises(ValueError):
        audit({"unknown": tables["cities"]})


def test_first_rows_breaks_ties_and_plans_a_top_n(spark):
    df = spark.sql("SELECT * FROM VALUES ('10', 'b'), ('2', 'z'), ('10', 'a'), ('3', 'q') AS t(k, v)")
    top = first_rows(df, ["k"], 3)
    assert [tuple(r) for r in top.collect()] == [("10", "a"), ("10", "b"), ("2", "z")]
    assert "TakeOrderedAndProject" in plan_of(top)


def test_daily_totals_keep_the_day_without_a_time(spark):
    columns = "transaction_id string, account_number string, customer_id string, transaction_date date, transaction_amount decimal(12,2), transaction_type string, category string, location string, channel string"
    source = spark.createDataFrame([], columns)
    day = F.lit("2025-05-18").cast("date")
    row = [F.lit("1").alias("transaction_id"), F.lit("A1").alias("account_number"), F.lit("C").alias("customer_id"), day.alias("transaction_date")]
    rest = [F.lit("1.00").cast("decimal(12,2)").alias("transaction_amount"), *[F.lit("x").alias(c) for c in source.columns[5:]]]
    one = spark.range(1)
    for time, ts in ((F.lit(None).cast("string"), None), (F.lit("9:05:00"), "2025-05-18 09:05:00"), (F.to_timestamp(F.lit("1970-01-01 17:44:00")), "2025-05-18 17:44:00")):
        fact = legacy.fact_with_moment(one.select(*row, time.alias("transaction_time"), *rest), with_day=True)
        found = fact.first()["ts"]
        assert (str(found) if found else None) == ts
        assert rows(legacy.daily_account_totals(fact)) == [("A1", "2025-05-18", 1, D("1.00"))]


def test_rows_of_merged_layouts_take_the_name_they_have_a_value_for(spark, tmp_path):
    text = "CAST(null AS string) AS category, CAST(null AS string) AS location, CAST(null AS string) AS channel"
    folder = str(tmp_path / "layouts")
    spark.sql(f"SELECT '1' AS transaction_id, 'A1' AS account_number, 'C1' AS customer_id, TIMESTAMP_NTZ '2025-05-18 10:00:00' AS ts, '1.5' AS amount, 'debit' AS type, {text}").write.parquet(folder)
    older = spark.sql(f"SELECT '2' AS transaction_id, 'A1' AS account_number, 'C1' AS customer_id, DATE '2025-05-19' AS transaction_date, '9:05:00' AS transaction_time, '2.5' AS transaction_amount, 'credit' AS transaction_type, {text}")
    older.write.mode("append").parquet(folder)
    fact = legacy.fact_with_moment(legacy.read_layouts(spark, folder), with_day=True)
    assert rows(fact.select("transaction_id", "amount", "type", F.col("ts").cast("string"), "day")) == [
        ("1", D("1.50"), "debit", "2025-05-18 10:00:00", "2025-05-18"),
        ("2", D("2.50"), "credit", "2025-05-19 09:05:00", "2025-05-19"),
    ]
    with pytest.raises(ValueError, match="amount or transaction_amount"):
        legacy.fact_with_moment(older.drop("transaction_amount"))
