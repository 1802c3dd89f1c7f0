"""What the plans must look like at scale: filters and columns at the scan, no needless shuffle, no cross join."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators.load_filter import in_window
from tallyhouse.sinks import tables as sink
from tallyhouse.sources.files import read_table
from tallyhouse.stand_in import queries, tables
from tests.conftest import plan_of

SF_DIR = "/root/testdata/sf0.001"
LAZY = (
    "customer_monthly",
    "segment_category_amount",
    "count_category_segment",
    "is_essential_avg",
    "wide_expense_transactions",
    "daily_account_agg",
    "pk_violations",
    "fk_violations",
    "month_partition_assign",
    "integrity_audit",
)


def shuffles(plan):
    return len(re.findall(r"[- ]Exchange ", plan))


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(queries.queries()[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "MapInPandas"):
        assert operator not in plan


def test_monthly_mart_shuffles_once(spark):
    plan = plan_of(queries.customer_monthly(spark, SF_DIR))
    assert shuffles(plan) == 1
    assert "l_comment" not in plan and "l_tax" not in plan


def test_unknown_types_are_dropped_by_an_inner_join(spark):
    assert "Inner, BuildRight" in plan_of(queries.customer_monthly(spark, SF_DIR))


def test_customers_join_uses_the_partitioning_of_the_aggregate(spark, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    transactions = tables.transactions(spark, SF_DIR).select("customer_id", "amount")
    per_customer = transactions.groupBy("customer_id").agg(F.sum("amount"))
    alone = shuffles(plan_of(per_customer))
    joined = per_customer.join(tables.customers(spark, SF_DIR), "customer_id", "left")
    assert shuffles(plan_of(joined)) == alone + 1


def test_window_reaches_the_scan(spark):
    plan = plan_of(tables.transactions(spark, SF_DIR, with_customer=False, shipped=queries.WINDOW))
    assert "GreaterThanOrEqual(l_shipdate" in plan and "LessThan(l_shipdate" in plan


def test_days_are_pruned_as_partitions(spark, tmp_path):
    rows = tables.transactions(spark, SF_DIR, with_customer=False)
    month = rows.where(in_window(F.col("transaction_date"), date(1996, 1, 1), date(1996, 1, 31)))
    sink.replace_days(month, str(tmp_path / "t"))
    stored = read_table(spark, str(tmp_path / "t"), rows.schema)
    plan = plan_of(stored.where(in_window(F.col("transaction_date"), date(1996, 1, 1), date(1996, 1, 2))))
    assert re.search(r"PartitionFilters: \[.*transaction_date", plan)


def test_key_check_reads_key_columns_only(spark):
    plan = plan_of(queries.pk_violations(spark, SF_DIR))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in plan
    assert shuffles(plan) == 1
