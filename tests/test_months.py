"""The month layout: day conditions open the months they can fall into, and a load of days rewrites only theirs."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tallyhouse.sinks.months import PART, MonthLayout, read_months, replace_days_in_months
from tests.conftest import plan_of, rows

SCHEMA = "id int, transaction_date date"
BOUNDS = date(2024, 1, 1), date(2025, 1, 1)


def facts(spark, values):
    return spark.createDataFrame(values, SCHEMA)


def stored(spark, layout):
    return read_months(spark, layout, facts(spark, []).schema)


@pytest.fixture
def layout(tmp_path):
    return MonthLayout(str(tmp_path / "facts"), *BOUNDS)


def test_loads_of_days_against_a_plain_dictionary(spark, layout):
    draw, want = random.Random(11), {}
    for load in range(4):
        days = [date(2023, 12, 20) + timedelta(draw.randrange(400)) for _ in range(12)] + [None]
        values = [(load * 100 + i, day) for i, day in enumerate(days)]
        for _, day in values:
            want[day] = []
        for i, day in values:
            want[day].append(i)
        replace_days_in_months(facts(spark, values), layout)
    held = stored(spark, layout).drop(PART)
    assert rows(held) == sorted([(i, day) for day, ids in want.items() for i in ids], key=repr)


@pytest.mark.parametrize(
    "start, end",
    [
        (date(2024, 2, 10), date(2024, 3, 5)), (date(2023, 1, 1), date(2024, 1, 1)), (date(2024, 12, 31), date(2025, 1, 1)),
        (date(2023, 12, 30), date(2023, 12, 31)), (date(2020, 1, 1), date(2030, 1, 1)), (date(2025, 2, 1), date(2025, 2, 1)),
    ],
)
def test_a_window_finds_the_days_that_the_day_condition_finds(spark, layout, start, end):
    values = [(i, date(2023, 12, 1) + timedelta(i)) for i in range(0, 460, 3)] + [(-1, None)]
    replace_days_in_months(facts(spark, values), layout)
    table = stored(spark, layout)
    listed = [day for _, day in values if day and start <= day <= end]
    plain = rows(table.where(F.col("transaction_date").between(F.lit(start), F.lit(end))))
    assert rows(table.where(layout.window(start, end))) == plain
    assert rows(table.where(layout.days(listed))) == plain


def test_the_scan_opens_only_the_months_of_the_window(spark, layout):
    replace_days_in_months(facts(spark, [(m, date(2024, m, 3)) for m in range(1, 13)] + [(0, date(2020, 1, 1))]), layout)
    read = stored(spark, layout).where(layout.window(date(2024, 3, 2), date(2024, 4, 1)))
    plan = plan_of(read)
    assert "PartitionFilters: [isnotnull(month_part" in plan and "2024_03" in plan and "2024_04" in plan
    assert {r["file"].split("month_part=")[1].split("/")[0] for r in read.select(F.input_file_name().alias("file")).collect()} == {"2024_03"}


def test_a_load_leaves_the_files_of_other_months(spark, layout):
    replace_days_in_months(facts(spark, [(1, date(2024, 1, 3)), (2, date(2024, 2, 3)), (3, date(2024, 2, 4))]), layout)
    before = set(stored(spark, layout).inputFiles())
    assert replace_days_in_months(facts(spark, [(9, date(2024, 2, 3))]), layout) == ["2024_02"]
    after = set(stored(spark, layout).inputFiles())
    assert {f for f in before if "2024_01" in f} == {f for f in after if "2024_01" in f}
    assert {r["id"] for r in stored(spark, layout).collect()} == {1, 3, 9}
    assert replace_days_in_months(facts(spark, []), layout) == []


def test_bounds_within_a_month_are_an_error():
    with pytest.raises(ValueError, match="no bounds of months"):
        MonthLayout("p", date(2024, 1, 2), date(2025, 1, 1))
