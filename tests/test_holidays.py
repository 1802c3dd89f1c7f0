"""Holidays by rule against dates worked out one by one in plain Python."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tallyhouse.plans import holidays
from tallyhouse.plans.calendar import calendar_dim, days_between

# Easter Sundays as published, with the earliest and latest dates and both exceptions (1954, 1981).
EASTER = {
    1818: (3, 22), 1943: (4, 25), 1954: (4, 18), 1961: (4, 2), 1981: (4, 19), 1995: (4, 16), 1996: (4, 7), 1999: (4, 4),
    2000: (4, 23), 2008: (3, 23), 2011: (4, 24), 2016: (3, 27), 2019: (4, 21), 2024: (3, 31), 2025: (4, 20), 2026: (4, 5),
    2030: (4, 21), 2038: (4, 25), 2049: (4, 18), 2076: (4, 19), 2285: (3, 22),
}


def federal(year):
    """Federal holidays of a year by going through its days."""

    def nth(month, weekday, n):
        found = [d for d in (date(year, month, 1) + timedelta(i) for i in range(31)) if d.month == month and d.weekday() == weekday]
        return found[n - 1 if n > 0 else n]

    days = [date(year, 1, 1), date(year, 7, 4), date(year, 11, 11), date(year, 12, 25), nth(2, 0, 3), nth(5, 0, -1), nth(9, 0, 1), nth(10, 0, 2), nth(11, 3, 4)]
    days += [nth(1, 0, 3)] if year >= 1986 else []
    return set(days + ([date(year, 6, 19)] if year >= 2021 else []))


def marked(spark, start, end, rules, observed=False):
    days = days_between(spark, start, end).where(holidays.is_holiday(F.col("calender"), rules, observed))
    return {r["calender"] for r in days.collect()}


def test_easter(spark):
    years = spark.createDataFrame([(y,) for y in EASTER], "y int")
    got = {r["y"]: (r["e"].month, r["e"].day) for r in years.select("y", holidays.easter(F.col("y")).alias("e")).collect()}
    assert got == EASTER


@pytest.mark.parametrize("observed", [False, True])
def test_federal_holidays_of_many_years(spark, observed):
    want = set().union(*[federal(y) for y in range(1984, 2032)])
    if observed:
        want |= {d - timedelta(1) for d in want if d.weekday() == 5} | {d + timedelta(1) for d in want if d.weekday() == 6}
    first, last = date(1985, 1, 1), date(2030, 12, 31)
    assert marked(spark, first, last, holidays.US_FEDERAL, observed) == {d for d in want if first <= d <= last}
    # 1 January 2011 was a Saturday: observed in the year before.
    assert (date(2010, 12, 31) in want) is observed


def test_days_around_easter(spark):
    got = marked(spark, date(2024, 1, 1), date(2024, 12, 31), holidays.SETTLEMENT)
    assert got == {date(2024, m, d) for m, d in ((1, 1), (3, 29), (4, 1), (5, 1), (12, 25), (12, 26))}
    pentecost = marked(spark, date(2008, 1, 1), date(2008, 12, 31), [holidays.FromEaster(49)])
    assert pentecost == {date(2008, 5, 11)}


def test_listed_days_and_rules_add_up(spark):
    listed = spark.createDataFrame([(date(2024, 1, 2), True), (date(2024, 1, 3), None)], "holiday date, in_us boolean")
    days = calendar_dim(days_between(spark, date(2024, 1, 1), date(2024, 1, 4)), listed, rules=[holidays.Fixed(1, 1)])
    got = {r["calender"].day: (r["isholiday"], r["isholiday_in_us"]) for r in days.collect()}
    assert got == {1: (True, False), 2: (True, True), 3: (True, False), 4: (False, False)}


def test_no_rules_and_no_date(spark):
    one = spark.createDataFrame([(None,)], "d date")
    assert one.select(holidays.is_holiday(F.col("d"), holidays.US_FEDERAL, True)).first()[0] is None
    assert marked(spark, date(2024, 1, 1), date(2024, 1, 3), []) == set()
