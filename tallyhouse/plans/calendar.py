"""The date dimension, generated."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.scalars import day_id
from tallyhouse.plans.holidays import Rule, is_holiday


def days_between(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day, both ends included."""
    if end < start:
        raise ValueError(f"calendar ends on {end}, before its start {start}")
    return spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("calender"))


def days_covering(dates: DataFrame) -> DataFrame:
    """One row per day from the first to the last date of a one-column frame. The bounds are one aggregate row."""
    column = F.col(dates.columns[0])
    bounds = dates.agg(F.min(column).alias("first_day"), F.max(column).alias("last_day"))
    return bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("calender"))


def calendar_dim(
    days: DataFrame, holidays: DataFrame | None = None, rules: Sequence[Rule] = (), us_rules: Sequence[Rule] = ()
) -> DataFrame:
    """Date attributes for a frame of days (column ``calender``).

    ``holidays`` has the columns ``holiday`` (date, unique) and ``in_us`` (boolean). Days on which a rule falls are holidays
    too, those of ``us_rules`` in the US only and with the weekday on which one of a weekend is observed. ``day`` is the day of
    the month; ``day_in_week`` counts from Monday = 1 to Sunday = 7.
    """
    day = F.col("calender")
    monday_first = F.weekday(day) + 1
    if holidays is None:
        marked, listed, listed_in_us = days, F.lit(False), F.lit(False)
    else:
        marked = days.join(holidays, day == F.col("holiday"), "left")
        listed, listed_in_us = F.col("holiday").isNotNull(), F.coalesce("in_us", F.lit(False))
    by_rule, by_us_rule = is_holiday(day, rules), is_holiday(day, us_rules, observed=True)
    return marked.select(
        day_id(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.dayofmonth(day).alias("day"),
        F.date_format(day, "MMMM").alias("month"),
        F.date_format(day, "EEEE").alias("weekday"),
        F.weekofyear(day).alias("week_of_year"),
        (monday_first >= 6).alias("isweekend"),
        (listed | by_rule).alias("isholiday"),
        (listed_in_us | by_us_rule).alias("isholiday_in_us"),
        F.dayofyear(day).alias("day_in_year"),
        _day_in_quarter(day).alias("day_in_quarter"),
        F.dayofmonth(day).alias("day_in_month"),
        monday_first.alias("day_in_week"),
    )


def _day_in_quarter(day: Column) -> Column:
    return F.datediff(day, F.trunc(day, "quarter")) + 1
