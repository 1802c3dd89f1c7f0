"""Column expressions shared by the jobs. All are built-in functions, so they stay inside generated code."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

TIME_PATTERN = r"^\d{2}:\d{2}:\d{2}$"


def try_cast(column: Column, data_type) -> Column:
    """Cast that turns a bad value into NULL."""
    return column.try_cast(data_type)


def day_id(day: Column) -> Column:
    """Partition id of a day, ``20240131``. From numbers, which costs half as much as a date format."""
    number = F.year(day) * 10_000 + F.month(day) * 100 + F.dayofmonth(day)
    return F.lpad(number.cast("string"), 8, "0")


def day_text(day: Column) -> Column:
    """A day as text, ``2024-01-31``."""
    return F.date_format(day, "yyyy-MM-dd")


def month_label(day: Column) -> Column:
    """Partition label of a month, ``2024_01``."""
    return F.date_format(day, "yyyy_MM")


def clock_text(moment: Column) -> Column:
    """Time of day as text, ``17:44:00``. A TIME read over JDBC arrives as a timestamp and needs this too."""
    return F.date_format(moment, "HH:mm:ss")


def moment(day: Column, clock: Column) -> Column:
    """Timestamp without zone from a date and an ``HH:mm:ss`` text; NULL when either is missing or malformed."""
    text = F.concat(day.cast("string"), F.lit(" "), clock)
    return F.when(clock.rlike(TIME_PATTERN), text.try_cast("timestamp_ntz"))


def padded_id(column: Column, width: int = 11) -> Column:
    """Id padded with zeros on the left. Longer ids stay whole (a bare ``lpad`` would cut them)."""
    text = column.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def age_years(birth: Column, as_of: date) -> Column:
    """Age as whole 365-day years, the definition the monthly mart reports."""
    return F.floor(F.datediff(F.lit(as_of), birth) / F.lit(365))


def stamp(as_of: date | None) -> Column:
    """Load date: the given day, or today."""
    return (F.current_date() if as_of is None else F.lit(as_of)).alias("etl_date")
