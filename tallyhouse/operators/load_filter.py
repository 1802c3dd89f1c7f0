"""Which days a load takes: a window or a list, and never a day before 1970."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIRST_DAY = date(1970, 1, 1)


def parse_days(text: str) -> list[date]:
    """``2024-04-14, 2024-04-17`` as dates; blanks are trimmed and empty entries ignored."""
    return sorted({date.fromisoformat(part.strip()) for part in text.split(",") if part.strip()})


def window_days(start: date, end: date) -> list[date]:
    """The days of an inclusive window, from 1970 on."""
    if end < start:
        raise ValueError(f"load window ends on {end}, before its start {start}")
    first = max(start, FIRST_DAY)
    return [first + timedelta(days=i) for i in range((end - first).days + 1)]


def in_window(day: Column, start: date, end: date) -> Column:
    """Inclusive window. An end before the start is an error."""
    if end < start:
        raise ValueError(f"load window ends on {end}, before its start {start}")
    return day.between(F.lit(max(start, FIRST_DAY)), F.lit(end))


def in_days(day: Column, days: Iterable[date]) -> Column:
    """One of the listed days."""
    wanted = [F.lit(d) for d in days if d >= FIRST_DAY]
    return day.isin(wanted) if wanted else F.lit(False)


def loadable(df: DataFrame, day: str = "transaction_date") -> DataFrame:
    """Rows that have a day, from 1970 on."""
    return df.where(F.col(day) >= F.lit(FIRST_DAY))


def rejected_days(df: DataFrame, day: str = "transaction_date") -> DataFrame:
    """Counts of the rows ``loadable`` leaves out, by reason."""
    return df.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(F.col(day).isNull()).alias("rows_without_day"),
        F.count_if(F.col(day) < F.lit(FIRST_DAY)).alias("rows_before_1970"),
    )
