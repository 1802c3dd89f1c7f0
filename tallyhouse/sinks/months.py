"""Facts laid out by month: fewer, larger partitions than days make, within declared bounds, and one partition for the rest.

Queries and loads name days. The months that a day condition can fall into are added to it, so that the scan opens no other
partition; a load of days rewrites the months of its days, each from its other days and the load.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators.load_filter import in_days, in_window
from tallyhouse.operators.quality import month_partition
from tallyhouse.rules import MONTH_PARTITIONS
from tallyhouse.sinks.tables import DAY

PART, DEFAULT = "month_part", "default"


@dataclass(frozen=True)
class MonthLayout:
    """A fact table by month: from the month of ``first`` up to, not including, ``end``; both are first days of a month."""

    path: str
    first: date = MONTH_PARTITIONS[0]
    end: date = MONTH_PARTITIONS[1]
    column: str = DAY

    def __post_init__(self) -> None:
        if self.first.day != 1 or self.end.day != 1 or self.end < self.first:
            raise ValueError(f"{self.first} and {self.end} are no bounds of months")

    def part(self) -> Column:
        """The partition of a row; rows without a day are in the default one."""
        return month_partition(F.col(self.column), self.first, self.end)

    def window(self, start: date, end: date) -> Column:
        """Days from ``start`` to ``end``, both included, and the partitions they can be in."""
        inside = F.col(PART).between(_label(max(start, self.first)), _label(min(end, self.end)))
        outside = start < self.first or end >= self.end
        return in_window(F.col(self.column), start, end) & (inside | (F.col(PART) == DEFAULT) if outside else inside)

    def days(self, days: Iterable[date]) -> Column:
        """The listed days, and the partitions they are in."""
        days = list(days)
        parts = {_label(d) if self.first <= d < self.end else DEFAULT for d in days}
        return in_days(F.col(self.column), days) & F.col(PART).isin(sorted(parts))


def _label(day: date) -> str:
    """As ``month_label`` gives it; labels of months are in the order of time, and below the default's name."""
    return f"{day:%Y_%m}"


def read_months(spark: SparkSession, layout: MonthLayout, schema: T.StructType) -> DataFrame:
    """The table with its partition column. ``schema`` is that of the rows without it."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(PART, T.StringType())])).parquet(layout.path)


def replace_days_in_months(df: DataFrame, layout: MonthLayout) -> list[str]:
    """The days in ``df`` take the place of those days in the table; the partitions that were rewritten.

    Rows without a day count as one more day. Other partitions are not read. ``df`` is read several times. One writer at a time:
    files are written aside and moved when the job commits, so the plan may read the same table.
    """
    spark, day = df.sparkSession, F.col(layout.column)
    new = df.withColumn(PART, layout.part())
    touched = sorted(r[0] for r in new.select(PART).distinct().collect())
    if not touched:
        return []
    rows = new
    try:
        stored = read_months(spark, layout, df.schema).where(F.col(PART).isin(touched))
        replaced = F.broadcast(df.select(day.alias("replaced__")).distinct())
        kept = stored.join(replaced, day.eqNullSafe(F.col("replaced__")), "left_anti")
        rows = kept.unionByName(new)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    rows.hint("rebalance", PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(layout.path)
    return touched
