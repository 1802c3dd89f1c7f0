"""Compare a load's source with its target, day by day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rows_per_day(df: DataFrame, day: str = "transaction_date") -> DataFrame:
    """Exact row count per day. Counted from the table itself: counters kept by running tasks would count a
    task twice that is run again after an executor is lost."""
    return df.groupBy(day).agg(F.count(F.lit(1)).alias("rows"))


def reconcile(source: DataFrame, target: DataFrame, day: str = "transaction_date") -> DataFrame:
    """Per day: rows in the source, rows in the target, difference. Days on one side only are kept.

    Both sides are counted before the join, so it meets at most one row per day and side.
    """
    read = rows_per_day(source, day).withColumnRenamed("rows", "source_rows")
    kept = rows_per_day(target, day).withColumnRenamed("rows", "target_rows")
    zero = F.lit(0).cast("bigint")
    both = read.withColumnRenamed(day, "__day").join(kept, F.col("__day").eqNullSafe(F.col(day)), "full_outer")
    counted = both.select(
        F.coalesce("__day", day).alias(day),
        F.coalesce("source_rows", zero).alias("source_rows"),
        F.coalesce("target_rows", zero).alias("target_rows"),
    )
    return counted.withColumn("difference", F.col("source_rows") - F.col("target_rows"))
