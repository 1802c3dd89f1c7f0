"""Parquet tables: whole tables, stamped dimension loads, and facts replaced day by day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.sources.files import read_table

DAY = "transaction_date"


def append_table(df: DataFrame, path: str) -> None:
    """Add rows to a table."""
    df.write.mode("append").parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    """Replace a whole table. The plan of ``df`` must not read ``path``."""
    df.write.mode("overwrite").parquet(path)


def _replace_partitions(df: DataFrame, path: str, column: str) -> None:
    """Replace the partitions of ``column`` that occur in ``df`` and leave the others; no rows, no change."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)


def replace_days(df: DataFrame, path: str, column: str = DAY) -> None:
    """Idempotent fact load: the days in ``df`` take the place of those days in the table. One writer at a time.

    All days are written by one job. The rows are rebalanced on the day first: a small day becomes one file instead of
    one per task, and a day that holds much of the data is split over tasks.
    """
    _replace_partitions(df.hint("rebalance", column), path, column)


def append_load(df: DataFrame, path: str) -> None:
    """Add one stamped load of a dimension. Loading the same ``etl_date`` again replaces it, so a rerun adds nothing.

    A load has one stamp, so the tasks write their rows as they are, without a shuffle.
    """
    _replace_partitions(df, path, "etl_date")


def copy_without_day(spark: SparkSession, path: str, new_path: str, day: date, column: str = DAY) -> None:
    """A table without one day, as a new table. For plain paths; a catalog table drops the partition instead.

    The dropped day is not read. A task reads files of few days, so it writes few, and nothing is shuffled.
    """
    kept = read_table(spark, path).where(F.col(column) != F.lit(day))
    kept.write.mode("overwrite").partitionBy(column).parquet(new_path)


# --- partitioned tables of the session catalog ------------------------------------------------------------------------


def create_day_table(spark: SparkSession, table: str, schema, column: str = DAY) -> None:
    """An empty managed table partitioned by day, unless it is there."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({fields}) USING parquet PARTITIONED BY (`{column}`)")


def replace_table_days(df: DataFrame, table: str, column: str = DAY) -> None:
    """``replace_days`` for a catalog table."""
    spark = df.sparkSession
    rows = df.select(*spark.table(table).columns).hint("rebalance", column)
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} WITH ('partitionOverwriteMode' = 'dynamic') SELECT * FROM {{rows}}", rows=rows
    )


def drop_day(spark: SparkSession, table: str, day: date, column: str = DAY) -> None:
    """Drop one day; a day that is not there is no error. Touches that day's files only."""
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (`{column}` = DATE '{day.isoformat()}')")


def replace_day(df: DataFrame, table: str, day: date, column: str = DAY) -> None:
    """Set one day of a catalog table to the rows of that day in ``df``, also when there are none."""
    spark = df.sparkSession
    names = [c for c in spark.table(table).columns if c != column]
    rows = df.where(F.col(column) == F.lit(day)).select(*names)
    spark.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION (`{column}` = DATE '{day.isoformat()}') SELECT * FROM {{rows}}",
        rows=rows,
    )
