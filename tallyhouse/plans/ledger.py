"""A ledger of day loads: which day was tried how often, how many rows it brought, and what went wrong.

Every attempt is one row of an append-only table, so nothing is ever rewritten and a lost driver loses the attempt under way
at most. A day is done when its latest attempt succeeded with rows; days that failed or were empty are tried again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER = "table_name string, day date, attempt int, outcome string, rows long, error string, at timestamp"
LOADED, EMPTY, FAILED = "loaded", "empty", "failed"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All attempts; none if there is no ledger yet."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def latest_attempts(ledger: DataFrame) -> DataFrame:
    """The latest attempt of each day of each table."""
    entry = F.max_by(F.struct("attempt", "outcome", "rows", "error", "at"), F.struct("attempt", "at")).alias("entry")
    return ledger.groupBy("table_name", "day").agg(entry).select("table_name", "day", "entry.*")


def days_to_load(spark: SparkSession, path: str, table: str, days: Iterable[date]) -> dict[date, int]:
    """The days that are not done, in order, with the number of their next attempt. One row for each asked day is collected."""
    asked = sorted(set(days))
    known = latest_attempts(read_ledger(spark, path).where((F.col("table_name") == table) & F.col("day").isin(asked)))
    state = {r["day"]: r for r in known.collect()}
    return {d: state[d]["attempt"] + 1 if d in state else 1 for d in asked if d not in state or state[d]["outcome"] != LOADED}


def load_open_days(
    spark: SparkSession, path: str, table: str, days: Iterable[date], load: Callable[[date], int]
) -> DataFrame:
    """Load the days that are not done, one by one, and write each attempt down; the latest attempts of all asked days.

    ``load`` takes a day and returns its rows. A day that fails does not stop the others. Prefer one load of all days where
    the source allows it; this is for sources that need to be asked day by day, and for the days such a load left.
    """
    days = list(days)
    for day, attempt in days_to_load(spark, path, table, days).items():
        try:
            rows, error = load(day), None
            outcome = LOADED if rows else EMPTY
        except Exception as problem:  # noqa: BLE001 - it is written down
            rows, error, outcome = None, str(problem)[:2000], FAILED
        entry = spark.createDataFrame([(table, day, attempt, outcome, rows, error)], LEDGER.rsplit(", ", 1)[0])
        entry.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(path)
    found = read_ledger(spark, path).where((F.col("table_name") == table) & F.col("day").isin(days))
    return latest_attempts(found)
