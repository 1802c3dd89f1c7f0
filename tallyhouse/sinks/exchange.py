"""Staged day loads: days are written beside a catalog table, checked there, and then exchanged partition by partition.

A load writes all its days to a folder of its own by one job. Nothing of the table changes until the load has passed its
check. Then its plan is written down, and each day's partition is pointed to the load's folder, which moves no file: a
reader sees a day as it was or as it is, never half of it, and a query that began before goes on with the files it knows.
A driver that is lost between two days leaves the plan; ``finish_exchanges`` carries it on.

One load at a time. Older versions of a day stay in their folders until ``remove_old_loads`` takes them away by age.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.reconcile import reconcile
from tallyhouse.sinks.tables import DAY

#: Partitions added by one statement.
ADDED_AT_ONCE = 200
PLAN = "table_name string, column_name string, day string, location string, rows long"


class LoadRejected(ValueError):
    """A staged load did not pass its check; the table is as it was."""


@dataclass(frozen=True)
class Staged:
    """A load that lies beside its table."""

    table: str
    load: str
    folder: str
    column: str

    @property
    def path(self) -> str:
        return f"{self.folder}/loads/{self.load}"


def exchange_folder(spark: SparkSession, table: str) -> str:
    """Where the loads and plans of a table lie: beside the table's own folder."""
    about = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()
    return f"{about['data_type'].rstrip('/')}__exchange"


def stage_days(df: DataFrame, table: str, column: str = DAY) -> Staged:
    """Write the rows of a load beside the table, all days by one job. A row without a day is an error before anything changes.

    The rows are rebalanced by day, as in ``replace_days``.
    """
    spark = df.sparkSession
    staged = Staged(table, f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}", exchange_folder(spark, table), column)
    known = F.when(F.col(column).isNull(), F.raise_error(F.lit(f"a row of the load has no {column}"))).otherwise(F.col(column))
    rows = df.select(*[known.alias(c) if c == column else F.col(c) for c in spark.table(table).columns])
    rows.hint("rebalance", column).write.partitionBy(column).parquet(staged.path)
    return staged


def staged_rows(spark: SparkSession, staged: Staged) -> DataFrame:
    """The rows of a staged load, with the table's schema."""
    return spark.read.schema(spark.table(staged.table).schema).parquet(staged.path)


def same_counts(source: DataFrame, column: str = DAY) -> Callable[[DataFrame], DataFrame]:
    """A check for ``exchange``: days whose number of staged rows is not the source's."""
    return lambda rows: reconcile(source, rows, column).where(F.col("difference") != 0)


def exchange(spark: SparkSession, staged: Staged, check: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Check a staged load and put its days in place of the table's; the number of days.

    ``check`` takes the staged rows and returns what is wrong with them: a row or more rejects the load. Days that the load
    does not hold stay as they are. What reaches the driver is a row for each day of the load.
    """
    rows = staged_rows(spark, staged)
    wrong = check(rows).limit(5).collect() if check else []
    if wrong:
        raise LoadRejected(f"load {staged.load} of {staged.table}: {[r.asDict() for r in wrong]}")
    day = F.date_format(staged.column, "yyyy-MM-dd").alias("day")
    counted = rows.groupBy(day).agg(F.count(F.lit(1)).alias("rows"))
    location = F.concat(F.lit(f"{staged.path}/{staged.column}="), F.col("day"))
    plan = counted.select(F.lit(staged.table).alias("table_name"), F.lit(staged.column).alias("column_name"), "day", location.alias("location"), "rows")
    # One file: it is there as a whole or not at all.
    plan.coalesce(1).write.parquet(f"{staged.folder}/plans/{staged.load}")
    return _carry_out(spark, staged.folder, staged.load)


def finish_exchanges(spark: SparkSession, table: str) -> list[str]:
    """Carry on the planned exchanges that were cut off, the oldest first; their loads. Repeating an exchange changes nothing."""
    folder = exchange_folder(spark, table)
    planned, done = (_loads(spark, f"{folder}/{kind}") for kind in ("plans", "done"))
    cut_off = sorted(planned - done)
    for load in cut_off:
        _carry_out(spark, folder, load)
    return cut_off


def remove_old_loads(spark: SparkSession, table: str, before: datetime) -> int:
    """Remove what loads begun before a time have left and no day points to any more; the number of day folders and rejected loads.

    A day's own version stays whatever its age, and so does a day that was dropped until it is loaded again. Readers that began
    before the exchange may still need the older versions: choose the time accordingly. Exchanges that were cut off are carried on
    first. Files are not read, only their folders are named; a run that is cut off is repaired by the next one.
    """
    finish_exchanges(spark, table)
    folder, limit = exchange_folder(spark, table), f"{int(before.timestamp() * 1e9):020d}"
    fs = _Folders(spark, folder)
    removed = 0
    planned = _loads(spark, f"{folder}/plans")
    for load in sorted(fs.names(f"{folder}/loads") - planned):
        # A load that its check rejected has no plan.
        removed += load < limit and fs.remove(f"{folder}/loads/{load}")
    if not planned:
        return removed
    load = F.element_at(F.split("_metadata.file_path", "/"), -2)
    plans = spark.read.schema(PLAN).option("recursiveFileLookup", True).parquet(f"{folder}/plans").select("*", load.alias("load"))
    latest = plans.groupBy("day").agg(F.max("load").alias("latest"))
    old = plans.join(latest, "day").where((F.col("load") < F.col("latest")) & (F.col("load") < limit))
    for r in old.select("location").toLocalIterator():
        removed += fs.remove(r["location"])
    # Of a load without days of its own the plan goes before the note that it is done: a plan without the note would be carried out again.
    own = {r["load"] for r in plans.join(latest, "day").groupBy("load").agg(F.max(F.col("load") == F.col("latest")).alias("own")).where("own").collect()}
    for load in sorted(planned - own):
        if load < limit:
            for kind in ("loads", "plans", "done"):
                fs.remove(f"{folder}/{kind}/{load}")
    return removed


class _Folders:
    """Names and removal of folders, by the file system that Spark uses for the path."""

    def __init__(self, spark: SparkSession, folder: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self, folder: str) -> set[str]:
        path = self._path(folder)
        return {s.getPath().getName() for s in self._fs.listStatus(path)} if self._fs.exists(path) else set()

    def remove(self, folder: str) -> bool:
        return self._fs.delete(self._path(folder), True)


def _loads(spark: SparkSession, folder: str) -> set[str]:
    """Names of the loads that have a whole file below a folder."""
    try:
        files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").format("parquet").schema("day string").load(folder).inputFiles()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return set()
    return {f.rsplit("/", 2)[1] for f in files}


def _carry_out(spark: SparkSession, folder: str, load: str) -> int:
    """Point the days of a plan to its load, and note that it is done."""
    plan = spark.read.parquet(f"{folder}/plans/{load}")
    days = plan.orderBy("day").collect()
    if days:
        table, column = days[0]["table_name"], days[0]["column_name"]
        there = {r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
        spec = lambda d: f"PARTITION (`{column}` = DATE '{d['day']}')"
        for d in days:
            if d["day"] in there:
                spark.sql(f"ALTER TABLE {table} {spec(d)} SET LOCATION '{d['location']}'")
        new = [f"{spec(d)} LOCATION '{d['location']}'" for d in days if d["day"] not in there]
        for at in range(0, len(new), ADDED_AT_ONCE):
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(new[at : at + ADDED_AT_ONCE])}")
        spark.catalog.refreshTable(table)
    plan.select("day").limit(1).coalesce(1).write.mode("overwrite").parquet(f"{folder}/done/{load}")
    return len(days)
