"""The latest state of a dimension, kept beside its loads and merged with each new one.

The snapshot is dealt into a fixed number of parts by a hash of the key. A load rewrites only the parts its keys fall into,
each from its stored rows and the load's, so a mart reads the state as it lies and no load is grouped again.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.snapshot import current_snapshot
from tallyhouse.session import written
from tallyhouse.sinks.tables import append_load

PART = "key_part"
PARTS = 64


def part_of(key: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(parts).cast("bigint")).cast("int")


def snapshot_path(path: str, parts: int) -> str:
    """Where the snapshot of a dimension lies. The number of parts is in the name, so one number's keys never meet another's."""
    return f"{path.rstrip('/')}__current_{parts}"


def read_snapshot(spark: SparkSession, path: str, loaded: str = "etl_date", parts: int = PARTS) -> DataFrame | None:
    """The stored snapshot of the dimension at ``path``, or None if there is none."""
    stored = _stored(spark, snapshot_path(path, parts))
    return None if stored is None else stored.where(F.col(loaded).isNotNull()).drop(PART)


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _parts_in(rows: DataFrame) -> list[int]:
    return [r[0] for r in rows.select(PART).distinct().collect()]


def _replace_parts(rows: DataFrame, path: str) -> None:
    """Put the rows in place of their parts. Files are written aside and moved when the job commits, so the plan may read the
    same table. A part is one task's, or split if it is large."""
    rows.hint("rebalance", PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path)


def load_and_merge(load: DataFrame, path: str, key: str, loaded: str = "etl_date", parts: int = PARTS) -> list[int]:
    """Store one stamped load of a dimension at ``path`` and bring its snapshot up to date; the parts that were rewritten.

    Afterwards the snapshot is what ``current_snapshot`` gives for all loads: also if the load repeats an earlier date, whose
    rows it replaces, or is older than the latest one. A repeated date takes its parts from all loads again, as keys that it
    no longer holds fall back to an earlier state; a new date takes them from the snapshot and the load alone. A load that
    was cut off is repaired by running it again. The part numbers are all that reaches the driver.
    """
    spark = load.sparkSession
    load = written(load, "load")
    target = snapshot_path(path, parts)
    before = _stored(spark, path)
    dates = load.select(loaded).distinct()
    replaced = None
    if before is not None:
        old = before.select(key, loaded).join(dates, loaded, "left_semi")
        replaced = written(old.select(part_of(key, parts).alias(PART)).distinct(), "replaced-parts")
    again = replaced is not None and not replaced.isEmpty()
    mine = load.withColumn(PART, part_of(key, parts))
    touched = sorted({*_parts_in(mine), *(_parts_in(replaced) if again else [])})
    append_load(load, path)
    stored = _stored(spark, target)
    if again or (stored is None and before is not None):
        every = spark.read.parquet(path).select(*load.columns).withColumn(PART, part_of(key, parts))
        rows = every if stored is None else every.where(F.col(PART).isin(touched))
    elif stored is None:
        rows = mine
    else:
        rows = stored.where(F.col(PART).isin(touched)).select(*mine.columns).unionByName(mine)
    merged = current_snapshot(rows.where(F.col(loaded).isNotNull()).drop(PART), key, loaded).withColumn(PART, part_of(key, parts))
    # A row without a date stands for each part, as a part that has lost its last key would otherwise be left as it was.
    numbers = range(parts) if stored is None else touched
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in load.schema.fields]
    marks = spark.range(1).select(*nothing, F.explode(F.array(*[F.lit(n) for n in numbers])).alias(PART))
    _replace_parts(merged.unionByName(marks), target)
    return touched
