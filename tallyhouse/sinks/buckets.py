"""Facts and dimensions stored in buckets of one key, so that they are joined and grouped by it without a shuffle.

A bucket is read by one task and cannot be split later, so a key that holds much of the facts must not lie in one. The facts
are stored in two parts: those of frequent keys, and those without a key, lie apart in ordinary files; the rest is bucketed.
A key is frequent if it has more rows than a bucket has on average. There are fewer such keys than buckets, so their
dimension rows can be broadcast whatever the size of the data.

A task sorts a whole bucket, so a fixed number of buckets would let a task's memory grow with the table: ``buckets_for`` lets the
number follow the rows instead.

The tables lie at paths, as the rest of the warehouse does; a session registers them in its catalog to learn of the buckets.
They are replaced as a whole, which is worth its one shuffle for facts that are read several times.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.sources.files import read_table

BUCKETS = 256
#: A bucket of about so many rows is sorted in some hundred MB.
ROWS_PER_BUCKET = 1_000_000


@dataclass(frozen=True)
class BucketedFacts:
    """Facts by a key: ``even`` in buckets, ``frequent`` the rows of the keys in ``keys`` and those without a key."""

    even: DataFrame
    frequent: DataFrame
    keys: DataFrame
    key: str


def buckets_for(tables: Sequence[DataFrame], least: int = BUCKETS) -> int:
    """Buckets for tables that share them: ``least``, doubled until none has more than ``ROWS_PER_BUCKET`` rows on average."""
    rows = max(table.count() for table in tables)
    buckets = least
    while rows > buckets * ROWS_PER_BUCKET:
        buckets *= 2
    return buckets


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> None:
    """Replace the table at ``path`` by the rows in buckets of ``key``, one sorted file each: the shuffle deals by the buckets' hash."""
    name = _table_of(path)
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    dealt = df.repartition(buckets, F.col(f"`{key}`"))
    dealt.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet").option("path", path).saveAsTable(name)


def read_bucketed(spark: SparkSession, path: str, key: str, buckets: int = BUCKETS) -> DataFrame:
    """The table that ``write_bucketed`` left at ``path``. ``key`` and ``buckets`` have to be those it was written with."""
    name = _table_of(path)
    if not spark.catalog.tableExists(name):
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
        buckets_by = f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS"
        spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet {buckets_by} LOCATION '{path}'")
    return spark.table(name)


def _table_of(path: str) -> str:
    return f"bucketed_{hashlib.md5(path.encode()).hexdigest()}"


def frequent_keys(df: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """Keys with more rows than a bucket has on average: fewer than ``buckets``. Counted on the map side first."""
    counted = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows__"))
    average = counted.agg((F.sum("rows__") / buckets).alias("average__"))
    return counted.join(F.broadcast(average), F.col("rows__") > F.col("average__")).select(key)


def write_facts(df: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> None:
    """Store the facts by ``key`` below ``path``. ``df`` is read three times: to count its keys, and for each part."""
    spark = df.sparkSession
    # Not coalesced: that would draw the count of all keys into one task.
    frequent_keys(df, key, buckets).repartition(1).write.mode("overwrite").parquet(f"{path}/keys")
    keys = F.broadcast(read_table(spark, f"{path}/keys").withColumnRenamed(key, "frequent__"))
    known = df.where(F.col(key).isNotNull())
    # A null key meets no key, so the rows without one have to be asked for.
    of_frequent = df.join(keys, F.col(key) == F.col("frequent__"), "left")
    of_frequent = of_frequent.where(F.col("frequent__").isNotNull() | F.col(key).isNull()).drop("frequent__")
    of_frequent.hint("rebalance").write.mode("overwrite").parquet(f"{path}/frequent")
    write_bucketed(known.join(keys, F.col(key) == F.col("frequent__"), "left_anti"), f"{path}/even", key, buckets)


def read_facts(spark: SparkSession, path: str, key: str, buckets: int = BUCKETS) -> BucketedFacts:
    """The facts that ``write_facts`` left below ``path``."""
    even = read_bucketed(spark, f"{path}/even", key, buckets)
    return BucketedFacts(even, read_table(spark, f"{path}/frequent", even.schema), read_table(spark, f"{path}/keys"), key)


def over_parts(
    facts: BucketedFacts, dim: DataFrame, dim_key: str, build: Callable[[DataFrame, DataFrame, bool], DataFrame]
) -> DataFrame:
    """``build(facts, dim, bounded)`` of the bucketed facts and of the others, together.

    ``dim`` is bucketed by ``dim_key`` as the facts are by theirs. ``build`` has to work row by row, or by groups of the facts'
    key: no key is in both parts. The frequent ones meet a broadcast of their own dimension rows, whose number is bounded.
    """
    keys = F.broadcast(facts.keys.withColumnRenamed(facts.key, "frequent__"))
    few = F.broadcast(dim.join(keys, F.col(dim_key) == F.col("frequent__"), "left_semi"))
    return build(facts.even, dim, False).unionByName(build(facts.frequent, few, True))
