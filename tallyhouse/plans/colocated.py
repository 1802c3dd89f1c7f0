"""Marts over facts that are stored in buckets of the key of a large dimension."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.plans import marts
from tallyhouse.schemas import PRIMARY_KEY, WAREHOUSE
from tallyhouse.sinks.buckets import BUCKETS, buckets_for, over_parts, read_bucketed, read_facts, write_bucketed, write_facts
from tallyhouse.sources.files import read_table

#: mart -> fact key and dimension it is bucketed by
MART_BUCKETS = {"customer_monthly": ("customer_id", "customers"), "wide_expense": ("account_id", "accounts")}

Tables = Callable[[str], DataFrame]


def _places(folder: str, key: str, dimension: str, buckets: int) -> tuple[str, str]:
    """Paths of facts and dimension. Key and number of buckets are in the names, so one number's buckets never meet another's."""
    return tuple(f"{folder.rstrip('/')}/{table}__by_{column}_{buckets}" for table, column in (("transactions", key), (dimension, PRIMARY_KEY[dimension])))


def _note(folder: str, key: str, buckets: int) -> str:
    """Path of the one row that says how many buckets there are where at least ``buckets`` were asked for."""
    return f"{folder.rstrip('/')}/buckets__by_{key}_{buckets}"


def _noted(spark: SparkSession, folder: str, key: str, buckets: int) -> int:
    """The number of buckets that was stored; a copy without a note has as many as were asked for."""
    try:
        return read_table(spark, _note(folder, key, buckets)).first()["buckets"]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return buckets


def store_buckets(table: Tables, folder: str, mart: str, buckets: int = BUCKETS) -> None:
    """Store the facts and the dimension that a mart shares its key with below ``folder``: in ``buckets`` buckets of their key,
    or in more if the rows ask for it (see ``buckets_for``)."""
    key, dimension = MART_BUCKETS[mart]
    facts, dim = table("transactions"), table(dimension)
    stored = buckets_for([facts, dim], buckets)
    fact_path, dim_path = _places(folder, key, dimension, stored)
    write_facts(facts, fact_path, key, stored)
    write_bucketed(dim, dim_path, PRIMARY_KEY[dimension], stored)
    facts.sparkSession.range(1).select(F.lit(stored).alias("buckets")).coalesce(1).write.mode("overwrite").parquet(_note(folder, key, buckets))


def build_from_buckets(
    spark: SparkSession, table: Tables, folder: str, mart: str, as_of: date, buckets: int = BUCKETS
) -> DataFrame:
    """A mart from what ``store_buckets`` left for the same ``buckets``, and ``table`` for the other dimensions.

    The monthly sums of a customer and the attributes come together without a shuffle of facts, and so do the facts of an
    account and the account in the wide mart; its other large dimensions are joined after that.
    """
    key, dimension = MART_BUCKETS[mart]
    buckets = _noted(spark, folder, key, buckets)
    fact_path, dim_path = _places(folder, key, dimension, buckets)
    facts = read_facts(spark, fact_path, key, buckets)
    dim = read_bucketed(spark, dim_path, PRIMARY_KEY[dimension], buckets)
    if mart == "customer_monthly":
        calender, kinds = table("calender"), table("transaction_types")
        return over_parts(facts, dim, PRIMARY_KEY[dimension], lambda rows, own, _: marts.customer_monthly(rows, calender, kinds, own, as_of))
    others = {t: table(t) for t in WAREHOUSE if t not in ("transactions", dimension)}
    return over_parts(
        facts,
        dim,
        PRIMARY_KEY[dimension],
        lambda rows, own, bounded: marts.wide_expense(
            {**others, "transactions": rows, dimension: own}, colocated=dimension, bounded=dimension if bounded else None
        ),
    )
