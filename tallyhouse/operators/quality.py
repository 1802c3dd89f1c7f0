"""Integrity rules as data-quality jobs: each returns the violations, or their number.

Every check reduces on the map side before it shuffles, so a key that a third of the rows share costs one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.scalars import month_label


def pk_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that are repeated or have a missing part, with their row count."""
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("rows"))
    missing = reduce(Column.__or__, [F.col(k).isNull() for k in key])
    return counted.where((F.col("rows") > 1) | missing)


def fk_violations(child: DataFrame, column: str, parent: DataFrame, parent_key: str, rule: str) -> DataFrame:
    """Values of ``column`` without a parent, with the number of child rows; a NULL refers to nothing and passes.

    The child is counted per value first, so the anti join sees each value once.
    """
    used = child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    parents = parent.select(F.col(parent_key).alias("__parent"))
    orphans = used.join(parents, F.col(column) == F.col("__parent"), "left_anti")
    return orphans.select(F.lit(rule).alias("rule"), F.col(column).cast("string").alias("value"), "rows")


def fk_summary(orphans: Sequence[DataFrame]) -> DataFrame:
    """Orphan values and orphan rows per rule; a rule without orphans gives no row."""
    return (
        reduce(DataFrame.unionAll, orphans)
        .groupBy("rule")
        .agg(F.count(F.lit(1)).alias("orphan_values"), F.sum("rows").alias("orphan_rows"))
    )


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column: rows and NULLs. One pass for all columns."""
    names = list(columns or df.columns)
    totals = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(f"`{n}`").isNull()).alias(f"nulls_{n}") for n in names],
    )
    pairs = ", ".join(f"'{n}', `nulls_{n}`" for n in names)
    return totals.selectExpr("rows", f"stack({len(names)}, {pairs}) as (column_name, nulls)").select(
        "column_name", "rows", "nulls"
    )


def default_fill(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Put the declared default in place of a NULL, and add a column the frame lacks.

    A database default fills an omitted column only. Filling a NULL as well is this library's choice; run
    ``null_profile`` first to see where that happens.
    """
    filled = [
        F.coalesce(F.col(n), F.lit(defaults[n]).cast(df.schema[n].dataType)).alias(n) if n in defaults else F.col(n)
        for n in df.columns
    ]
    added = [F.lit(value).alias(n) for n, value in defaults.items() if n not in df.columns]
    return df.select(*filled, *added)


def length_violations(df: DataFrame, key: Sequence[str], limits: Mapping[str, int]) -> DataFrame:
    """Text values longer than declared: key, column, limit, length. One pass for all columns."""
    found = [
        F.when(
            F.length(n) > limit,
            F.struct(F.lit(n).alias("column_name"), F.lit(limit).alias("max_length"), F.length(n).alias("length")),
        )
        for n, limit in limits.items()
    ]
    return _violating_cells(df, key, found)


def precision_violations(df: DataFrame, key: Sequence[str], limits: Mapping[str, tuple[int, int]]) -> DataFrame:
    """Numbers that do not fit the declared decimal(p, s): key, column, declared type. One pass for all columns."""
    found = [
        F.when(
            F.col(n).isNotNull() & F.col(n).try_cast(f"decimal({p},{s})").isNull(),
            F.struct(F.lit(n).alias("column_name"), F.lit(f"decimal({p},{s})").alias("declared")),
        )
        for n, (p, s) in limits.items()
    ]
    return _violating_cells(df, key, found)


def _violating_cells(df: DataFrame, key: Sequence[str], found: list[Column]) -> DataFrame:
    cells = F.filter(F.array(*found), lambda cell: cell.isNotNull())
    return df.select(*key, F.explode(cells).alias("cell")).select(*key, "cell.*")


def month_partition(day: Column, first: date, end: date) -> Column:
    """Label of the month partition a day belongs to: from ``first`` up to, not including, ``end``; else ``default``."""
    inside = (day >= F.lit(first)) & (day < F.lit(end))
    return F.when(inside, month_label(day)).otherwise(F.lit("default"))
