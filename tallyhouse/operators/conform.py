"""Bring a source frame to a warehouse schema, and count what the casts lose."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.scalars import clock_text, stamp


def _cast(source: T.StructField, target: T.StructField) -> Column:
    column = F.col(f"`{source.name}`")
    is_clock = isinstance(source.dataType, (T.TimestampType, T.TimestampNTZType)) and target.name.endswith("_time")
    if is_clock and isinstance(target.dataType, T.StringType):
        return clock_text(column)
    return column.try_cast(target.dataType)


def _by_name(df: DataFrame) -> dict[str, T.StructField]:
    return {field.name.lower(): field for field in df.schema.fields}


def conform(
    df: DataFrame,
    schema: T.StructType,
    *,
    etl_date: bool = False,
    as_of: date | None = None,
    allow_missing: bool = False,
) -> DataFrame:
    """Select, cast and name the columns of ``schema``; a value that does not fit its type becomes NULL.

    Columns outside the schema are left out. A column the source lacks is an error, or a typed NULL with
    ``allow_missing``. ``etl_date`` adds the load stamp.
    """
    return df.select(*columns_of(df, schema, etl_date=etl_date, as_of=as_of, allow_missing=allow_missing))


def columns_of(
    df: DataFrame, schema: T.StructType, *, etl_date: bool = False, as_of: date | None = None, allow_missing: bool = False
) -> list[Column]:
    """The columns that ``conform`` selects."""
    present = _by_name(df)
    missing = [field.name for field in schema.fields if field.name.lower() not in present]
    if missing and not allow_missing:
        raise ValueError(f"source lacks the columns {missing}")
    columns = [
        _cast(present[field.name.lower()], field).alias(field.name)
        if field.name.lower() in present
        else F.lit(None).cast(field.dataType).alias(field.name)
        for field in schema.fields
    ]
    if etl_date:
        columns.append(stamp(as_of))
    return columns


def loses(df: DataFrame, schema: T.StructType) -> list[tuple[str, Column]]:
    """For each shared column, whether the cast to ``schema`` turns a value into NULL."""
    present = _by_name(df)
    shared = [(present[field.name.lower()], field) for field in schema.fields if field.name.lower() in present]
    return [(field.name, F.col(f"`{have.name}`").isNotNull() & _cast(have, field).isNull()) for have, field in shared]


def rejected_casts(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row per shared column: rows seen and values that the cast to ``schema`` turns into NULL. One pass."""
    shared = loses(df, schema)
    counters = [F.count(F.lit(1)).alias("rows"), *[F.count_if(lost).alias(f"lost_{name}") for name, lost in shared]]
    totals = df.agg(*counters)
    pairs = ", ".join(f"'{name}', `lost_{name}`" for name, _ in shared)
    return totals.selectExpr("rows", f"stack({len(shared)}, {pairs}) as (column_name, rejected)").select(
        "column_name", "rows", "rejected"
    )
