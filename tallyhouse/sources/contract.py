"""Does a source keep to the schema a load expects?"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def schema_differences(df: DataFrame, expected: T.StructType) -> list[str]:
    """Columns that are missing or have another type, as messages. Looks at the schema only."""
    actual = {f.name.lower(): f.dataType for f in df.schema.fields}
    found = []
    for f in expected.fields:
        have = actual.get(f.name.lower())
        if have is None:
            found.append(f"{f.name}: missing")
        elif have != f.dataType:
            found.append(f"{f.name}: {have.simpleString()} instead of {f.dataType.simpleString()}")
    return found


def require_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """The frame, or an error before anything is read or written."""
    found = schema_differences(df, expected)
    if found:
        raise ValueError("source does not match the contract: " + "; ".join(found))
    return df


def contract_report(df: DataFrame, expected: T.StructType, table: str) -> DataFrame:
    """One row per expected column: declared and actual type, rows, and values that do not convert. One pass."""
    actual = {f.name.lower(): f for f in df.schema.fields}
    counters = [F.count(F.lit(1)).alias("rows")]
    lines = []
    for i, f in enumerate(expected.fields):
        have = actual.get(f.name.lower())
        if have is None:
            counters.append(F.lit(None).cast("bigint").alias(f"bad_{i}"))
        else:
            column = F.col(f"`{have.name}`")
            bad = column.isNotNull() & column.try_cast(f.dataType).isNull()
            counters.append(F.count_if(bad).alias(f"bad_{i}"))
        lines.append(
            F.struct(
                F.lit(table).alias("table_name"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("expected_type"),
                F.lit(have.dataType.simpleString() if have else None).cast("string").alias("actual_type"),
                F.col("rows"),
                F.col(f"bad_{i}").alias("unconvertible"),
            )
        )
    return df.agg(*counters).select(F.inline(F.array(*lines)))
