"""CSV and Parquet sources with explicit schemas."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.schemas import RAW, RAW_FILES

CORRUPT = "_corrupt_record"
# Stands for an unquoted empty field inside the reader. With the empty text here, a quoted one would be NULL as well.
UNQUOTED_EMPTY = "\u0000"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    strict: bool = False,
    multiline: bool = False,
) -> DataFrame:
    """Read a CSV with a header by column position: the names of ``schema`` replace the header's.

    An empty field is NULL, a quoted empty field is an empty text, dates are ISO, text is UTF-8. A malformed line
    or a value that does not fit its type fails the read with ``strict``; otherwise the value is NULL and the line is
    kept whole in the column ``_corrupt_record``. Quoted line breaks need ``multiline``, which keeps Spark from
    splitting a file.
    """
    reader = (
        spark.read.option("header", True)
        .option("enforceSchema", True)
        .option("encoding", "UTF-8")
        .option("dateFormat", "yyyy-MM-dd")
        .option("nullValue", UNQUOTED_EMPTY)
        .option("emptyValue", "")
        .option("escape", '"')
        .option("multiLine", multiline)
    )
    if strict:
        return reader.option("mode", "FAILFAST").schema(schema).csv(path)
    kept = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    # Without column pruning, so that a line with a wrong number of fields is noticed whichever columns a query reads.
    # A value of the wrong type is noticed by queries that read its column.
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.option("columnPruning", False).schema(kept).csv(path)


def malformed_lines(df: DataFrame) -> DataFrame:
    """Lines, malformed lines, and values per column, for a frame of ``read_csv``. Reads every column."""
    values = [F.count(F.col(f"`{name}`")).alias(f"values_{name}") for name in df.columns if name != CORRUPT]
    lines = F.count(F.lit(1)).alias("lines")
    return df.agg(lines, F.count_if(F.col(CORRUPT).isNotNull()).alias("malformed"), *values)


def split_rejects(df: DataFrame, key: str | None) -> tuple[DataFrame, DataFrame]:
    """Rows to load, and rows to keep apart: malformed lines as they stand in the file, and rows without a key if there is one.

    ``df`` is a frame of ``read_csv`` that has been written once, so that both parts judge a line by all its columns.
    """
    reject = F.col(CORRUPT).isNotNull() | (F.col(key).isNull() if key else F.lit(False))
    return df.where(~reject).drop(CORRUPT), df.where(reject)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Read a Parquet table; with a schema also when it holds no file yet."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


@dataclass(frozen=True)
class Registry:
    """Frames of the files that exist, and the tables whose file does not."""

    frames: dict[str, DataFrame] = field(default_factory=dict)
    skipped: list[str] = field(default_factory=list)


def read_registry(
    spark: SparkSession,
    folder: str,
    files: Mapping[str, str] = RAW_FILES,
    schemas: Mapping[str, T.StructType] = RAW,
    *,
    strict: bool = False,
) -> Registry:
    """Read every registered file of a folder. A file that is not there is reported, not an error."""
    registry = Registry()
    for table, name in files.items():
        try:
            registry.frames[table] = read_csv(spark, f"{folder.rstrip('/')}/{name}", schemas[table], strict=strict)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            registry.skipped.append(table)
    return registry
