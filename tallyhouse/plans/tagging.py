"""One pass over the source of a load: every row conformed and tagged, so that all that a report says is read from what was written.

A tagged row has the table's columns, the reason it is rejected for (NULL if it is loaded), the columns whose value the
conversion lost, and of a rejected row the source's values as JSON and, if the source is a file, the line as it stands there.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators.conform import columns_of, loses
from tallyhouse.operators.load_filter import FIRST_DAY
from tallyhouse.operators.quality import default_fill
from tallyhouse.sources.contract import schema_differences
from tallyhouse.sources.files import CORRUPT

REASON, LOST, VALUES = "reject_reason", "lost_columns", "source_values"
MALFORMED, NO_KEY, NO_DAY, EARLY = "malformed line", "no key", "no day", "before 1970"


def accept(source: DataFrame, schema: T.StructType, defaults: Mapping[str, object], table: str) -> DataFrame:
    """The source with the declared defaults for columns it does not have; an error if one without a default is missing.

    As in a database, a default stands for an omitted column and not for a NULL. Looks at the schema only.
    """
    present = {c.lower() for c in source.columns}
    omitted = {c: v for c, v in defaults.items() if c in schema.names and c.lower() not in present}
    missing = [d for d in schema_differences(source, schema) if d.endswith(": missing") and d.removesuffix(": missing") not in omitted]
    if missing:
        raise ValueError(f"the source of {table} does not match the contract: {'; '.join(missing)}")
    return default_fill(source, omitted)


def tagged(source: DataFrame, schema: T.StructType, key: str, *, day: str | None = None, etl_date: bool = False, as_of: date | None = None) -> DataFrame:
    """Every row of the source, conformed, with ``reject_reason``, ``lost_columns``, ``source_values`` and ``_corrupt_record``.

    That the values of a rejected row are kept also has a file's reader judge a line by all its columns. Malformed lines and lines without a key are rejected if the source is a file, which says so by its marker column; tables
    are loaded as they are and left to the audit. With ``day``, rows without one or from before 1970 are rejected too.
    """
    of_file = CORRUPT in source.columns
    values = F.struct(*[F.col(f"`{c}`") for c in source.columns if c != CORRUPT]).alias(VALUES)
    marked = source.select(*columns_of(source, schema, etl_date=etl_date, as_of=as_of), *_marks(source, schema, of_file), values)
    reason = F.lit(None).cast("string")
    if day:
        reason = F.when(F.col(day).isNull(), NO_DAY).when(F.col(day) < F.lit(FIRST_DAY), EARLY)
    if of_file:
        reason = F.when(F.col(CORRUPT).isNotNull(), MALFORMED).when(F.col(key).isNull(), NO_KEY).otherwise(reason)
    return marked.withColumn(REASON, reason).withColumn(VALUES, F.when(F.col(REASON).isNotNull(), F.to_json(VALUES)))


def _marks(source: DataFrame, schema: T.StructType, of_file: bool) -> list[Column]:
    lost = [F.when(condition, F.lit(name)) for name, condition in loses(source, schema)]
    line = F.col(CORRUPT) if of_file else F.lit(None).cast("string").alias(CORRUPT)
    return [F.array_compact(F.array(*lost)).alias(LOST), line]


@dataclass(frozen=True)
class LoadReport:
    """What a load did, read from its tagged rows, which lie in the shared folder."""

    table: str
    rows: DataFrame
    day: str | None = None

    def accepted(self) -> DataFrame:
        return self.rows.where(F.col(REASON).isNull()).drop(REASON, LOST, VALUES, CORRUPT)

    def rejected(self) -> DataFrame:
        return self.rows.where(F.col(REASON).isNotNull()).drop(LOST)

    def outcomes(self) -> DataFrame:
        """Rows by reason (NULL: loaded), and by day where the table has days."""
        keys = [F.lit(self.table).alias("table_name"), F.col(REASON).alias("reason")] + ([F.col(self.day).alias("day")] if self.day else [])
        return self.rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))

    def lost_values(self) -> DataFrame:
        """By column: values that the conversion lost, in rows that were loaded or not."""
        return self.rows.select(F.explode(LOST).alias("column_name")).groupBy("column_name").agg(F.count(F.lit(1)).alias("lost"))
