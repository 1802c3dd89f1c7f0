"""JDBC source: whole tables, tables split into ranges, and single days."""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators.load_filter import FIRST_DAY

# Rows per fetch, rows per write batch, socket timeout in milliseconds.
FETCH_SIZE = 10_000
BATCH_SIZE = 50_000
SOCKET_TIMEOUT_MS = 600_000


@dataclass(frozen=True)
class Database:
    """Where a database is and how to log in. The password is kept out of the printed form."""

    url: str
    driver: str
    properties: Mapping[str, str]

    @classmethod
    def from_environment(cls, prefix: str) -> Database:
        """Read ``<prefix>_URL``, ``_DRIVER``, ``_USER`` and ``_PASSWORD``. There are no built-in credentials."""
        login = {
            key: os.environ[f"{prefix}_{key.upper()}"]
            for key in ("user", "password")
            if f"{prefix}_{key.upper()}" in os.environ
        }
        return cls(os.environ[f"{prefix}_URL"], os.environ[f"{prefix}_DRIVER"], login)

    def options(self, **extra: object) -> dict[str, str]:
        base = {"url": self.url, "driver": self.driver, **self.properties}
        return base | {key: str(value) for key, value in extra.items()}

    def __repr__(self) -> str:
        return f"Database(driver={self.driver!r})"


@dataclass(frozen=True)
class Split:
    """Read a table in ``parts`` ranges of a numeric, date or timestamp column."""

    column: str
    lower: object
    upper: object
    parts: int


def scan_options(database: Database, table: str, split: Split | None = None) -> dict[str, str]:
    options = database.options(dbtable=table, fetchsize=FETCH_SIZE, socket_timeout=SOCKET_TIMEOUT_MS)
    if split is not None:
        options |= {
            "partitionColumn": split.column,
            "lowerBound": str(split.lower),
            "upperBound": str(split.upper),
            "numPartitions": str(split.parts),
        }
    return options


def read_jdbc(spark: SparkSession, database: Database, table: str, split: Split | None = None) -> DataFrame:
    """A whole table. Give a split for a large one: without it a single task reads everything."""
    return spark.read.format("jdbc").options(**scan_options(database, table, split)).load()


def read_jdbc_day(spark: SparkSession, database: Database, table: str, day: date, column: str) -> DataFrame:
    """One day of a table. Spark hands the filter to the database."""
    return read_jdbc(spark, database, table).where(F.col(column) == F.lit(day))


def day_predicates(days: Iterable[date], column: str) -> list[str]:
    """One condition per day, each read by a task of its own."""
    return [f"{column} = DATE '{day.isoformat()}'" for day in days]


def unusable_day(column: str) -> str:
    """The condition of the rows that no load by days asks for: those without a day and from before the first one."""
    return f"{column} IS NULL OR {column} < DATE '{FIRST_DAY.isoformat()}'"


def read_jdbc_days(
    spark: SparkSession, database: Database, table: str, days: Iterable[date], column: str, unusable: bool = False
) -> DataFrame:
    """Several days of a table, read side by side. With ``unusable`` one more task reads the rows that have no usable day, which a
    load rejects and counts."""
    properties = {k: v for k, v in scan_options(database, table).items() if k not in ("url", "dbtable")}
    conditions = day_predicates(days, column) + ([unusable_day(column)] if unusable else [])
    return spark.read.jdbc(database.url, table, predicates=conditions, properties=properties)
