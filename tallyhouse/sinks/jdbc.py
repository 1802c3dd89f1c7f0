"""JDBC sink: append, and overwrite that keeps the table's definition."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyhouse.sources.jdbc import BATCH_SIZE, Database


def write_options(
    database: Database, table: str, *, truncate: bool = False, batch_size: int | None = BATCH_SIZE
) -> dict[str, str]:
    options = database.options(dbtable=table)
    if batch_size is not None:
        options["batchsize"] = str(batch_size)
    if truncate:
        options["truncate"] = "true"
    return options


def _write(df: DataFrame, mode: str, options: dict[str, str], connections: int) -> None:
    # A shuffle rather than the writer's own limit, which would also squeeze the computation into that many tasks.
    df.repartition(connections).write.format("jdbc").mode(mode).options(**options).save()


def append_jdbc(
    df: DataFrame, database: Database, table: str, batch_size: int | None = BATCH_SIZE, connections: int = 32
) -> None:
    """Append rows over at most ``connections`` connections.

    A task that is run again after its executor is lost can append its rows twice: load facts into a stage table that a
    rerun replaces.
    """
    _write(df, "append", write_options(database, table, batch_size=batch_size), connections)


def overwrite_jdbc(
    df: DataFrame, database: Database, table: str, batch_size: int | None = BATCH_SIZE, connections: int = 32
) -> None:
    """Replace the rows and keep the table as it was declared."""
    _write(df, "overwrite", write_options(database, table, truncate=True, batch_size=batch_size), connections)
