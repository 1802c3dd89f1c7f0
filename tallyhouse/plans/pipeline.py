"""The warehouse on a shared file system: loading dimensions and facts, building marts."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse import rules, schemas
from tallyhouse.operators.load_filter import FIRST_DAY, in_days, in_window
from tallyhouse.operators.load_keys import check_keys
from tallyhouse.operators.reconcile import reconcile
from tallyhouse.operators.snapshot import current_snapshot
from tallyhouse.plans import marts
from tallyhouse.plans.tagging import LoadReport, accept, tagged
from tallyhouse.schemas import PRIMARY_KEY, WAREHOUSE, WITHOUT_ETL_DATE
from tallyhouse.session import written
from tallyhouse.sinks.exchange import exchange, finish_exchanges, same_counts, stage_days
from tallyhouse.sinks.snapshots import load_and_merge, read_snapshot
from tallyhouse.sinks.tables import DAY, create_day_table, replace_days, write_table
from tallyhouse.sources.files import read_table
from tallyhouse.sources.jdbc import Database, Split, read_jdbc

MARTS = (
    "customer_monthly",
    "segment_category_amount",
    "count_category_segment",
    "is_essential_avg_dm",
    "wide_expense",
)


@dataclass(frozen=True)
class Warehouse:
    """Tables below one folder. Dimensions with a load date keep every load and are read as their latest state.

    With ``fact_table`` the transactions are that table of the session's catalog in place of a folder: a load of them is staged,
    checked and exchanged day by day, so that a reader never sees a day half loaded.
    """

    spark: SparkSession
    path: str
    fact_table: str | None = None

    def location(self, table: str) -> str:
        return f"{self.path.rstrip('/')}/{table}"

    def loads(self, table: str) -> DataFrame:
        """A table as stored, with all its loads."""
        if table == "transactions" and self.fact_table:
            return self.spark.table(self.fact_table)
        return read_table(self.spark, self.location(table))

    def table(self, table: str) -> DataFrame:
        """A table as of its latest load, without the load date: the stored snapshot of a dimension, which loads keep up to date."""
        if table == "transactions" or table in WITHOUT_ETL_DATE:
            return self.loads(table).drop("etl_date")
        merged = read_snapshot(self.spark, self.location(table))
        return (current_snapshot(self.loads(table), PRIMARY_KEY[table]) if merged is None else merged).drop("etl_date")

    def has(self, table: str) -> bool:
        if table == "transactions" and self.fact_table:
            return self.spark.catalog.tableExists(self.fact_table)
        try:
            self.loads(table)
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return False
            raise
        return True


@dataclass(frozen=True)
class FactLoad:
    """What a fact load did: its tagged rows, and rows per day in source and target."""

    report: LoadReport
    per_day: DataFrame


class KeysRejected(ValueError):
    """The keys of a load break the declared rules; the table is as it was."""


def quarantine(report: LoadReport, warehouse: Warehouse) -> None:
    """Keep the rejected rows of the latest load beside the table, with the line or values, and the reason."""
    write_table(report.rejected(), warehouse.location(f"rejected_{report.table}"))


def load_dimension(source: DataFrame, table: str, warehouse: Warehouse, as_of: date | None = None) -> LoadReport:
    """Conform a dimension and store it: as one more load, merged into the table's snapshot, or in place of the old table if
    it has no load date. The source is read once; columns it omits take their declared defaults, others must be there."""
    if table == "transactions" or table not in WAREHOUSE:
        raise ValueError(f"{table} is no dimension")
    stamped = table not in WITHOUT_ETL_DATE
    source = accept(source, WAREHOUSE[table], rules.DEFAULTS.get(table, {}), table)
    rows = tagged(source, WAREHOUSE[table], PRIMARY_KEY[table], etl_date=stamped, as_of=as_of)
    report = LoadReport(table, written(rows, f"tagged-{table}"))
    quarantine(report, warehouse)
    if stamped:
        load_and_merge(report.accepted(), warehouse.location(table), PRIMARY_KEY[table])
    else:
        write_table(report.accepted(), warehouse.location(table))
    return report


def chosen_days(start: date | None, end: date | None, days: Iterable[date] | None, day: Column | None = None) -> Column:
    """The condition of a load: a list of days, or an inclusive window."""
    day = F.col(DAY) if day is None else day
    if days is not None:
        return in_days(day, days)
    if start is None or end is None:
        raise ValueError("give a list of days, or the first and the last day of a window")
    return in_window(day, start, end)


def load_transactions(
    source: DataFrame,
    warehouse: Warehouse,
    *,
    start: date | None = None,
    end: date | None = None,
    days: Iterable[date] | None = None,
    as_of: date | None = None,
    checked: bool = False,
) -> FactLoad:
    """Replace the chosen days of the fact table by the source's rows of those days. A day the source has no row for
    stays as it is. The source is read once, and all days are loaded by one job; the report is read from the tagged rows.
    A fact table of the catalog takes its days by a staged exchange: an exchange that was cut off is carried on before, and a load
    that did not arrive whole beside the table is rejected and changes nothing.

    With ``checked``, a load whose rows break the declared keys, references or NOT NULL rules is rejected before any day changes,
    and what is wrong with it is kept as ``violations_transactions``. Dimensions that are not there are not looked at.
    """
    days = list(days) if days is not None else None
    chosen = chosen_days(start, end, days)
    rows = tagged_transactions(source, start=start, end=end, days=days, as_of=as_of)
    report = LoadReport("transactions", written(rows, "tagged-transactions"), DAY)
    quarantine(report, warehouse)
    accepted = report.accepted()
    if warehouse.fact_table:
        create_day_table(warehouse.spark, warehouse.fact_table, accepted.schema)
        finish_exchanges(warehouse.spark, warehouse.fact_table)
    if checked:
        _check_keys(accepted, warehouse)
    if warehouse.fact_table:
        exchange(warehouse.spark, stage_days(accepted, warehouse.fact_table), same_counts(accepted))
        target = warehouse.loads("transactions")
    else:
        replace_days(accepted, warehouse.location("transactions"))
        target = read_table(warehouse.spark, warehouse.location("transactions"), accepted.schema)
    return FactLoad(report, reconcile(accepted, target.where(chosen)))


def _check_keys(rows: DataFrame, warehouse: Warehouse) -> None:
    stored = warehouse.loads("transactions") if warehouse.has("transactions") else None
    references = rules.CURRENT.foreign_keys["transactions"]
    parents = {table: warehouse.table(table) for table in {t for _, t, _ in references} if warehouse.has(table)}
    not_null = rules.CURRENT.not_null["transactions"]
    wrong = check_keys(rows, stored, PRIMARY_KEY["transactions"], DAY, references, parents, not_null)
    write_table(wrong, warehouse.location("violations_transactions"))
    counts = warehouse.loads("violations_transactions").groupBy("rule", "column_name").agg(F.sum("rows").alias("rows"))
    found = [f"{r['rule']}: {r['column_name']}, {r['rows']} rows" for r in counts.orderBy("rule", "column_name").collect()]
    if found:
        raise KeysRejected(f"the load was rejected: {'; '.join(found)}")


def tagged_transactions(
    source: DataFrame, *, start: date | None = None, end: date | None = None, days: Iterable[date] | None = None, as_of: date | None = None
) -> DataFrame:
    """The tagged rows of the chosen days, and those that have no usable day. The condition reaches the scan of a date column."""
    source = accept(source, schemas.TRANSACTIONS, rules.DEFAULTS["transactions"], "transactions")
    is_date = any(f.name.lower() == DAY and isinstance(f.dataType, T.DateType) for f in source.schema.fields)
    day = F.col(DAY) if is_date else F.col(DAY).try_cast("date")
    wanted = source.where(chosen_days(start, end, days, day) | day.isNull() | (day < F.lit(FIRST_DAY)))
    return tagged(wanted, schemas.TRANSACTIONS, PRIMARY_KEY["transactions"], day=DAY, etl_date=True, as_of=as_of)


def build_mart(name: str, table: Callable[[str], DataFrame], as_of: date) -> DataFrame:
    """A mart from the warehouse tables, which ``table`` gives by name: ``Warehouse.table`` or ``database_tables``."""
    if name == "customer_monthly":
        return marts.customer_monthly(
            table("transactions"), table("calender"), table("transaction_types"), table("customers"), as_of
        )
    if name == "wide_expense":
        return marts.wide_expense({t: table(t) for t in WAREHOUSE})
    by_segment = {
        "segment_category_amount": marts.segment_category_amount,
        "count_category_segment": marts.count_category_segment,
        "is_essential_avg_dm": marts.is_essential_avg,
    }
    if name not in by_segment:
        raise ValueError(f"unknown mart {name}; there are {', '.join(MARTS)}")
    return by_segment[name](table("transactions"), table("merchants"), table("categories"), table("customers"))


def latest(stored: DataFrame, table: str) -> DataFrame:
    """A table kept in a database as of its latest load, without the load date.

    The latest state of a dimension is written to the shared folder once, as a mart reads it several times: to join it and to
    count it.
    """
    if table == "transactions" or "etl_date" not in stored.columns:
        return stored.drop("etl_date")
    return written(current_snapshot(stored, PRIMARY_KEY[table]).drop("etl_date"), f"latest-{table}")


def database_tables(
    spark: SparkSession, database: Database, splits: Mapping[str, Split] | None = None
) -> Callable[[str], DataFrame]:
    """Warehouse tables kept in a database. Give a split for each large table, the transactions above all."""
    return lambda table: latest(read_jdbc(spark, database, table, (splits or {}).get(table)), table)
