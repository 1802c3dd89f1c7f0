"""Command line of the jobs, for spark-submit or ``python -m tallyhouse.jobs``.

    load-files        --folder CSV_FOLDER --warehouse W [--strict]   every registered CSV file that is there
    load-calendar     --start D --end D --warehouse W [--holidays]   the generated date dimension
    load-dimension    --table T SOURCE --warehouse W
    load-transactions SOURCE --warehouse W (--start D --end D | --dates D,D,...) [--check-keys]
    copy-months       --warehouse W (--start D --end D | --dates D,D,...) --target PATH   days of the facts into a month layout
    clean-legacy      SOURCE --target PATH                      older layout: cleaned rows, appended
    load-legacy       SOURCE --form day|moment --target PATH    older layout: fact, appended
    build-daily       SOURCE --target PATH                      older layout: daily totals per account
    bucket-facts      --mart M --warehouse W [--buckets N]      facts and the mart's largest dimension in buckets of one key
    build-mart        --mart M (--warehouse W | --jdbc PREFIX) --target PATH [--bucketed [--buckets N]]
    audit             --warehouse W --target PATH               declared integrity rules and their violations
    remove-old-loads  --fact-table T [--days-kept N]            versions of days that later loads have replaced

SOURCE is ``--parquet PATH``, ``--csv FILE``, or ``--jdbc PREFIX --source-table NAME`` with the connection in
``PREFIX_URL``, ``PREFIX_DRIVER``, ``PREFIX_USER`` and ``PREFIX_PASSWORD``. The window also comes from ``LOAD_START``,
``LOAD_END`` and ``LOAD_DATES``. With ``--fact-table DB.TABLE`` the transactions are that table of the session's catalog, whose loads are
staged, checked and exchanged day by day (a catalog that outlives the session is a setting of spark-submit). ``--show N`` prints the first N rows of what was written. Days from a database are read side by side, one query per day. A target of the form ``jdbc:PREFIX:TABLE`` is written to a database.
"""

from __future__ import annotations

import argparse
import os
import sys
from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyhouse import rules
from tallyhouse.operators.load_filter import parse_days, window_days
from tallyhouse.operators.readback import first_rows
from tallyhouse.plans import legacy
from tallyhouse.plans.audit import audit
from tallyhouse.plans.calendar import calendar_dim, days_between
from tallyhouse.plans.colocated import MART_BUCKETS, build_from_buckets, store_buckets
from tallyhouse.plans.holidays import SETTLEMENT, US_FEDERAL
from tallyhouse.plans.ledger import FAILED, LOADED, load_open_days
from tallyhouse.plans.pipeline import (
    MARTS,
    FactLoad,
    Warehouse,
    build_mart,
    chosen_days,
    database_tables,
    load_dimension,
    load_transactions,
)
from tallyhouse.plans.tagging import MALFORMED, REASON, LoadReport
from tallyhouse.schemas import LEGACY_RAW, RAW, WAREHOUSE
from tallyhouse.session import build_session, written
from tallyhouse.sinks.buckets import BUCKETS
from tallyhouse.sinks.exchange import remove_old_loads
from tallyhouse.sinks.jdbc import append_jdbc, overwrite_jdbc
from tallyhouse.sinks.months import MonthLayout, replace_days_in_months
from tallyhouse.sinks.tables import DAY, append_table, write_table
from tallyhouse.sources.files import read_csv, read_registry, read_table, split_rejects
from tallyhouse.sources.jdbc import Database, Split, read_jdbc, read_jdbc_days
from tallyhouse.sources.quoted_csv import read_quoted_csv


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="tallyhouse", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    jobs = root.add_subparsers(dest="job", required=True)

    def job(name: str, *, source: bool = False, warehouse: bool = False, target: bool = False):
        sub = jobs.add_parser(name)
        if source:
            place = sub.add_mutually_exclusive_group(required=True)
            place.add_argument("--parquet")
            place.add_argument("--csv")
            place.add_argument("--jdbc")
            sub.add_argument("--source-table")
            sub.add_argument("--quoted-breaks", action="store_true", help="the CSV has line breaks within quotes")
            _split_options(sub)
        if warehouse:
            sub.add_argument("--warehouse", required=True)
            _fact_table_option(sub)
        if target:
            sub.add_argument("--target", required=True)
            sub.add_argument("--show", type=int, default=0)
        sub.add_argument("--as-of", type=date.fromisoformat)
        return sub

    files = job("load-files", warehouse=True)
    files.add_argument("--folder", required=True)
    files.add_argument("--strict", action="store_true", help="fail on a malformed line")
    calendar = job("load-calendar", warehouse=True)
    calendar.add_argument("--start", type=date.fromisoformat, required=True)
    calendar.add_argument("--end", type=date.fromisoformat, required=True)
    calendar.add_argument("--holidays", action="store_true", help="bank settlement holidays and US federal ones, by rule")
    job("load-dimension", source=True, warehouse=True).add_argument(
        "--table", required=True, choices=[t for t in WAREHOUSE if t != "transactions"]
    )
    facts = job("load-transactions", source=True, warehouse=True)
    by_month = job("copy-months", warehouse=True, target=True)
    for sub in (facts, by_month):
        for name in ("start", "end"):
            sub.add_argument(f"--{name}", type=date.fromisoformat, default=_day_of(os.getenv(f"LOAD_{name.upper()}")))
        sub.add_argument("--dates", type=parse_days, default=_days_of(os.getenv("LOAD_DATES")))
    facts.add_argument("--day-by-day", action="store_true", help="one day after the other; days that the ledger has as loaded are left out")
    facts.add_argument("--check-keys", action="store_true", help="reject a load that breaks declared keys, before any day changes")
    job("clean-legacy", source=True, target=True)
    job("load-legacy", source=True, target=True).add_argument("--form", choices=("day", "moment"), required=True)
    job("build-daily", source=True, target=True)
    mart = job("build-mart", target=True)
    mart.add_argument("--mart", required=True, choices=MARTS)
    place = mart.add_mutually_exclusive_group(required=True)
    place.add_argument("--warehouse")
    place.add_argument("--jdbc")
    _split_options(mart)
    _fact_table_option(mart)
    mart.add_argument("--bucketed", action="store_true", help="use what bucket-facts left; loads since then are not in it")
    by_key = job("bucket-facts", warehouse=True)
    by_key.add_argument("--mart", required=True, choices=sorted(MART_BUCKETS))
    for sub in (mart, by_key):
        sub.add_argument("--buckets", type=int, default=BUCKETS)
    job("audit", warehouse=True, target=True)
    old = job("remove-old-loads")
    old.add_argument("--fact-table", required=True)
    old.add_argument("--days-kept", type=float, default=7, help="leave what loads of so many days have brought")
    return root


def _fact_table_option(sub: argparse.ArgumentParser) -> None:
    sub.add_argument("--fact-table", help="table of the catalog that holds the transactions; its loads are staged and exchanged")


def _split_options(sub: argparse.ArgumentParser) -> None:
    sub.add_argument("--split-column", help="column to read a database table in parallel by; build-mart: that of transactions")
    sub.add_argument("--split-lower")
    sub.add_argument("--split-upper")
    sub.add_argument("--split-parts", type=int, default=32)


def fact_splits(args: argparse.Namespace) -> dict[str, Split]:
    """The split of the facts for a mart from a database. One is required: without it a single task reads them all."""
    if not (args.split_column and args.split_lower and args.split_upper):
        raise ValueError("build-mart --jdbc needs --split-column, --split-lower and --split-upper for transactions")
    return {"transactions": Split(args.split_column, args.split_lower, args.split_upper, args.split_parts)}


def _day_of(text: str | None) -> date | None:
    return date.fromisoformat(text) if text else None


def _days_of(text: str | None) -> list[date] | None:
    return parse_days(text) if text else None


def _source(spark: SparkSession, args: argparse.Namespace, table: str, schema: StructType) -> DataFrame:
    if args.parquet:
        return read_table(spark, args.parquet)
    if args.csv:
        return (read_quoted_csv if args.quoted_breaks else read_csv)(spark, args.csv, schema)
    database, name = Database.from_environment(args.jdbc), args.source_table or table
    if args.split_column:
        return read_jdbc(
            spark, database, name, Split(args.split_column, args.split_lower, args.split_upper, args.split_parts)
        )
    if args.job == "load-transactions":
        days = args.dates or window_days(args.start, args.end)
        return read_jdbc_days(spark, database, name, days, DAY, unusable=not args.day_by_day)
    return read_jdbc(spark, database, name)


def _write(df: DataFrame, args: argparse.Namespace, append: bool = False) -> None:
    """Write to the target and show its first rows in the order of the columns."""
    spark = df.sparkSession
    if args.target.startswith("jdbc:"):
        _, prefix, table = args.target.split(":", 2)
        database = Database.from_environment(prefix)
        (append_jdbc if append else overwrite_jdbc)(df, database, table)
        stored = read_jdbc(spark, database, table) if args.show else None
    else:
        (append_table if append else write_table)(df, args.target)
        stored = read_table(spark, args.target) if args.show else None
    if stored is not None:
        first_rows(stored, stored.columns[:2], args.show).show(args.show, truncate=False)


def _write_rejects(rejects: DataFrame, target: str) -> None:
    """Keep the malformed lines of a file beside a target that is a path, and say how many there are."""
    print(f"{rejects.count()} malformed lines")
    if not target.startswith("jdbc:"):
        write_table(rejects, f"{target.rstrip('/')}__rejected")


def _print_rejects(report: LoadReport) -> None:
    """Rows of a load by reason, and values that its conversion lost."""
    by_reason = report.rows.groupBy(REASON).agg(F.count(F.lit(1)).alias("rows")).collect()
    counts = {r[REASON]: r["rows"] for r in by_reason}
    lines, loaded = sum(counts.values()), counts.pop(None, 0)
    print(f"{report.table}: {lines} lines, {counts.get(MALFORMED, 0)} malformed, {lines - loaded} rejected, {loaded} to load")
    print(f"rejected rows: {dict(sorted(counts.items()))}")
    report.lost_values().orderBy("column_name").show(truncate=False)


def _report(done: FactLoad) -> int:
    """Print what a fact load did. The exit code says whether the chosen days now hold the source's rows: every row has
    arrived, and no day keeps rows of an earlier load that the source no longer has."""
    totals = done.per_day.agg(
        F.sum("source_rows").alias("read"),
        F.sum("target_rows").alias("stored"),
        F.count_if((F.col("source_rows") > 0) & (F.col("difference") != 0)).alias("wrong_days"),
    ).first()
    print(f"read {totals['read'] or 0} rows, stored {totals['stored'] or 0}, days that differ: {totals['wrong_days']}")
    _print_rejects(done.report)
    stale = [str(r[DAY]) for r in done.per_day.where("source_rows = 0 and target_rows > 0").orderBy(DAY).collect()]
    if stale:
        print(f"days that the source no longer has, left as they were: {', '.join(stale)}")
    return 1 if totals["wrong_days"] or stale else 0


def _load_day_by_day(spark: SparkSession, source: DataFrame, warehouse: Warehouse, args: argparse.Namespace) -> int:
    """Load the chosen days that the ledger does not have as done. The exit code says whether a day is still open."""

    def load(day: date) -> int:
        done = load_transactions(source, warehouse, days=[day], as_of=args.as_of, checked=args.check_keys)
        return done.report.accepted().count()

    days = args.dates or window_days(args.start, args.end)
    state = load_open_days(spark, warehouse.location("load_ledger"), "transactions", days, load)
    open_days = state.where(F.col("outcome") != LOADED).orderBy("day")
    counts = {r["outcome"]: r["count"] for r in state.groupBy("outcome").count().collect()}
    print(f"days: {dict(sorted(counts.items()))}")
    for r in open_days.collect():
        print(f"{r['day']}: {r['outcome']} at attempt {r['attempt']}" + (f": {r['error'].splitlines()[0]}" if r["error"] else ""))
    return 1 if FAILED in counts else 0


def run(spark: SparkSession, argv: Sequence[str]) -> int:
    """Run one job; the result is the exit code."""
    args = parser().parse_args(argv)
    warehouse = Warehouse(spark, args.warehouse, args.fact_table) if getattr(args, "warehouse", None) else None
    if args.job == "load-files":
        registry = read_registry(spark, args.folder, strict=args.strict)
        code = 0
        for table, df in registry.frames.items():
            if table == "transactions":
                rows = df if args.strict else written(df, "lines-transactions")
                bounds = rows.agg(F.min("transaction_date").alias("lo"), F.max("transaction_date").alias("hi")).first()
                days = {"start": bounds["lo"], "end": bounds["hi"]} if bounds["lo"] is not None else {"days": []}
                code = _report(load_transactions(rows, warehouse, as_of=args.as_of, **days))
            else:
                _print_rejects(load_dimension(df, table, warehouse, args.as_of))
            print(f"loaded {table}")
        print(f"not there: {', '.join(registry.skipped) or 'none'}")
        return code
    elif args.job == "load-calendar":
        rules_of_days = {"rules": SETTLEMENT, "us_rules": US_FEDERAL} if args.holidays else {}
        _print_rejects(load_dimension(calendar_dim(days_between(spark, args.start, args.end), **rules_of_days), "calender", warehouse))
    elif args.job == "load-dimension":
        _print_rejects(load_dimension(_source(spark, args, args.table, RAW[args.table]), args.table, warehouse, args.as_of))
    elif args.job == "load-transactions":
        source = _source(spark, args, "transactions", RAW["transactions"])
        if args.day_by_day:
            return _load_day_by_day(spark, source, warehouse, args)
        window = {"start": args.start, "end": args.end, "days": args.dates}
        return _report(load_transactions(source, warehouse, **window, as_of=args.as_of, checked=args.check_keys))
    elif args.job == "copy-months":
        chosen = warehouse.loads("transactions").where(chosen_days(args.start, args.end, args.dates))
        print(f"months: {', '.join(replace_days_in_months(chosen, MonthLayout(args.target)))}")
    elif args.job in ("clean-legacy", "load-legacy", "build-daily"):
        rows = _source(spark, args, "transactions", LEGACY_RAW)
        if args.csv:
            rows, rejects = split_rejects(written(rows, "lines"), None)
            _write_rejects(rejects, args.target)
        if args.job == "clean-legacy":
            _write(legacy.clean_raw(rows), args, append=True)
        elif args.job == "load-legacy":
            fact = legacy.fact_with_day_text if args.form == "day" else legacy.fact_with_moment
            _write(fact(rows), args, append=True)
        else:
            _write(legacy.daily_account_totals(legacy.fact_with_moment(rows, with_day=True)), args)
    elif args.job == "bucket-facts":
        store_buckets(warehouse.table, warehouse.path, args.mart, args.buckets)
    elif args.job == "build-mart":
        if args.bucketed:
            if not args.warehouse or args.mart not in MART_BUCKETS:
                raise ValueError(f"--bucketed needs --warehouse and one of the marts {', '.join(sorted(MART_BUCKETS))}")
            as_of = args.as_of or date.today()
            _write(build_from_buckets(spark, warehouse.table, warehouse.path, args.mart, as_of, args.buckets), args)
            return 0
        if args.jdbc:
            splits = fact_splits(args)
            table = database_tables(spark, Database.from_environment(args.jdbc), splits)
        else:
            table = warehouse.table
        _write(build_mart(args.mart, table, args.as_of or date.today()), args)
    elif args.job == "audit":
        _write(audit({t: warehouse.loads(t) for t in WAREHOUSE if warehouse.has(t)}, rules.CURRENT), args)
    elif args.job == "remove-old-loads":
        print(f"removed {remove_old_loads(spark, args.fact_table, datetime.now() - timedelta(days=args.days_kept))} folders")
    return 0


def main() -> None:
    spark = build_session("tallyhouse")
    try:
        code = run(spark, sys.argv[1:])
    finally:
        spark.stop()
    sys.exit(code)


if __name__ == "__main__":
    main()
