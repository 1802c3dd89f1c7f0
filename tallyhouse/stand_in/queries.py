"""The registered queries, one per operator or mart. Each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse import rules, schemas
from tallyhouse.functions.scalars import age_years, moment
from tallyhouse.operators import quality
from tallyhouse.operators.conform import conform
from tallyhouse.operators.load_filter import in_days, in_window, loadable, parse_days
from tallyhouse.operators.load_keys import check_keys
from tallyhouse.operators.readback import first_rows
from tallyhouse.operators.reconcile import reconcile
from tallyhouse.operators.snapshot import current_snapshot
from tallyhouse.plans import calendar, colocated, legacy, marts
from tallyhouse.plans.audit import audit
from tallyhouse.plans.holidays import SETTLEMENT, US_FEDERAL
from tallyhouse.plans.ledger import load_open_days, read_ledger
from tallyhouse.plans.pipeline import KeysRejected, Warehouse, load_transactions
from tallyhouse.session import scratch_path, written
from tallyhouse.sinks import exchange, months, snapshots
from tallyhouse.sinks import tables as sink
from tallyhouse.sources.contract import contract_report
from tallyhouse.sources.files import CORRUPT, read_registry, read_table
from tallyhouse.sources.quoted_csv import read_quoted_csv
from tallyhouse.stand_in import tables as bank

AS_OF = date(2002, 1, 1)
WINDOW = (date(1996, 1, 1), date(1996, 12, 28))
DAY_LIST = "1997-04-14, 1997-04-17,,1997-05-02"
DROPPED_DAY = date(1996, 3, 15)
REPLACED_DAY = date(1996, 3, 16)


# --- marts ------------------------------------------------------------------------------------------------------------


def customer_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.customer_monthly(
        bank.transactions(spark, sf_dir),
        bank.calender(spark),
        bank.transaction_types(spark),
        bank.customers(spark, sf_dir),
        AS_OF,
    )


def customer_monthly_unmatched_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = bank.transaction_types(spark).where(F.col("transaction_type_id") != "N")
    return marts.customer_monthly(
        bank.transactions(spark, sf_dir), bank.calender(spark), known, bank.customers(spark, sf_dir), AS_OF
    )


def _segment_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, ...]:
    return (
        bank.transactions(spark, sf_dir),
        bank.merchants(spark, sf_dir),
        bank.categories(spark),
        bank.customers(spark, sf_dir),
    )


def segment_category_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.segment_category_amount(*_segment_inputs(spark, sf_dir), bank.CATEGORY_COLUMNS)


def count_category_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.count_category_segment(*_segment_inputs(spark, sf_dir), bank.CATEGORY_COLUMNS)


def is_essential_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    averages = marts.is_essential_avg(*_segment_inputs(spark, sf_dir))
    return averages.select(
        "segment", F.col("Essential").alias("essential"), F.col("Non_Essential").alias("non_essential")
    )


def segment_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.segment_size(bank.customers(spark, sf_dir))


def _wide_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "transactions": bank.transactions(spark, sf_dir),
        "categories": bank.categories(spark),
        "merchants": bank.merchants(spark, sf_dir),
        "customers": bank.customers(spark, sf_dir),
        "accounts": bank.accounts(spark, sf_dir),
        "channels": bank.channels(spark),
        "calender": bank.calender(spark),
        "cities": bank.cities(spark, sf_dir),
        "branches": bank.branches(spark, sf_dir),
        "transaction_types": bank.transaction_types(spark),
    }


def wide_expense_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.wide_expense(_wide_tables(spark, sf_dir))


def _from_buckets(spark: SparkSession, sf_dir: str, mart: str) -> DataFrame:
    tables, folder = _wide_tables(spark, sf_dir), scratch_path(spark, "buckets")
    tables["transactions"] = written(tables["transactions"], "facts")
    colocated.store_buckets(tables.__getitem__, folder, mart, buckets=16)
    return colocated.build_from_buckets(spark, tables.__getitem__, folder, mart, AS_OF, buckets=16)


def bucketed_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide mart from facts and accounts stored in buckets of the account."""
    return _from_buckets(spark, sf_dir, "wide_expense")


def bucketed_customer_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly mart from facts and customers stored in buckets of the customer."""
    return _from_buckets(spark, sf_dir, "customer_monthly")


# --- older layout -----------------------------------------------------------------------------------------------------


def legacy_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return legacy.fact_with_day_text(legacy.clean_raw(bank.legacy_rows(spark, sf_dir)))


def legacy_fact_detected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of both layouts: with a ready ``ts``, and with date and time apart."""
    rows = bank.legacy_rows(spark, sf_dir)
    ready = rows.drop("transaction_date", "transaction_time").withColumnsRenamed(
        {"transaction_amount": "amount", "transaction_type": "type"}
    )
    apart = rows.drop("ts")
    return legacy.fact_with_moment(ready).withColumn("layout", F.lit("ts")).unionByName(
        legacy.fact_with_moment(apart).withColumn("layout", F.lit("date_and_time"))
    )


def legacy_mixed_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of both layouts in one folder, and the daily totals of their rows together."""
    rows, folder = bank.legacy_rows(spark, sf_dir), scratch_path(spark, "layouts")
    names = {"transaction_amount": "amount", "transaction_type": "type"}
    rows.drop("transaction_date", "transaction_time").withColumnsRenamed(names).write.parquet(folder)
    rows.drop("ts").write.mode("append").parquet(folder)
    fact = legacy.fact_with_moment(legacy.read_layouts(spark, folder), with_day=True)
    return legacy.daily_account_totals(fact.withColumn("account_number", F.concat_ws("/", "account_number", "type")))


def daily_account_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return legacy.daily_account_totals(legacy.fact_with_moment(bank.legacy_rows(spark, sf_dir).drop("ts"), with_day=True))


def timestamp_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bank.legacy_rows(spark, sf_dir)
    return rows.select("transaction_id", moment(F.col("transaction_date"), F.col("transaction_time")).alias("ts"))


def customer_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bank.accounts(spark, sf_dir).select(
        "account_number", age_years(F.col("account_open_date"), AS_OF).alias("age")
    )


# --- conforming -------------------------------------------------------------------------------------------------------


def _stamped(raw: DataFrame, table: str) -> DataFrame:
    names = [f.name for f in schemas.WAREHOUSE[table].fields if f.name in raw.columns]
    stamped = table not in schemas.WITHOUT_ETL_DATE
    return conform(raw, bank.some(schemas.WAREHOUSE[table], names), etl_date=stamped, as_of=AS_OF)


def conform_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamped(bank.raw_transactions(spark, sf_dir), "transactions")


def conform_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamped(bank.raw_accounts(spark, sf_dir), "accounts")


def conform_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamped(bank.raw_customers(spark, sf_dir), "customers")


def conform_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamped(bank.raw_merchants(spark, sf_dir), "merchants")


def conform_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamped(bank.raw_branches(spark, sf_dir), "branches")


def conform_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stamped(bank.raw_cities(spark, sf_dir), "cities")


def conform_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = bank.read(spark, sf_dir, "part").groupBy("p_type").agg(F.count(F.lit(1)).alias("parts"))
    raw = kinds.select(
        F.col("p_type").alias("category_id"),
        F.lower("p_type").alias("category_name"),
        F.col("p_type").isin("ECONOMY", "SMALL", "STANDARD").cast("string").alias("is_essential"),
    )
    return _stamped(raw, "categories")


def conform_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = bank.read(spark, sf_dir, "lineitem").select("l_linestatus").distinct()
    name = F.when(F.col("l_linestatus") == "F", "branch").otherwise("online")
    return _stamped(used.select(F.col("l_linestatus").alias("channel_id"), name.alias("channel_name")), "channels")


def conform_transaction_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    used = bank.read(spark, sf_dir, "lineitem").select("l_returnflag").distinct()
    raw = used.select(
        F.col("l_returnflag").alias("transaction_type_id"),
        F.lower("l_returnflag").alias("transaction_type_name"),
        F.when(F.col("l_returnflag") == "N", "TRUE").otherwise("FALSE").alias("is_transfer"),
        F.when(F.col("l_returnflag") == "R", "True").otherwise("False").alias("is_income"),
    )
    return _stamped(raw, "transaction_types")


def _covered_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    shipped = bank.read(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("d"))
    ordered = bank.read(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d"))
    return calendar.days_covering(shipped.unionAll(ordered))


def calendar_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per day from the first to the last date of the orders and lines. Days of three dates are holidays."""
    holidays = spark.sql("""
        SELECT * FROM VALUES (DATE '1996-01-01', true), (DATE '1996-07-04', true), (DATE '1997-04-23', false)
        AS t(holiday, in_us)
    """)
    return calendar.calendar_dim(_covered_days(spark, sf_dir), holidays)


def calendar_holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days with their holidays by rule, and the transactions and amount of each day."""
    days = calendar.calendar_dim(_covered_days(spark, sf_dir), rules=SETTLEMENT, us_rules=US_FEDERAL)
    moved = _day_summary(bank.transactions(spark, sf_dir, with_customer=False))
    return days.join(moved, F.col("calender") == F.col("transaction_date"), "left").select(
        "calender", "weekday", "isholiday", "isholiday_in_us", "rows", "amount"
    )


# --- loads ------------------------------------------------------------------------------------------------------------


def _day_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("transaction_date").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("amount").cast(schemas.MONEY).alias("amount")
    )


def _window_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bank.transactions(spark, sf_dir, with_customer=False, shipped=WINDOW)
    return loadable(rows).where(in_window(F.col("transaction_date"), *WINDOW))


def _loaded_window(spark: SparkSession, sf_dir: str, runs: int) -> DataFrame:
    rows = _window_rows(spark, sf_dir)
    path = scratch_path(spark, "window-load")
    for _ in range(runs):
        sink.replace_days(rows, path)
    return read_table(spark, path, rows.schema)


def day_window_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load a window of days twice; the second run replaces the first."""
    return _day_summary(_loaded_window(spark, sf_dir, runs=2))


def day_list_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bank.transactions(spark, sf_dir, with_customer=False)
    listed = loadable(rows).where(in_days(F.col("transaction_date"), parse_days(DAY_LIST)))
    path = scratch_path(spark, "list-load")
    sink.replace_days(listed, path)
    return _day_summary(read_table(spark, path, rows.schema))


def partition_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drop a day, drop it again, and replace another day by the expenses of that day."""
    rows = _window_rows(spark, sf_dir)
    base = scratch_path(spark, "day-table")
    database = f"tally_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{base}'")
    table = f"{database}.transactions"
    sink.create_day_table(spark, table, rows.schema)
    sink.replace_table_days(rows, table)
    sink.drop_day(spark, table, DROPPED_DAY)
    sink.drop_day(spark, table, DROPPED_DAY)
    expenses = marts.expense_rows(rows, bank.transaction_types(spark)).drop("is_income")
    sink.replace_day(expenses, table, REPLACED_DAY)
    return _day_summary(spark.table(table))


STAGED = (date(1996, 1, 1), date(1996, 6, 30)), (date(1996, 3, 1), date(1996, 8, 31))


def staged_exchange(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A half-year of days, then an exchange that brings the expenses alone for known and new days, then a load that loses the rows
    of one day and is rejected."""
    rows = _window_rows(spark, sf_dir)
    database = f"tally_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, 'staged')}'")
    table = f"{database}.transactions"
    sink.create_day_table(spark, table, rows.schema)
    first, second = (rows.where(in_window(F.col("transaction_date"), *window)) for window in STAGED)
    expenses = marts.expense_rows(second, bank.transaction_types(spark)).drop("is_income")
    for load in (first, expenses):
        exchange.exchange(spark, exchange.stage_days(load, table), exchange.same_counts(load))
    try:
        short = first.where(F.col("transaction_date") != F.lit(DROPPED_DAY))
        exchange.exchange(spark, exchange.stage_days(short, table), exchange.same_counts(first))
    except exchange.LoadRejected:
        return _day_summary(spark.table(table))
    raise RuntimeError("a load without the rows of a day was not rejected")


def staged_fact_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact load of the warehouse into a catalog table: a half-year, then the expenses alone of known and new days, then a load
    with repeated keys, which is rejected before it is staged. Then the replaced versions are removed; ``versions`` counts what is left of a day."""
    base = scratch_path(spark, "staged-warehouse")
    database = f"tally_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{base}/catalog'")
    house = Warehouse(spark, base, f"{database}.transactions")
    rows = written(_with_all_columns(bank.transactions(spark, sf_dir, with_customer=False, shipped=WINDOW)), "staged-source")
    expenses = marts.expense_rows(rows, bank.transaction_types(spark)).drop("is_income")
    for source, (start, end) in zip((rows, expenses), STAGED):
        load_transactions(source, house, start=start, end=end, as_of=AS_OF)
    try:
        load_transactions(rows.unionAll(rows), house, start=STAGED[0][0], end=STAGED[0][1], as_of=AS_OF, checked=True)
    except KeysRejected as rejected:
        if "repeated in the load" not in str(rejected):
            raise
        exchange.remove_old_loads(spark, house.fact_table, datetime.now() + timedelta(days=1))
    else:
        raise RuntimeError("a load with repeated keys was not rejected")
    lying = spark.read.option("recursiveFileLookup", True).parquet(f"{exchange.exchange_folder(spark, house.fact_table)}/loads")
    folder = F.regexp_extract("_metadata.file_path", r"^(.*)/[^/]*$", 1).alias("folder")
    versions = lying.select(folder).distinct().groupBy(F.regexp_extract("folder", r"=([^=]*)$", 1).cast("date").alias("transaction_date"))
    return _day_summary(house.loads("transactions")).join(versions.agg(F.count(F.lit(1)).alias("versions")), "transaction_date", "left")


def month_layout_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days in the month layout, two months of them replaced by their expenses alone, and a window read that begins before
    the first month."""
    rows = bank.transactions(spark, sf_dir, with_customer=False)
    layout = months.MonthLayout(scratch_path(spark, "months"), date(1996, 1, 1), date(2001, 1, 1))
    months.replace_days_in_months(rows, layout)
    halves = rows.where(in_window(F.col("transaction_date"), date(1996, 2, 15), date(1996, 3, 15)))
    months.replace_days_in_months(marts.expense_rows(halves, bank.transaction_types(spark)).drop("is_income"), layout)
    return _day_summary(months.read_months(spark, layout, rows.schema).where(layout.window(date(1995, 11, 20), date(1996, 7, 10))))


def load_reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days of the source against a target that holds the window."""
    source = bank.transactions(spark, sf_dir, with_customer=False)
    return reconcile(source, _loaded_window(spark, sf_dir, runs=1))


def _faulty_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions as text, some with a day that is none or is too early, some with an amount or a balance that is no number."""
    lines = bank.raw_transactions(spark, sf_dir, with_customer=False)
    number = F.substring_index("transaction_id_dd", "-", -1)
    day = F.col("transaction_date").cast("string")
    given = lines.withColumns(
        {
            "transaction_date": F.when(number == "7", "someday").when(number == "6", F.concat(F.lit("1969"), F.substring(day, 5, 6))).otherwise(day),
            "amount": F.when(number == "5", "n/a").otherwise(F.col("amount").cast(schemas.MONEY).cast("string")),
            "balance_after_transaction": F.when(number == "4", "?"),
        }
    )
    return _with_all_columns(given)


def _with_all_columns(rows: DataFrame) -> DataFrame:
    """The columns that the contract of the transactions asks for and the test tables do not have, as NULL."""
    there = {c.lower() for c in rows.columns} | set(rules.DEFAULTS["transactions"])
    return rows.select("*", *[F.lit(None).cast("string").alias(n) for n in schemas.TRANSACTIONS.names if n not in there])


def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the load of a window says of itself: rows by day and reason, those that were stored, and values lost in conversion."""
    house = Warehouse(spark, scratch_path(spark, "reported"))
    done = load_transactions(_faulty_source(spark, sf_dir), house, start=WINDOW[0], end=WINDOW[1], as_of=AS_OF)
    by_reason = done.report.outcomes().select(F.coalesce("reason", F.lit("loaded")).alias("what"), F.col("day").cast("string").alias("of"), "rows")
    lost = done.report.lost_values().select(F.lit("lost").alias("what"), F.col("column_name").alias("of"), F.col("lost").alias("rows"))
    stored = house.loads("transactions").where("not is_recurring and not is_salary").agg(F.count(F.lit(1)).alias("rows"))
    kept = house.loads("rejected_transactions").agg(F.count(F.lit(1)).alias("rows"))
    others = [(df, name) for df, name in ((stored, "stored"), (kept, "kept apart"))]
    return reduce(DataFrame.unionAll, [by_reason, lost, *[df.select(F.lit(name), F.lit("all rows"), "rows") for df, name in others]])


def load_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days loaded one by one, twice: at first one day fails and one has no rows yet; only these are tried again."""
    house = Warehouse(spark, scratch_path(spark, "ledger"))
    rows = bank.transactions(spark, sf_dir, with_customer=False)
    days = parse_days("1996-03-13, 1996-03-14, 1996-03-15, 1996-03-16")
    tried: list[date] = []

    def load(day: date) -> int:
        tried.append(day)
        if tried.count(day) == 1 and day == DROPPED_DAY:
            raise RuntimeError("the source is down")
        found = rows.where(F.col("transaction_date") == F.lit(day)).where(F.lit(tried.count(day) > 1 or day != REPLACED_DAY))
        sink.replace_days(found, house.location("transactions"))
        stored = read_table(spark, house.location("transactions"), rows.schema)
        return stored.where(F.col("transaction_date") == F.lit(day)).count()

    for _ in range(2):
        latest = load_open_days(spark, house.location("ledger"), "transactions", days, load)
    attempts = read_ledger(spark, house.location("ledger")).groupBy("day").agg(F.count(F.lit(1)).alias("attempts"), F.count("error").alias("failures"))
    stored = read_table(spark, house.location("transactions"), rows.schema).groupBy(F.col("transaction_date").alias("day")).agg(F.sum("amount").cast(schemas.MONEY).alias("amount"))
    return latest.select("day", "outcome", "rows").join(attempts, "day").join(stored, "day", "left")


NEW_DAYS, MOVED_TO = (date(1997, 4, 1), date(1997, 6, 30)), date(1997, 6, 30)


def load_key_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days to be loaded beside a stored window. Third lines of orders of the window come again under a new day, second lines of the
    new days come twice, merchants of large cities are unknown and some channels are missing."""
    rows = bank.transactions(spark, sf_dir, with_customer=False)
    stored_at, load_at = scratch_path(spark, "stored-days"), scratch_path(spark, "load")
    sink.replace_days(rows.where(in_window(F.col("transaction_date"), *WINDOW)), stored_at)
    number = F.substring_index("transaction_id_dd", "-", -1)
    new = rows.where(in_window(F.col("transaction_date"), *NEW_DAYS))
    again = rows.where(in_window(F.col("transaction_date"), *WINDOW) & (number == "3")).withColumn("transaction_date", F.lit(MOVED_TO))
    load = new.unionAll(new.where(number == "2")).unionAll(again)
    load.withColumn("channel_id", F.when(number != "5", F.col("channel_id"))).write.parquet(load_at)
    merchants = bank.merchants(spark, sf_dir).where(F.col("city_id").cast("int") < 25)
    return check_keys(
        read_table(spark, load_at),
        read_table(spark, stored_at),
        "transaction_id_dd",
        sink.DAY,
        [("merchant_id", "merchants", "merchant_id"), ("branch_id", "branches", "branch_id")],
        {"merchants": merchants, "branches": bank.branches(spark, sf_dir)},
        ["transaction_id_dd", "channel_id", "amount"],
    )


def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write two tables as CSV, read the folder back through the registry; a registered third file is not there."""
    folder = scratch_path(spark, "csv")
    raw = {"accounts": bank.accounts(spark, sf_dir), "customers": bank.customers(spark, sf_dir)}
    for table, df in raw.items():
        df.write.option("header", True).option("emptyValue", '""').csv(f"{folder}/{table}.csv")
    files = {table: f"{table}.csv" for table in [*raw, "merchants"]}
    expected = {**{table: df.schema for table, df in raw.items()}, "merchants": schemas.MERCHANTS}
    registry = read_registry(spark, folder, files, expected)
    if registry.skipped != ["merchants"]:
        raise RuntimeError(f"skipped {registry.skipped}")
    accounts = registry.frames["accounts"].where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    owners = registry.frames["customers"].select("customer_id", "last_name", "segment")
    return accounts.join(owners, "customer_id", "left")


def csv_quoted_breaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a comment that holds line breaks, quotes and commas, written as CSV and read in splits; a line without its last
    fields is kept apart."""
    comment = F.concat_ws("\n", F.lit('a "quoted", comment'), "l_returnflag", F.lit(""), "l_linestatus")
    lines = bank.read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", comment.alias("comment"), F.col("l_shipdate").cast("date").alias("shipped")
    )
    folder = scratch_path(spark, "quoted-csv")
    lines.write.option("header", True).option("escape", '"').csv(f"{folder}/lines.csv")
    spark.range(1).select(F.lit('l_orderkey,l_linenumber,comment,shipped\n1,"cut\noff"').alias("text")).coalesce(1).write.text(f"{folder}/cut.csv")
    read = read_quoted_csv(spark, f"{folder}/*.csv", lines.schema)
    kind = F.when(F.col(CORRUPT).isNotNull(), F.col(CORRUPT)).otherwise(F.col("comment"))
    return read.groupBy(F.col("shipped"), kind.alias("text")).agg(F.count(F.lit(1)).alias("rows"), F.sum("l_orderkey").alias("orders"))


def snapshot_of_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers loaded twice; in the second load those in debt have moved to another segment."""
    path = scratch_path(spark, "dimension")
    first = bank.raw_customers(spark, sf_dir)
    second = first.where(F.col("monthly_salary_usd") < 0).withColumn("segment", F.lit("IN_DEBT"))
    for rows, day in ((first, date(2001, 1, 1)), (second, date(2001, 2, 1)), (second, date(2001, 2, 1))):
        schema = bank.customers(spark, sf_dir).schema
        sink.append_load(conform(rows, schema, etl_date=True, as_of=day), path)
    return current_snapshot(read_table(spark, path), "customer_id")


def snapshot_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers merged load by load: all of them, those in debt under another segment, that load again with fewer rows and a
    third segment, and a late load of an earlier day, which changes nothing."""
    path = scratch_path(spark, "merged-dimension")
    all_of_them = conform(bank.raw_customers(spark, sf_dir), bank.customers(spark, sf_dir).schema)
    in_debt, deep_in_debt = (all_of_them.where(F.col("monthly_salary_usd") < limit) for limit in (0, -500))
    loads = (
        (all_of_them, date(2001, 1, 1)),
        (in_debt.withColumn("segment", F.lit("IN_DEBT")), date(2001, 2, 1)),
        (deep_in_debt.withColumn("segment", F.lit("DEEP_IN_DEBT")), date(2001, 2, 1)),
        (in_debt.withColumn("segment", F.lit("LATE")), date(2000, 12, 1)),
    )
    for rows, day in loads:
        snapshots.load_and_merge(rows.withColumn("etl_date", F.lit(day)), path, "customer_id")
    return snapshots.read_snapshot(spark, path)


def top_accounts_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_rows(bank.accounts(spark, sf_dir), ["customer_id", "account_open_date"], n=6)


# --- integrity --------------------------------------------------------------------------------------------------------


def pk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.pk_violations(bank.read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def fk_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orphans per rule. Merchants have them: not every size of a part is a city."""
    lines = bank.read(spark, sf_dir, "lineitem")
    orders = bank.read(spark, sf_dir, "orders")
    parts = bank.read(spark, sf_dir, "part")
    suppliers = bank.read(spark, sf_dir, "supplier")
    customers = bank.read(spark, sf_dir, "customer")
    nations = bank.read(spark, sf_dir, "nation")
    return quality.fk_summary(
        [
            quality.fk_violations(lines, "l_orderkey", orders, "o_orderkey", "transactions.account"),
            quality.fk_violations(lines, "l_partkey", parts, "p_partkey", "transactions.merchant"),
            quality.fk_violations(lines, "l_suppkey", suppliers, "s_suppkey", "transactions.branch"),
            quality.fk_violations(orders, "o_custkey", customers, "c_custkey", "accounts.customer"),
            quality.fk_violations(parts, "p_size", nations, "n_nationkey", "merchants.city"),
        ]
    )


def null_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULLs per column of the fact, conformed with the columns it has no source for, and of four tables as they are."""
    fact = conform(
        bank.raw_transactions(spark, sf_dir, with_customer=False), schemas.TRANSACTIONS, allow_missing=True
    )
    frames = {"transactions": fact}
    frames |= {name: bank.read(spark, sf_dir, name) for name in ("orders", "customer", "part", "events")}
    profiles = [
        quality.null_profile(df).select(F.lit(name).alias("table_name"), "*") for name, df in frames.items()
    ]
    return reduce(DataFrame.unionAll, profiles)


def default_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts whose balance is unknown while the order is pending, with the declared defaults."""
    orders = bank.read(spark, sf_dir, "orders")
    balance = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice").cast(schemas.MONEY))
    rows = orders.select(F.col("o_orderkey").alias("account_number"), balance.alias("initial_balance"))
    return quality.default_fill(rows, {"initial_balance": 0, "overdraft_limit": 0})


def length_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.length_violations(
        bank.read(spark, sf_dir, "customer"), ["c_custkey"], {"c_mktsegment": 8, "c_name": 18}
    )


def precision_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.precision_violations(
        bank.read(spark, sf_dir, "orders"), ["o_orderkey"], {"o_totalprice": (7, 2), "o_custkey": (3, 0)}
    )


def month_partition_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bank.transactions(spark, sf_dir, with_customer=False)
    label = quality.month_partition(F.col("transaction_date"), date(1996, 1, 1), date(2001, 1, 1))
    return rows.groupBy(label.alias("partition_month")).agg(F.count(F.lit(1)).alias("rows"))


def integrity_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule of the current layout over the conformed tables; rules on what they lack are reported as not checked."""
    tables = {
        "calender": bank.calender(spark),
        "cities": bank.cities(spark, sf_dir),
        "branches": bank.branches(spark, sf_dir),
        "merchants": bank.merchants(spark, sf_dir),
        "customers": bank.customers(spark, sf_dir),
        "accounts": bank.accounts(spark, sf_dir),
        "transactions": bank.transactions(spark, sf_dir, with_customer=False),
    }
    return audit(tables, rules.CURRENT)


CONTRACT = {
    "orders": schemas.table(
        o_orderkey=T.LongType(),
        o_custkey=schemas.TEXT,
        o_totalprice=T.DecimalType(8, 2),
        o_orderdate=schemas.DATE,
        o_orderpriority=schemas.INT,
    ),
    "customer": schemas.table(
        c_custkey=T.LongType(), c_name=schemas.TEXT, c_acctbal=T.DecimalType(6, 2), c_mktsegment=schemas.FLAG
    ),
    "part": schemas.table(p_partkey=T.LongType(), p_size=T.ByteType(), p_color=schemas.TEXT),
}


def source_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    reports = [contract_report(bank.read(spark, sf_dir, name), want, name) for name, want in CONTRACT.items()]
    return reduce(DataFrame.unionAll, reports)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "customer_monthly": customer_monthly,
        "customer_monthly_unmatched_type": customer_monthly_unmatched_type,
        "segment_category_amount": segment_category_amount,
        "count_category_segment": count_category_segment,
        "is_essential_avg": is_essential_avg,
        "segment_size": segment_size,
        "daily_account_agg": daily_account_agg,
        "legacy_fact": legacy_fact,
        "legacy_mixed_folder": legacy_mixed_folder,
        "legacy_fact_detected": legacy_fact_detected,
        "timestamp_build": timestamp_build,
        "customer_age": customer_age,
        "conform_transactions": conform_transactions,
        "conform_accounts": conform_accounts,
        "conform_customers": conform_customers,
        "conform_merchants": conform_merchants,
        "conform_branches": conform_branches,
        "conform_cities": conform_cities,
        "conform_categories": conform_categories,
        "conform_channels": conform_channels,
        "conform_transaction_types": conform_transaction_types,
        "calendar_dim": calendar_dim,
        "calendar_holidays": calendar_holidays,
        "wide_expense_transactions": wide_expense_transactions,
        "bucketed_star": bucketed_star,
        "bucketed_customer_monthly": bucketed_customer_monthly,
        "day_window_load": day_window_load,
        "day_list_load": day_list_load,
        "partition_drop": partition_drop,
        "month_partition_assign": month_partition_assign,
        "month_layout_scan": month_layout_scan,
        "staged_exchange": staged_exchange,
        "staged_fact_load": staged_fact_load,
        "load_report": load_report,
        "load_ledger": load_ledger,
        "load_key_check": load_key_check,
        "current_snapshot": snapshot_of_dimension,
        "snapshot_merge": snapshot_merge,
        "pk_violations": pk_violations,
        "fk_violations": fk_violations,
        "integrity_audit": integrity_audit,
        "null_profile": null_profile,
        "default_fill": default_fill,
        "length_violations": length_violations,
        "precision_violations": precision_violations,
        "top_accounts_readback": top_accounts_readback,
        "load_reconciliation": load_reconciliation,
        "source_contract": source_contract,
        "csv_ingest": csv_ingest,
        "csv_quoted_breaks": csv_quoted_breaks,
    }
