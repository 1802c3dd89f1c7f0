"""Banking tables derived from the driver's tables.

| bank table        | driver table            | note                                                              |
| ----------------- | ----------------------- | ----------------------------------------------------------------- |
| transactions      | lineitem, orders        | the order is the account, the part the merchant                   |
| accounts          | orders                  | branch = day of the month of the opening date                     |
| customers         | customer                | name parts from c_name; birth year = 1950 + nation                |
| merchants         | part                    | category = p_type, city = p_size (sizes above 24 have no city)    |
| branches, cities  | supplier, nation        |                                                                   |
| legacy rows       | events                  |                                                                   |

``raw_*`` frames keep the source types; the others are conformed to the warehouse schemas, so keys are text.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse import schemas
from tallyhouse.functions.scalars import clock_text, day_id
from tallyhouse.operators.conform import conform
from tallyhouse.operators.lookup import Lookup, star_join
from tallyhouse.plans.calendar import calendar_dim, days_between

CALENDAR_START, CALENDAR_END = date(1995, 1, 1), date(2001, 12, 31)

# Listed categories of the marts: one of the six is left out, as the banking lists do.
CATEGORY_COLUMNS = {
    "ECONOMY": "economy",
    "LARGE": "large",
    "MEDIUM": "medium",
    "PROMO": "promo",
    "SMALL": "small",
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def some(schema: T.StructType, names: Iterable[str]) -> T.StructType:
    """The named fields of a schema: those the driver's tables have a source for."""
    return T.StructType([schema[name] for name in names])


def raw_transactions(
    spark: SparkSession,
    sf_dir: str,
    *,
    with_customer: bool = True,
    shipped: tuple[date, date] | None = None,
) -> DataFrame:
    """Transactions in source types. The customer is that of the order, looked up only where it is asked for.

    ``shipped`` is an inclusive window on the source column, so that it reaches the Parquet scan.
    """
    lines = read(spark, sf_dir, "lineitem")
    if shipped is not None:
        first, last = shipped
        lines = lines.where(
            (F.col("l_shipdate") >= F.lit(first).cast("timestamp_ntz"))
            & (F.col("l_shipdate") < F.date_add(F.lit(last), 1).cast("timestamp_ntz"))
        )
    needed = lines.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
        "l_returnflag",
        "l_linestatus",
        "l_shipdate",
    )
    if with_customer:
        orders = read(spark, sf_dir, "orders")
        needed = star_join(needed, [Lookup(orders, "l_orderkey", "o_orderkey", {"o_custkey": "customer_id"}, large=True)])
    day = F.col("l_shipdate").cast("date")
    columns = [
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("transaction_id_dd"),
        day.alias("transaction_date"),
        clock_text(F.col("l_shipdate")).alias("transaction_time"),
        day_id(day).alias("transaction_date_key"),
        F.col("l_orderkey").alias("account_id"),
        F.col("l_partkey").alias("merchant_id"),
        F.col("l_suppkey").alias("branch_id"),
        F.col("l_linestatus").alias("channel_id"),
        F.col("l_returnflag").alias("transaction_type_id"),
        F.col("l_extendedprice").alias("amount"),
        F.lit("USD").alias("currency"),
    ]
    if with_customer:
        columns.append(F.col("customer_id"))
    return needed.select(*columns)


def transactions(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    raw = raw_transactions(spark, sf_dir, **options)
    have = [f.name for f in schemas.TRANSACTIONS.fields if f.name in raw.columns]
    return conform(raw, some(schemas.TRANSACTIONS, have))


def raw_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("account_number"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("initial_balance"),
        F.dayofmonth("o_orderdate").alias("branch_id"),
        F.col("o_orderdate").alias("account_open_date"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["account_number", "customer_id", "initial_balance", "branch_id", "account_open_date"]
    return conform(raw_accounts(spark, sf_dir), some(schemas.ACCOUNTS, names))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.split("c_name", "#")
    return read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        name[0].alias("first_name"),
        name[1].alias("last_name"),
        F.make_date(F.col("c_nationkey") + 1950, F.lit(1), F.lit(1)).alias("date_of_birth"),
        F.col("c_acctbal").alias("monthly_salary_usd"),
        F.col("c_mktsegment").alias("segment"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["customer_id", "first_name", "last_name", "date_of_birth", "monthly_salary_usd", "segment"]
    return conform(raw_customers(spark, sf_dir), some(schemas.CUSTOMERS, names))


def raw_merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("merchant_id"),
        F.col("p_name").alias("merchant_name"),
        F.col("p_type").alias("category_id"),
        F.col("p_size").alias("city_id"),
    )


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(raw_merchants(spark, sf_dir), schemas.MERCHANTS)


def raw_branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("branch_id"),
        F.col("s_name").alias("branch_name"),
        F.col("s_nationkey").alias("city_id"),
    )


def branches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(raw_branches(spark, sf_dir), some(schemas.BRANCHES, ["branch_id", "branch_name", "city_id"]))


def raw_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        F.col("n_nationkey").alias("city_id"), F.col("n_name").alias("city_name"), F.col("r_name").alias("country")
    )


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(raw_cities(spark, sf_dir), schemas.CITIES)


def categories(spark: SparkSession) -> DataFrame:
    return spark.sql("""
        SELECT * FROM VALUES
          ('ECONOMY', 'ECONOMY', true), ('LARGE', 'LARGE', false), ('MEDIUM', 'MEDIUM', false),
          ('PROMO', 'PROMO', false), ('SMALL', 'SMALL', true), ('STANDARD', 'STANDARD', true)
        AS t(category_id, category_name, is_essential)
    """)


def transaction_types(spark: SparkSession) -> DataFrame:
    return spark.sql("""
        SELECT * FROM VALUES ('A', 'accepted', false, false), ('N', 'new', true, false), ('R', 'returned', false, true)
        AS t(transaction_type_id, transaction_type_name, is_transfer, is_income)
    """)


def channels(spark: SparkSession) -> DataFrame:
    return spark.sql("SELECT * FROM VALUES ('F', 'branch'), ('O', 'online') AS t(channel_id, channel_name)")


def calender(spark: SparkSession) -> DataFrame:
    return calendar_dim(days_between(spark, CALENDAR_START, CALENDAR_END))


def legacy_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as rows of the older layout, with date and time apart and, as in one source, a ready ``ts``."""
    no_text = F.lit(None).cast("string")
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("transaction_id"),
        F.col("user_id").alias("account_number"),
        F.col("user_id").alias("customer_id"),
        F.date_trunc("second", F.col("ts")).cast("timestamp_ntz").alias("ts"),
        F.col("ts").cast("date").alias("transaction_date"),
        clock_text(F.col("ts")).alias("transaction_time"),
        F.col("value").alias("transaction_amount"),
        F.col("event_type").alias("transaction_type"),
        no_text.alias("category"),
        no_text.alias("location"),
        no_text.alias("channel"),
    )
