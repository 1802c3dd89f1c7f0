"""The older transaction layout: cleaning, fact variants and the daily account totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.functions.scalars import clock_text, day_text, moment, padded_id
from tallyhouse.schemas import AMOUNT, MONEY, TEXT, table

#: Columns of the fact, and the names that a source may have for them, the preferred one first.
FACT = table(transaction_id=TEXT, account_number=TEXT, customer_id=TEXT, amount=AMOUNT, type=TEXT, category=TEXT, location=TEXT, channel=TEXT)
OTHER_NAMES = {"amount": ["amount", "transaction_amount"], "type": ["type", "transaction_type"]}


def clean_raw(df: DataFrame) -> DataFrame:
    """Light cleaning of the raw file: amount, date, time as text, id padded to eleven digits."""
    return df.withColumns(
        {
            "transaction_amount": F.col("transaction_amount").try_cast("decimal(12,2)"),
            "transaction_date": F.col("transaction_date").try_cast("date"),
            "transaction_time": clock(df),
            "transaction_id": padded_id(F.col("transaction_id")),
        }
    )


def in_fact_names(df: DataFrame, **added: Column) -> DataFrame:
    """The columns of the fact under their own names, conformed, and further ones.

    Where a source has several names for a column, each row takes the first that it has a value for: a folder may hold files
    of different layouts, read with their schemas merged.
    """
    columns = {}
    for name in FACT.names:
        there = [n for n in OTHER_NAMES.get(name, [name]) if n in df.columns]
        if not there:
            raise ValueError(f"source lacks the column {' or '.join(OTHER_NAMES.get(name, [name]))}")
        parts = [F.col(n).try_cast(FACT[name].dataType) for n in there]
        columns[name] = F.coalesce(*parts) if len(parts) > 1 else parts[0]
    ids = {n: columns.pop(n) for n in FACT.names[:3]}
    return df.select(*[c.alias(n) for n, c in {**ids, **added, **columns}.items()])


def fact_with_day_text(df: DataFrame) -> DataFrame:
    """Fact with the date as text; the time is ignored."""
    return in_fact_names(df, transaction_date=day_text(F.col("transaction_date")))


def clock(df: DataFrame) -> Column:
    """Time of day as ``HH:mm:ss`` text. A TIME column read over JDBC is a timestamp; ``9:05:00`` has its zero added."""
    time = F.col("transaction_time")
    if isinstance(df.schema["transaction_time"].dataType, (T.TimestampType, T.TimestampNTZType)):
        return clock_text(time)
    text = time.cast("string")
    return F.when(text.rlike(r"^\d:\d\d:\d\d$"), F.concat(F.lit("0"), text)).otherwise(text)


def fact_with_moment(df: DataFrame, with_day: bool = False) -> DataFrame:
    """Fact with a timestamp: ``ts`` where a row has one, else built of date and time. ``with_day`` adds the date, which is known
    also where the time is missing."""
    known = [F.col("ts")] if "ts" in df.columns else []
    apart = "transaction_date" in df.columns and "transaction_time" in df.columns
    built = [moment(F.col("transaction_date"), clock(df))] if apart else []
    when = F.coalesce(*known, *built)
    own_day = [F.col("transaction_date").try_cast("date")] if "transaction_date" in df.columns else []
    added = {"day": day_text(F.coalesce(*own_day, F.to_date(when)))} if with_day else {}
    return in_fact_names(df, ts=when, **added)


def read_layouts(spark: SparkSession, path: str) -> DataFrame:
    """A folder whose files have either layout, or some each. Tasks read the footers and merge the schemas; a column that a file
    lacks is NULL in its rows. A column with one name and two types is an error."""
    return spark.read.option("mergeSchema", True).parquet(path)


def daily_account_totals(fact: DataFrame) -> DataFrame:
    """Transactions and amount per account and day: the fact's own day if it has one, else that of ``ts``. Decimal amounts make the sums independent of row order."""
    return (
        fact.withColumn("day", F.col("day") if "day" in fact.columns else day_text(F.col("ts")))
        .groupBy("account_number", "day")
        .agg(F.count(F.lit(1)).alias("tx_count"), F.sum("amount").cast(MONEY).alias("total_amount"))
    )
