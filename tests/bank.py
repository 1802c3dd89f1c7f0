"""Small hand-made banking tables."""

from datetime import date
from decimal import Decimal

from pyspark.sql import types as T

from tallyhouse import schemas

TYPES = [("1", "payment", False, False), ("4", "salary", False, True), ("9", "transfer_in", True, False)]
CATEGORIES = [("1", "ATM", True), ("2", "Bill and Payments", True), ("3", "shopping", False), ("9", "rent", True)]
MERCHANTS = [("m1", "Cash", "1", "34"), ("m2", "Power", "2", "34"), ("m3", "Shoes", "3", "6"), ("m9", "Flat", "9", "6")]


def some(schema, *names):
    return T.StructType([schema[n] for n in names])


def transactions(spark, lines):
    """(id, day, customer, merchant, type, amount) -> conformed transactions."""
    schema = some(
        schemas.TRANSACTIONS,
        "transaction_id_dd",
        "transaction_date",
        "transaction_date_key",
        "customer_id",
        "merchant_id",
        "transaction_type_id",
        "amount",
    )
    data = [
        (i, day, day.strftime("%Y%m%d") if day else None, customer, merchant, kind, Decimal(amount) if amount else None)
        for i, day, customer, merchant, kind, amount in lines
    ]
    return spark.createDataFrame(data, schema)


def customers(spark, lines):
    """(id, segment) -> customers born on 1990-01-01."""
    schema = some(
        schemas.CUSTOMERS,
        "customer_id",
        "first_name",
        "last_name",
        "date_of_birth",
        "monthly_salary_usd",
        "segment",
    )
    data = [(i, f"F{i}", f"L{i}", date(1990, 1, 1), Decimal("1000.00"), segment) for i, segment in lines]
    return spark.createDataFrame(data, schema)


def types(spark):
    return spark.createDataFrame(TYPES, schemas.TRANSACTION_TYPES)


def categories(spark):
    return spark.createDataFrame(CATEGORIES, schemas.CATEGORIES)


def merchants(spark):
    return spark.createDataFrame(MERCHANTS, schemas.MERCHANTS)
