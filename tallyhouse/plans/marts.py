"""Reporting marts as pure functions of the warehouse tables.

Dimension keys have to be unique: pass ``current_snapshot`` of a dimension that is loaded by appending.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.scalars import age_years
from tallyhouse.operators.lookup import Lookup, star_join
from tallyhouse.operators.pivot import pivot_count, pivot_sum
from tallyhouse.schemas import CATEGORY_COLUMNS, MONEY, MONTHS


def expense_rows(
    transactions: DataFrame, transaction_types: DataFrame, lookups: Sequence[Lookup] = ()
) -> DataFrame:
    """Transactions whose type is known and is no income, with further columns looked up for them.

    An unknown type compares to NULL and is left out. The filter comes before the other lookups.
    """
    kind = Lookup(transaction_types, "transaction_type_id", "transaction_type_id", {"is_income": "is_income"})
    return star_join(transactions, [kind, *lookups], where=~F.col("is_income"))


def customer_monthly(
    transactions: DataFrame,
    calender: DataFrame,
    transaction_types: DataFrame,
    customers: DataFrame,
    as_of: date,
) -> DataFrame:
    """Expenses of a customer by month name, all years together, with the customer's attributes.

    The sums are taken before the customer attributes are attached, so that join meets one row per customer and uses
    the partitioning the aggregate left.
    """
    needed = transactions.select("transaction_date_key", "transaction_type_id", "customer_id", "amount")
    month = Lookup(calender, "transaction_date_key", "date_key", {"month": "month"})
    spent = expense_rows(needed, transaction_types, [month])
    monthly = pivot_sum(spent, "customer_id", "month", {name: name for name in MONTHS}, "amount")
    attributes = customers.select(
        "customer_id",
        "first_name",
        "last_name",
        "monthly_salary_usd",
        age_years(F.col("date_of_birth"), as_of).alias("age"),
    )
    return monthly.join(attributes, "customer_id", "left").select(
        "customer_id",
        "first_name",
        "last_name",
        "monthly_salary_usd",
        "age",
        *MONTHS,
    )


def segment_size(customers: DataFrame) -> DataFrame:
    """Customers per segment, active or not."""
    return customers.groupBy("segment").agg(F.count(F.lit(1)).alias("customers"))


def _labelled(transactions: DataFrame, merchants: DataFrame, categories: DataFrame, attribute: str) -> DataFrame:
    """Every transaction with one attribute of its merchant's category; NULL when there is none."""
    of_category = Lookup(categories, "category_id", "category_id", {attribute: attribute})
    of_merchant = Lookup(
        merchants, "merchant_id", "merchant_id", {"category_id": "category_id"}, attached=[of_category], large=True
    )
    return star_join(transactions.select("merchant_id", "customer_id", "amount"), [of_merchant])


def _by_segment(per_customer: DataFrame, customers: DataFrame) -> DataFrame:
    """Add the cells of the customers up per segment; unknown customers form the row without a segment.

    The transactions are reduced to one row per customer before: a busy customer or segment costs one row per task.
    """
    cells = [name for name in per_customer.columns if name != "customer_id"]
    with_segment = per_customer.join(customers.select("customer_id", "segment"), "customer_id", "left")
    return with_segment.groupBy("segment").agg(*[F.sum(name).alias(name) for name in cells])


def _per_head(by_segment: DataFrame, customers: DataFrame) -> DataFrame:
    """Cells divided by the number of customers in the segment. Both sides hold one row per segment."""
    cells = [name for name in by_segment.columns if name != "segment"]
    sized = by_segment.join(segment_size(customers), "segment", "left")
    return sized.select("segment", *[(F.col(name) / F.col("customers")).cast(MONEY).alias(name) for name in cells])


def segment_category_amount(
    transactions: DataFrame,
    merchants: DataFrame,
    categories: DataFrame,
    customers: DataFrame,
    columns: Mapping[str, str] = CATEGORY_COLUMNS,
) -> DataFrame:
    """Amount per segment and listed category, income included. An unknown merchant counts in no category."""
    labelled = _labelled(transactions, merchants, categories, "category_name")
    summed = _by_segment(pivot_sum(labelled, "customer_id", "category_name", columns, "amount"), customers)
    return summed.select("segment", *[F.col(name).cast(MONEY).alias(name) for name in columns.values()])


def count_category_segment(
    transactions: DataFrame,
    merchants: DataFrame,
    categories: DataFrame,
    customers: DataFrame,
    columns: Mapping[str, str] = CATEGORY_COLUMNS,
) -> DataFrame:
    """Transactions per customer of the segment, by listed category."""
    labelled = _labelled(transactions, merchants, categories, "category_name")
    counted = _by_segment(pivot_count(labelled, "customer_id", "category_name", columns), customers)
    return _per_head(counted, customers)


def is_essential_avg(
    transactions: DataFrame, merchants: DataFrame, categories: DataFrame, customers: DataFrame
) -> DataFrame:
    """Essential and other transactions per customer of the segment."""
    columns = {True: "Essential", False: "Non_Essential"}
    labelled = _labelled(transactions, merchants, categories, "is_essential")
    return _per_head(_by_segment(pivot_count(labelled, "customer_id", "is_essential", columns), customers), customers)


def wide_expense(tables: Mapping[str, DataFrame], colocated: str | None = None, bounded: str | None = None) -> DataFrame:
    """Expense transactions with every dimension, each column prefixed by its table.

    Keys: the category and the city come through the merchant, the branch through the account. ``colocated``
    names the table that is stored in the same buckets as the transactions, ``bounded`` one that has few rows whatever the data.
    """

    def attributes(table: str, prefix: str) -> dict[str, str]:
        return {c: f"{prefix}_{c}" for c in tables[table].columns}

    def placed(table: str) -> dict[str, bool]:
        return {"large": True, "colocated": table == colocated, "bounded": table == bounded}

    fact = tables["transactions"].select(
        *[F.col(c).alias(f"transaction_{c.removeprefix('transaction_')}") for c in tables["transactions"].columns]
    )
    kind = Lookup(
        tables["transaction_types"],
        "transaction_type_id",
        "transaction_type_id",
        attributes("transaction_types", "type"),
    )
    return star_join(
        fact,
        [
            kind,
            Lookup(tables["channels"], "transaction_channel_id", "channel_id", attributes("channels", "channel")),
            Lookup(tables["calender"], "transaction_date_key", "date_key", attributes("calender", "calender")),
            Lookup(
                tables["merchants"],
                "transaction_merchant_id",
                "merchant_id",
                attributes("merchants", "merchant"),
                attached=[
                    Lookup(
                        tables["categories"],
                        "merchant_category_id",
                        "category_id",
                        attributes("categories", "category"),
                    ),
                    Lookup(tables["cities"], "merchant_city_id", "city_id", attributes("cities", "city")),
                ],
                **placed("merchants"),
            ),
            Lookup(
                tables["customers"],
                "transaction_customer_id",
                "customer_id",
                attributes("customers", "customer"),
                **placed("customers"),
            ),
            Lookup(
                tables["accounts"],
                "transaction_account_id",
                "account_number",
                attributes("accounts", "account"),
                attached=[Lookup(tables["branches"], "account_branch_id", "branch_id", attributes("branches", "branch"))],
                **placed("accounts"),
            ),
        ],
        where=~F.col("type_is_income"),
    )
