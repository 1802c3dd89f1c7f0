from datetime import date
from decimal import Decimal as D

import pytest

from tallyhouse.plans import marts
from tallyhouse.plans.calendar import calendar_dim, days_between
from tallyhouse.schemas import CATEGORY_COLUMNS, MONTHS
from tests import bank
from tests.conftest import plan_of, rows

DAY = date(2024, 1, 5)


@pytest.fixture
def calender(spark):
    return calendar_dim(days_between(spark, date(2023, 1, 1), date(2024, 12, 31)))


def monthly(spark, calender, lines, people=(("c1", "retirees"),)):
    df = marts.customer_monthly(
        bank.transactions(spark, lines), calender, bank.types(spark), bank.customers(spark, list(people)), date(2024, 12, 31)
    )
    return {row["customer_id"]: row.asDict() for row in df.collect()}


def test_income_and_unknown_types_are_no_expense(spark, calender):
    found = monthly(
        spark,
        calender,
        [
            ("1", DAY, "c1", "m1", "1", "10.00"),
            ("2", DAY, "c1", "m1", "4", "500.00"),
            ("3", DAY, "c1", "m1", "77", "70.00"),
            ("4", DAY, "c1", "m1", None, "70.00"),
            ("5", DAY, "c1", "m1", "9", "1.50"),
        ],
    )
    assert found["c1"]["January"] == D("11.50")


def test_months_of_all_years_are_added_and_empty_months_are_null(spark, calender):
    found = monthly(
        spark,
        calender,
        [("1", date(2023, 1, 9), "c1", "m1", "1", "10.00"), ("2", date(2024, 1, 9), "c1", "m1", "1", "5.25")],
    )
    assert found["c1"]["January"] == D("15.25")
    assert all(found["c1"][m] is None for m in MONTHS if m != "January")


def test_attributes_age_and_unknown_customers(spark, calender):
    found = monthly(
        spark,
        calender,
        [
            ("1", DAY, "c1", "m1", "1", "10.00"),
            ("2", DAY, "c9", "m1", "1", "3.00"),
            ("3", DAY, None, "m1", "1", "4.00"),
            ("4", DAY, None, "m1", "1", "4.00"),
        ],
    )
    assert found["c1"]["first_name"] == "Fc1" and found["c1"]["age"] == 35
    assert found["c9"]["first_name"] is None and found["c9"]["age"] is None and found["c9"]["January"] == D("3.00")
    assert found[None]["January"] == D("8.00")


def test_day_outside_the_calendar_keeps_the_customer_without_a_cell(spark, calender):
    found = monthly(spark, calender, [("1", date(2020, 5, 5), "c1", "m1", "1", "10.00")])
    assert all(found["c1"][m] is None for m in MONTHS)


LINES = [
    ("1", DAY, "c1", "m1", "1", "10.00"),
    ("2", DAY, "c1", "m2", "4", "20.00"),  # income counts in the category marts
    ("3", DAY, "c2", "m3", "1", "5.00"),
    ("4", DAY, "c2", None, "1", "7.00"),  # no merchant
    ("5", DAY, "c2", "zz", "1", "7.00"),  # unknown merchant
    ("6", DAY, "c3", "m9", "1", "9.00"),  # category outside the list
    ("7", DAY, "c9", "m1", "1", "2.00"),  # unknown customer
    ("8", DAY, "c7", "m1", "1", "4.00"),  # customer without a segment
]
PEOPLE = [("c1", "retirees"), ("c2", "retirees"), ("c3", "students"), ("c4", "students"), ("c5", "idle"), ("c7", None)]


def by_segment(df):
    return {row["segment"]: row.asDict() for row in df.collect()}


def inputs(spark, lines=LINES, people=PEOPLE):
    return (
        bank.transactions(spark, lines),
        bank.merchants(spark),
        bank.categories(spark),
        bank.customers(spark, people),
    )


def test_segment_category_amount(spark):
    found = by_segment(marts.segment_category_amount(*inputs(spark)))
    assert set(found) == {"retirees", "students", None}
    assert found["retirees"]["ATM"] == D("10.00")
    assert found["retirees"]["Bill_and_Payments"] == D("20.00")
    assert found["retirees"]["shopping"] == D("5.00")
    assert found["retirees"]["gas"] is None
    assert all(found["students"][c] is None for c in CATEGORY_COLUMNS.values())
    assert found[None]["ATM"] == D("6.00")


def test_count_category_segment_divides_by_all_customers(spark):
    found = by_segment(marts.count_category_segment(*inputs(spark)))
    assert found["retirees"]["ATM"] == D("0.50")
    assert found["retirees"]["gas"] is None
    assert found["students"]["ATM"] is None
    # customers without a segment have no denominator
    assert found[None]["ATM"] is None


def test_ratio_rounds_half_up(spark):
    people = [(f"c{i}", "retirees") for i in range(1, 9)]
    found = by_segment(marts.count_category_segment(*inputs(spark, LINES[:1], people)))
    assert found["retirees"]["ATM"] == D("0.13")


def test_is_essential_avg(spark):
    found = by_segment(marts.is_essential_avg(*inputs(spark)))
    assert found["retirees"] == {"segment": "retirees", "Essential": D("1.00"), "Non_Essential": D("0.50")}
    assert found["students"] == {"segment": "students", "Essential": D("0.50"), "Non_Essential": None}


def test_amounts_of_all_categories_add_up_to_the_total(spark):
    columns = {name: name.replace(" ", "_") for _, name, _ in bank.CATEGORIES}
    found = marts.segment_category_amount(*inputs(spark), columns).collect()
    listed = sum(row[c] or 0 for row in found for c in columns.values())
    assert listed == sum(D(line[5]) for line in LINES if line[3] not in (None, "zz"))


def test_same_result_when_nothing_may_be_broadcast(spark, setting):
    expected = rows(marts.segment_category_amount(*inputs(spark)))
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    df = marts.segment_category_amount(*inputs(spark))
    assert "BroadcastHashJoin" not in plan_of(df)
    assert rows(df) == expected


def test_wide_expense_keys_and_names(spark, calender):
    tables = {
        "transactions": spark.sql("""
            SELECT * FROM VALUES
              ('t1', '20240105', 'c1', 'a1', 'm1', '1', '1', 5.00BD), ('t2', '20240105', 'c1', 'a9', null, '1', '7', 6.00BD),
              ('t3', '20240105', 'c1', 'a1', 'm1', '4', '1', 7.00BD)
            AS t(transaction_id_dd, transaction_date_key, customer_id, account_id, merchant_id, transaction_type_id,
                 channel_id, amount)
        """),
        "categories": bank.categories(spark),
        "merchants": bank.merchants(spark),
        "customers": bank.customers(spark, PEOPLE),
        "accounts": spark.sql("SELECT 'a1' account_number, 'c1' customer_id, 'b1' branch_id"),
        "channels": spark.sql("SELECT '1' channel_id, 'POS' channel_name"),
        "calender": calender,
        "cities": spark.sql("SELECT '34' city_id, 'Istanbul' city_name"),
        "branches": spark.sql("SELECT 'b1' branch_id, 'Main' branch_name, '34' city_id"),
        "transaction_types": bank.types(spark),
    }
    df = marts.wide_expense(tables)
    assert len(set(df.columns)) == len(df.columns)
    found = {row["transaction_id_dd"]: row.asDict() for row in df.collect()}
    assert set(found) == {"t1", "t2"}
    first, second = found["t1"], found["t2"]
    assert first["category_category_name"] == "ATM" and first["city_city_name"] == "Istanbul"
    assert first["branch_branch_name"] == "Main" and first["channel_channel_name"] == "POS"
    assert first["calender_month"] == "January" and first["customer_segment"] == "retirees"
    assert second["merchant_merchant_id"] is None and second["branch_branch_name"] is None
    assert second["channel_channel_id"] is None
