"""Table schemas: raw files, warehouse tables, marts and the older transaction layout.

The column names and types are fixed values: they have to equal the tables that downstream users read today.
"""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, DATE, INT, FLAG = T.StringType(), T.DateType(), T.IntegerType(), T.BooleanType()
AMOUNT = T.DecimalType(18, 2)
MONEY = "decimal(18,2)"


def table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# --- warehouse tables (fixed values) -------------------------------------------------------------------------------
ACCOUNTS = table(
    account_number=TEXT, customer_id=TEXT, initial_balance=AMOUNT, overdraft_limit=AMOUNT, branch_id=TEXT,
    account_open_date=DATE,
)
BRANCHES = table(branch_id=TEXT, branch_name=TEXT, city_id=TEXT, branch_start_date=DATE)
CALENDER = table(
    date_key=TEXT, calender=DATE, year=INT, quarter=INT, day=INT, month=TEXT, weekday=TEXT, week_of_year=INT,
    isweekend=FLAG, isholiday=FLAG, isholiday_in_us=FLAG, day_in_year=INT, day_in_quarter=INT,
    day_in_month=INT, day_in_week=INT,
)
CATEGORIES = table(category_id=TEXT, category_name=TEXT, is_essential=FLAG)
CHANNELS = table(channel_id=TEXT, channel_name=TEXT)
CITIES = table(city_id=TEXT, city_name=TEXT)
CUSTOMERS = table(
    customer_id=TEXT, first_name=TEXT, last_name=TEXT, date_of_birth=DATE, gender=TEXT, marital_status=TEXT,
    education_level=TEXT, employment_status=TEXT, job_title=TEXT, housing=TEXT, monthly_salary_usd=AMOUNT,
    monthly_passive_income_usd=AMOUNT, monthly_rent_in_usd=AMOUNT, monthly_rent_out_usd=AMOUNT,
    annual_income=AMOUNT, monthly_salary_day=INT, bill_responsible=FLAG, bills_due_day=AMOUNT, is_renter=FLAG,
    rent_due_day=AMOUNT, credit_score=INT, num_dependents=INT, segment=TEXT, has_passive_income=FLAG,
    has_real_estate_income=FLAG,
)
MERCHANTS = table(merchant_id=TEXT, merchant_name=TEXT, category_id=TEXT, city_id=TEXT)
TRANSACTION_TYPES = table(
    transaction_type_id=TEXT, transaction_type_name=TEXT, is_transfer=FLAG, is_income=FLAG,
)
TRANSACTIONS = table(
    transaction_id_dd=TEXT, transaction_date=DATE, transaction_time=TEXT, transaction_date_key=TEXT,
    customer_id=TEXT, account_id=TEXT, merchant_id=TEXT, branch_id=TEXT, channel_id=TEXT,
    transaction_type_id=TEXT, amount=AMOUNT, currency=TEXT, is_recurring=FLAG, is_salary=FLAG,
    previous_balance=AMOUNT, balance_after_transaction=AMOUNT,
)

WAREHOUSE: dict[str, T.StructType] = {
    "accounts": ACCOUNTS,
    "branches": BRANCHES,
    "calender": CALENDER,
    "categories": CATEGORIES,
    "channels": CHANNELS,
    "cities": CITIES,
    "customers": CUSTOMERS,
    "merchants": MERCHANTS,
    "transaction_types": TRANSACTION_TYPES,
    "transactions": TRANSACTIONS,
}

PRIMARY_KEY: dict[str, str] = {
    "accounts": "account_number",
    "branches": "branch_id",
    "calender": "date_key",
    "categories": "category_id",
    "channels": "channel_id",
    "cities": "city_id",
    "customers": "customer_id",
    "merchants": "merchant_id",
    "transaction_types": "transaction_type_id",
    "transactions": "transaction_id_dd",
}

# Tables that carry no load stamp.
WITHOUT_ETL_DATE = frozenset({"calender", "cities"})

# --- raw files (fixed values): like the warehouse, but for two city columns that conforming leaves out ---------------
RAW_CITIES = table(city_id=TEXT, city_name=TEXT, country=TEXT, is_capital=FLAG)
RAW: dict[str, T.StructType] = {**WAREHOUSE, "cities": RAW_CITIES}
RAW_FILES: dict[str, str] = {table: f"{table}.csv" for table in WAREHOUSE}

# --- the older transaction layout (fixed values) ----------------------------------------------------------------------
LEGACY_RAW = table(
    transaction_id=TEXT, account_number=TEXT, customer_id=TEXT, transaction_date=DATE, transaction_time=TEXT,
    transaction_amount=T.DecimalType(12, 2), transaction_type=TEXT, merchant_description=TEXT, category=TEXT,
    balance_after_transaction=AMOUNT, location=TEXT, channel=TEXT,
)

# --- reporting lists (fixed values) -----------------------------------------------------------------------------------
MONTHS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)

# category name in the data -> column of the mart
CATEGORY_COLUMNS: dict[str, str] = {
    "ATM": "ATM",
    "Bill and Payments": "Bill_and_Payments",
    "Entertainment": "Entertainment",
    "transportation": "transportation",
    "healthcare": "healthcare",
    "shopping": "shopping",
    "grocery": "grocery",
    "restaurant": "restaurant",
    "gas": "gas",
}
