"""Integrity rules the banking source schema declares (fixed values).

The dictionaries hold the rules of the older layout: ``date_dim`` in place of ``calender`` and ``transaction_datetime``
in place of ``transaction_date``. ``OLDER`` and ``CURRENT`` are the rules of each layout.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from tallyhouse.schemas import PRIMARY_KEY, WAREHOUSE

PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "date_dim": ("date",),
    "cities": ("city_id",),
    "categories": ("category_id",),
    "channels": ("channel_id",),
    "transaction_types": ("transaction_type_id",),
    "branches": ("branch_id",),
    "merchants": ("merchant_id",),
    "customers": ("customer_id",),
    "accounts": ("account_number",),
    "transactions": ("transaction_id", "transaction_datetime"),
}

# child table -> (child column, parent table, parent key)
FOREIGN_KEYS: dict[str, tuple[tuple[str, str, str], ...]] = {
    "categories": (("created_at", "date_dim", "date"), ("updated_at", "date_dim", "date")),
    "channels": (("create_date", "date_dim", "date"), ("update_date", "date_dim", "date")),
    "transaction_types": (("created_at", "date_dim", "date"), ("updated_at", "date_dim", "date")),
    "branches": (("city_id", "cities", "city_id"), ("branch_start_date", "date_dim", "date")),
    "merchants": (("category_id", "categories", "category_id"), ("city_id", "cities", "city_id")),
    "customers": (("date_of_birth", "date_dim", "date"), ("monthly_salary_day", "date_dim", "date")),
    "accounts": (
        ("customer_id", "customers", "customer_id"),
        ("branch_id", "branches", "branch_id"),
        ("account_open_date", "date_dim", "date"),
    ),
    "transactions": (
        ("transaction_datetime", "date_dim", "date"),
        ("account_number", "accounts", "account_number"),
        ("merchant_id", "merchants", "merchant_id"),
        ("customer_id", "customers", "customer_id"),
        ("channel_id", "channels", "channel_id"),
        ("transaction_type_id", "transaction_types", "transaction_type_id"),
    ),
}

NOT_NULL: dict[str, tuple[str, ...]] = {
    "date_dim": (
        "year", "month", "weekday", "isweekend", "isholiday", "isholiday_in_us", "day_in_quarter", "day_in_month",
        "day_in_week",
    ),
    "cities": ("city_name", "country", "is_capital"),
    "categories": ("category_name", "created_at", "updated_at", "risk_level", "is_essential"),
    "channels": ("channel_name", "create_date", "update_date"),
    "transaction_types": ("transaction_type_name", "is_transfer", "is_income", "created_at", "updated_at"),
    "branches": ("branch_name", "city_id", "branch_start_date"),
    "merchants": ("merchant_name", "category_id", "city_id"),
    "customers": ("first_name", "last_name", "date_of_birth", "monthly_salary_day", "num_dependents"),
    "accounts": ("customer_id", "initial_balance", "overdraft_limit", "branch_id", "account_open_date"),
    "transactions": (
        "transaction_id", "transaction_datetime", "account_number", "customer_id", "channel_id",
        "transaction_type_id", "amount", "currency", "is_recurring", "is_salary",
    ),
}

DEFAULTS: dict[str, dict[str, object]] = {
    "date_dim": {"isweekend": False, "isholiday": False, "isholiday_in_us": False},
    "cities": {"is_capital": False},
    "categories": {"risk_level": 0, "is_essential": False},
    "transaction_types": {"is_transfer": False, "is_income": False},
    "customers": {"num_dependents": 0},
    "accounts": {"initial_balance": 0, "overdraft_limit": 0},
    "transactions": {"is_recurring": False, "is_salary": False},
}

MAX_LENGTH: dict[str, dict[str, int]] = {
    "date_dim": {"month": 20, "weekday": 20},
    "cities": {"city_name": 120, "country": 120},
    "categories": {"category_name": 120},
    "channels": {"channel_name": 80},
    "transaction_types": {"transaction_type_name": 120},
    "branches": {"branch_name": 120},
    "merchants": {"merchant_id": 64, "merchant_name": 160},
    "customers": {
        "first_name": 80, "last_name": 80, "gender": 20, "marital_status": 30, "education_level": 60,
        "employment_status": 60, "job_title": 120, "housing": 60,
    },
    "accounts": {"account_number": 32},
    "transactions": {"transaction_id": 64, "account_number": 32, "merchant_id": 64, "currency": 8},
}

PRECISION: dict[str, dict[str, tuple[int, int]]] = {
    "customers": {"annual_income": (14, 2), "credit_score": (6, 2)},
    "accounts": {"initial_balance": (18, 2), "overdraft_limit": (18, 2)},
    "transactions": {"amount": (18, 2), "previous_balance": (18, 2), "balance_after_transaction": (18, 2)},
}

# Month partitions of the fact table: from the first day up to, not including, the second.
MONTH_PARTITIONS = (date(2023, 1, 1), date(2027, 1, 1))

# older name -> name in the current layout
CURRENT_TABLES: dict[str, str] = {"date_dim": "calender"}
CURRENT_COLUMNS: dict[str, dict[str, str]] = {
    "date_dim": {"date": "calender"},
    "transactions": {
        "transaction_id": "transaction_id_dd", "transaction_datetime": "transaction_date", "account_number": "account_id",
    },
}


@dataclass(frozen=True)
class Rules:
    """The declared rules of one layout, by table."""

    primary_keys: Mapping[str, tuple[str, ...]]
    foreign_keys: Mapping[str, tuple[tuple[str, str, str], ...]]
    not_null: Mapping[str, tuple[str, ...]]
    max_length: Mapping[str, Mapping[str, int]]
    precision: Mapping[str, Mapping[str, tuple[int, int]]]


def _current() -> Rules:
    """The older rules under the current names, as far as the warehouse tables have the columns, and the current keys.

    A foreign key whose column has another type than its parent's now is none any more: the salary day is a number there.
    """

    def column(table: str, name: str) -> str:
        return CURRENT_COLUMNS.get(table, {}).get(name, name)

    def field(table: str, name: str):
        fields = {f.name: f for f in WAREHOUSE[CURRENT_TABLES.get(table, table)].fields}
        return fields.get(column(table, name))

    def limits(declared: Mapping[str, Mapping]) -> dict[str, dict]:
        return {
            CURRENT_TABLES.get(t, t): {column(t, c): limit for c, limit in own.items() if field(t, c)}
            for t, own in declared.items()
        }

    foreign = {
        child: tuple(
            (column(child, c), CURRENT_TABLES.get(parent, parent), column(parent, key))
            for c, parent, key in own
            if field(child, c) and field(child, c).dataType == field(parent, key).dataType
        )
        for child, own in FOREIGN_KEYS.items()
    }
    not_null = limits({t: dict.fromkeys(own) for t, own in NOT_NULL.items()})
    return Rules(
        {table: (key,) for table, key in PRIMARY_KEY.items()},
        foreign,
        {table: tuple(own) for table, own in not_null.items()},
        limits(MAX_LENGTH),
        limits(PRECISION),
    )


OLDER = Rules(PRIMARY_KEYS, FOREIGN_KEYS, NOT_NULL, MAX_LENGTH, PRECISION)
CURRENT = _current()
