"""The registered queries as SQL over the driver's tables, written from the definitions and not from the Spark plans."""

from __future__ import annotations

from tallyhouse.schemas import MONTHS

AS_OF = "DATE '2002-01-01'"
CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL")

CATEGORY_ROWS = """
  cat(category_id, category_name, is_essential) AS (VALUES
    ('ECONOMY', 'ECONOMY', true), ('LARGE', 'LARGE', false), ('MEDIUM', 'MEDIUM', false),
    ('PROMO', 'PROMO', false), ('SMALL', 'SMALL', true), ('STANDARD', 'STANDARD', true))"""
TYPE_ROWS = """
  typ(transaction_type_id, transaction_type_name, is_transfer, is_income) AS (VALUES
    ('A', 'accepted', false, false), ('N', 'new', true, false), ('R', 'returned', false, true))"""
CHANNEL_ROWS = "chan(channel_id, channel_name) AS (VALUES ('F', 'branch'), ('O', 'online'))"

TRANSACTIONS = """
  tx AS (
    SELECT l_orderkey || '-' || l_linenumber AS transaction_id_dd,
           CAST(l_shipdate AS DATE) AS transaction_date,
           strftime(l_shipdate, '%H:%M:%S') AS transaction_time,
           strftime(l_shipdate, '%Y%m%d') AS transaction_date_key,
           CAST(o_custkey AS VARCHAR) AS customer_id,
           CAST(l_orderkey AS VARCHAR) AS account_id,
           CAST(l_partkey AS VARCHAR) AS merchant_id,
           CAST(l_suppkey AS VARCHAR) AS branch_id,
           l_linestatus AS channel_id,
           l_returnflag AS transaction_type_id,
           CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
           'USD' AS currency
    FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey)"""

CALENDAR_COLUMNS = """
       strftime(d, '%Y%m%d') AS date_key, d AS calender, year(d) AS year, quarter(d) AS quarter, day(d) AS day,
       monthname(d) AS month, dayname(d) AS weekday, week(d) AS week_of_year, isodow(d) >= 6 AS isweekend"""
CALENDAR_COUNTS = """
       dayofyear(d) AS day_in_year, date_diff('day', CAST(date_trunc('quarter', d) AS DATE), d) + 1 AS day_in_quarter,
       day(d) AS day_in_month, isodow(d) AS day_in_week"""

CUSTOMER_COLUMNS = """
       CAST(c_custkey AS VARCHAR) AS customer_id, split_part(c_name, '#', 1) AS first_name,
       split_part(c_name, '#', 2) AS last_name, make_date(c_nationkey + 1950, 1, 1) AS date_of_birth,
       CAST(c_acctbal AS DECIMAL(18,2)) AS monthly_salary_usd, c_mktsegment AS segment"""
ACCOUNT_COLUMNS = """
       CAST(o_orderkey AS VARCHAR) AS account_number, CAST(o_custkey AS VARCHAR) AS customer_id,
       CAST(o_totalprice AS DECIMAL(18,2)) AS initial_balance, CAST(day(o_orderdate) AS VARCHAR) AS branch_id,
       CAST(o_orderdate AS DATE) AS account_open_date"""


def _customer_monthly(type_filter: str) -> str:
    cells = ",\n       ".join(
        f"CAST(sum(amount) FILTER (monthname(transaction_date) = '{m}') AS DECIMAL(18,2)) AS \"{m}\"" for m in MONTHS
    )
    months = ", ".join(f'"{m}"' for m in MONTHS)
    return f"""
WITH {TYPE_ROWS}, {TRANSACTIONS},
  spent AS (
    SELECT customer_id,
       {cells}
    FROM tx JOIN typ USING (transaction_type_id)
    WHERE NOT is_income AND {type_filter}
    GROUP BY customer_id),
  cust AS (SELECT {CUSTOMER_COLUMNS} FROM customer)
SELECT s.customer_id, first_name, last_name, monthly_salary_usd,
       CAST(floor(date_diff('day', date_of_birth, {AS_OF}) / 365) AS BIGINT) AS age, {months}
FROM spent s LEFT JOIN cust ON s.customer_id = cust.customer_id"""


_LABELLED = f"""
WITH {CATEGORY_ROWS}, {TRANSACTIONS},
  labelled AS (
    SELECT c_mktsegment AS segment, category_name, is_essential, amount
    FROM tx LEFT JOIN part ON merchant_id = CAST(p_partkey AS VARCHAR)
            LEFT JOIN cat ON category_id = p_type
            LEFT JOIN customer ON customer_id = CAST(c_custkey AS VARCHAR)),
  sized AS (SELECT c_mktsegment AS segment, count(*) AS n FROM customer GROUP BY 1)"""


def _ratio(condition: str, name: str) -> str:
    count = f"nullif(count(*) FILTER ({condition}), 0)"
    return f"CAST({count} / max(CAST(n AS DOUBLE)) AS DECIMAL(18,2)) AS {name}"


def _segment_ratio(cells: list[str]) -> str:
    return f"""{_LABELLED}
SELECT l.segment, {", ".join(cells)}
FROM labelled l LEFT JOIN sized s ON l.segment = s.segment
GROUP BY l.segment"""


def _segment_amount() -> str:
    cells = ", ".join(
        f"CAST(sum(amount) FILTER (category_name = '{c}') AS DECIMAL(18,2)) AS {c.lower()}" for c in CATEGORIES
    )
    return f"{_LABELLED}\nSELECT segment, {cells} FROM labelled GROUP BY segment"


_WIDE = f"""
WITH {CATEGORY_ROWS}, {TYPE_ROWS}, {CHANNEL_ROWS}, {TRANSACTIONS},
  cust AS (SELECT {CUSTOMER_COLUMNS} FROM customer),
  acc AS (SELECT {ACCOUNT_COLUMNS} FROM orders),
  days AS (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS d),
  cal AS (SELECT {CALENDAR_COLUMNS}, false AS isholiday, false AS isholiday_in_us, {CALENDAR_COUNTS} FROM days)
SELECT tx.transaction_id_dd, tx.transaction_date, tx.transaction_time, tx.transaction_date_key,
       tx.customer_id AS transaction_customer_id, tx.account_id AS transaction_account_id,
       tx.merchant_id AS transaction_merchant_id, tx.branch_id AS transaction_branch_id,
       tx.channel_id AS transaction_channel_id, tx.transaction_type_id, tx.amount AS transaction_amount,
       tx.currency AS transaction_currency,
       typ.transaction_type_id AS type_transaction_type_id, typ.transaction_type_name AS type_transaction_type_name,
       typ.is_transfer AS type_is_transfer, typ.is_income AS type_is_income,
       chan.channel_id AS channel_channel_id, chan.channel_name AS channel_channel_name,
       cal.date_key AS calender_date_key, cal.calender AS calender_calender, cal.year AS calender_year,
       cal.quarter AS calender_quarter, cal.day AS calender_day, cal.month AS calender_month,
       cal.weekday AS calender_weekday, cal.week_of_year AS calender_week_of_year,
       cal.isweekend AS calender_isweekend, cal.isholiday AS calender_isholiday,
       cal.isholiday_in_us AS calender_isholiday_in_us, cal.day_in_year AS calender_day_in_year,
       cal.day_in_quarter AS calender_day_in_quarter, cal.day_in_month AS calender_day_in_month,
       cal.day_in_week AS calender_day_in_week,
       CAST(p_partkey AS VARCHAR) AS merchant_merchant_id, p_name AS merchant_merchant_name,
       p_type AS merchant_category_id, CAST(p_size AS VARCHAR) AS merchant_city_id,
       cat.category_id AS category_category_id, cat.category_name AS category_category_name,
       cat.is_essential AS category_is_essential,
       CAST(n_nationkey AS VARCHAR) AS city_city_id, n_name AS city_city_name,
       cust.customer_id AS customer_customer_id, cust.first_name AS customer_first_name,
       cust.last_name AS customer_last_name, cust.date_of_birth AS customer_date_of_birth,
       cust.monthly_salary_usd AS customer_monthly_salary_usd, cust.segment AS customer_segment,
       acc.account_number AS account_account_number, acc.customer_id AS account_customer_id,
       acc.initial_balance AS account_initial_balance, acc.branch_id AS account_branch_id,
       acc.account_open_date AS account_account_open_date,
       CAST(s_suppkey AS VARCHAR) AS branch_branch_id, s_name AS branch_branch_name,
       CAST(s_nationkey AS VARCHAR) AS branch_city_id
FROM tx
  LEFT JOIN typ ON tx.transaction_type_id = typ.transaction_type_id
  LEFT JOIN chan ON tx.channel_id = chan.channel_id
  LEFT JOIN cal ON tx.transaction_date_key = cal.date_key
  LEFT JOIN part ON tx.merchant_id = CAST(p_partkey AS VARCHAR)
  LEFT JOIN cat ON p_type = cat.category_id
  LEFT JOIN nation ON p_size = n_nationkey
  LEFT JOIN cust ON tx.customer_id = cust.customer_id
  LEFT JOIN acc ON tx.account_id = acc.account_number
  LEFT JOIN supplier ON acc.branch_id = CAST(s_suppkey AS VARCHAR)
WHERE typ.is_income = false"""

_LEGACY_TEXT = "CAST(NULL AS VARCHAR) AS category, CAST(NULL AS VARCHAR) AS location, CAST(NULL AS VARCHAR) AS channel"
_LEGACY_MOMENT = f"""
    SELECT CAST(event_id AS VARCHAR) AS transaction_id, CAST(user_id AS VARCHAR) AS account_number,
           CAST(user_id AS VARCHAR) AS customer_id, CAST(date_trunc('second', ts) AS TIMESTAMP) AS ts,
           CAST(value AS DECIMAL(18,2)) AS amount, event_type AS type, {_LEGACY_TEXT}
    FROM events"""

_DAY_SUMMARY = """
SELECT CAST(l_shipdate AS DATE) AS transaction_date, count(*) AS rows,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS amount
FROM lineitem"""
_STAGED = """
WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-08-31'
  AND (CAST(l_shipdate AS DATE) < DATE '1996-03-01' OR l_returnflag <> 'R'
       OR CAST(l_shipdate AS DATE) <= DATE '1996-06-30' AND CAST(l_shipdate AS DATE) NOT IN (
         SELECT CAST(l_shipdate AS DATE) FROM lineitem WHERE l_returnflag <> 'R'))"""
_IN_WINDOW = "CAST(l_shipdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-28'"


def _nulls(table: str, source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) AS rows, count(*) - count({c}) AS nulls "
        f"FROM {source}"
        for c in columns
    )


_NULL_FACT = """(
  SELECT l_orderkey || '-' || l_linenumber AS transaction_id_dd, l_shipdate AS transaction_date,
         l_shipdate AS transaction_time, l_shipdate AS transaction_date_key, NULL AS customer_id,
         l_orderkey AS account_id, l_partkey AS merchant_id, l_suppkey AS branch_id, l_linestatus AS channel_id,
         l_returnflag AS transaction_type_id, l_extendedprice AS amount, 'USD' AS currency, NULL AS is_recurring,
         NULL AS is_salary, NULL AS previous_balance, NULL AS balance_after_transaction
  FROM lineitem)"""

_NULL_PROFILE = " UNION ALL ".join(
    [
        _nulls(
            "transactions",
            _NULL_FACT,
            [
                "transaction_id_dd", "transaction_date", "transaction_time", "transaction_date_key", "customer_id",
                "account_id", "merchant_id", "branch_id", "channel_id", "transaction_type_id", "amount", "currency",
                "is_recurring", "is_salary", "previous_balance", "balance_after_transaction",
            ],
        ),
        _nulls(
            "orders",
            "orders",
            ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
        ),
        _nulls("customer", "customer", ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]),
        _nulls("part", "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]),
        _nulls("events", "events", ["event_id", "ts", "user_id", "event_type", "value", "props"]),
    ]
)


def _orphans(rule: str, child: str, column: str, parent: str, key: str, parent_filter: str = "true") -> str:
    return f"""
SELECT '{rule}' AS rule, count(DISTINCT {column}) AS orphan_values, count(*) AS orphan_rows
FROM {child}
WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {parent} WHERE {parent_filter})
HAVING count(*) > 0"""


_FK = " UNION ALL ".join(
    [
        _orphans("transactions.account", "lineitem", "l_orderkey", "orders", "o_orderkey"),
        _orphans("transactions.merchant", "lineitem", "l_partkey", "part", "p_partkey"),
        _orphans("transactions.branch", "lineitem", "l_suppkey", "supplier", "s_suppkey"),
        _orphans("accounts.customer", "orders", "o_custkey", "customer", "c_custkey"),
        _orphans("merchants.city", "part", "p_size", "nation", "n_nationkey"),
    ]
)


def _contract_line(table: str, column: str, expected: str, actual: str | None, duck_type: str) -> str:
    actual_sql = f"'{actual}'" if actual else "CAST(NULL AS VARCHAR)"
    bad = (
        f"count(*) FILTER ({column} IS NOT NULL AND TRY_CAST({column} AS {duck_type}) IS NULL)"
        if actual
        else "CAST(NULL AS BIGINT)"
    )
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{expected}' AS expected_type, "
        f"{actual_sql} AS actual_type, count(*) AS rows, {bad} AS unconvertible FROM {table}"
    )


_CONTRACT = " UNION ALL ".join(
    [
        _contract_line("orders", "o_orderkey", "bigint", "bigint", "BIGINT"),
        _contract_line("orders", "o_custkey", "string", "bigint", "VARCHAR"),
        _contract_line("orders", "o_totalprice", "decimal(8,2)", "double", "DECIMAL(8,2)"),
        _contract_line("orders", "o_orderdate", "date", "timestamp_ntz", "DATE"),
        _contract_line("orders", "o_orderpriority", "int", "string", "INTEGER"),
        _contract_line("customer", "c_custkey", "bigint", "bigint", "BIGINT"),
        _contract_line("customer", "c_name", "string", "string", "VARCHAR"),
        _contract_line("customer", "c_acctbal", "decimal(6,2)", "double", "DECIMAL(6,2)"),
        _contract_line("customer", "c_mktsegment", "boolean", "string", "BOOLEAN"),
        _contract_line("part", "p_partkey", "bigint", "bigint", "BIGINT"),
        _contract_line("part", "p_size", "tinyint", "int", "TINYINT"),
        _contract_line("part", "p_color", "string", None, "VARCHAR"),
    ]
)


def _audit_line(rule: str, table: str, column: str, violations: str) -> str:
    return (
        f"SELECT '{rule}' AS rule, '{table}' AS table_name, '{column}' AS column_name, "
        f"{str(violations != 'NULL').lower()} AS checked, CAST(({violations}) AS BIGINT) AS violations"
    )


def _audit_count(rule: str, table: str, column: str, source: str, condition: str) -> str:
    return _audit_line(rule, table, column, f"SELECT count(*) FILTER ({condition}) FROM {source}")


def _audit_key(table: str, column: str, source: str, key: str) -> str:
    return _audit_line(
        "primary_key", table, column,
        f"SELECT count(*) FROM (SELECT {key} AS k FROM {source} GROUP BY 1 HAVING count(*) > 1 OR k IS NULL)",
    )


def _audit_orphans(table: str, column: str, source: str, value: str, parents: str) -> str:
    return _audit_count("foreign_key", table, column, source, f"{value} NOT IN (SELECT {parents})")


_FIRST_DAY, _LAST_DAY = "DATE '1995-01-01'", "DATE '2001-12-31'"
_AUDIT_DAYS = f"(SELECT CAST(unnest(generate_series({_FIRST_DAY}, {_LAST_DAY}, INTERVAL 1 DAY)) AS DATE) AS d)"
# Rules on tables and columns that the driver's tables have no source for: rule, table, columns.
_AUDIT_UNCHECKED = [
    ("not_null", "categories", "category_name is_essential"),
    ("not_null", "channels", "channel_name"),
    ("not_null", "transaction_types", "transaction_type_name is_transfer is_income"),
    ("not_null", "branches", "branch_start_date"),
    ("not_null", "customers", "monthly_salary_day num_dependents"),
    ("not_null", "accounts", "overdraft_limit"),
    ("not_null", "transactions", "customer_id is_recurring is_salary"),
    ("max_length", "categories", "category_name"),
    ("max_length", "channels", "channel_name"),
    ("max_length", "transaction_types", "transaction_type_name"),
    ("max_length", "customers", "gender marital_status education_level employment_status job_title housing"),
    ("precision", "customers", "annual_income credit_score"),
    ("precision", "accounts", "overdraft_limit"),
    ("precision", "transactions", "previous_balance balance_after_transaction"),
    ("primary_key", "categories", "category_id"),
    ("primary_key", "channels", "channel_id"),
    ("primary_key", "transaction_types", "transaction_type_id"),
    ("foreign_key", "branches", "branch_start_date"),
    ("foreign_key", "merchants", "category_id"),
    ("foreign_key", "transactions", "customer_id channel_id transaction_type_id"),
]
_TX_ID = "l_orderkey || '-' || l_linenumber"

_AUDIT = " UNION ALL ".join(
    [
        _audit_count("not_null", "cities", "city_name", "nation", "n_name IS NULL"),
        *[
            _audit_count("not_null", "calender", name, _AUDIT_DAYS, "d IS NULL")
            for name in (
                "year", "month", "weekday", "isweekend", "isholiday", "isholiday_in_us", "day_in_quarter",
                "day_in_month", "day_in_week",
            )
        ],
        _audit_count("max_length", "calender", "month", _AUDIT_DAYS, "length(monthname(d)) > 20"),
        _audit_count("max_length", "calender", "weekday", _AUDIT_DAYS, "length(dayname(d)) > 20"),
        _audit_key("calender", "date_key", _AUDIT_DAYS, "d"),
        *[_audit_line(rule, table, name, "NULL") for rule, table, names in _AUDIT_UNCHECKED for name in names.split()],
        _audit_count("max_length", "cities", "city_name", "nation", "length(n_name) > 120"),
        _audit_key("cities", "city_id", "nation", "n_nationkey"),
        _audit_count("not_null", "branches", "branch_name", "supplier", "s_name IS NULL"),
        _audit_count("not_null", "branches", "city_id", "supplier", "s_nationkey IS NULL"),
        _audit_count("max_length", "branches", "branch_name", "supplier", "length(s_name) > 120"),
        _audit_key("branches", "branch_id", "supplier", "s_suppkey"),
        _audit_orphans("branches", "city_id", "supplier", "s_nationkey", "n_nationkey FROM nation"),
        _audit_count("not_null", "merchants", "merchant_name", "part", "p_name IS NULL"),
        _audit_count("not_null", "merchants", "category_id", "part", "p_type IS NULL"),
        _audit_count("not_null", "merchants", "city_id", "part", "p_size IS NULL"),
        _audit_count("max_length", "merchants", "merchant_id", "part", "length(CAST(p_partkey AS VARCHAR)) > 64"),
        _audit_count("max_length", "merchants", "merchant_name", "part", "length(p_name) > 160"),
        _audit_key("merchants", "merchant_id", "part", "p_partkey"),
        _audit_orphans("merchants", "city_id", "part", "p_size", "n_nationkey FROM nation"),
        _audit_count("not_null", "customers", "first_name", "customer", "split_part(c_name, '#', 1) IS NULL"),
        _audit_count("not_null", "customers", "last_name", "customer", "split_part(c_name, '#', 2) IS NULL"),
        _audit_count("not_null", "customers", "date_of_birth", "customer", "c_nationkey IS NULL"),
        _audit_count("max_length", "customers", "first_name", "customer", "length(split_part(c_name, '#', 1)) > 80"),
        _audit_count("max_length", "customers", "last_name", "customer", "length(split_part(c_name, '#', 2)) > 80"),
        _audit_key("customers", "customer_id", "customer", "c_custkey"),
        _audit_count(
            "foreign_key", "customers", "date_of_birth", "customer",
            f"make_date(1950 + c_nationkey, 1, 1) NOT BETWEEN {_FIRST_DAY} AND {_LAST_DAY}",
        ),
        _audit_count("not_null", "accounts", "customer_id", "orders", "o_custkey IS NULL"),
        _audit_count("not_null", "accounts", "initial_balance", "orders", "o_totalprice IS NULL"),
        _audit_count("not_null", "accounts", "branch_id", "orders", "o_orderdate IS NULL"),
        _audit_count("not_null", "accounts", "account_open_date", "orders", "o_orderdate IS NULL"),
        _audit_count("max_length", "accounts", "account_number", "orders", "length(CAST(o_orderkey AS VARCHAR)) > 32"),
        _audit_count(
            "precision", "accounts", "initial_balance", "orders",
            "o_totalprice IS NOT NULL AND TRY_CAST(o_totalprice AS DECIMAL(18,2)) IS NULL",
        ),
        _audit_key("accounts", "account_number", "orders", "o_orderkey"),
        _audit_orphans("accounts", "customer_id", "orders", "o_custkey", "c_custkey FROM customer"),
        _audit_count(
            "foreign_key", "accounts", "account_open_date", "orders",
            f"CAST(o_orderdate AS DATE) NOT BETWEEN {_FIRST_DAY} AND {_LAST_DAY}",
        ),
        _audit_orphans("accounts", "branch_id", "orders", "day(o_orderdate)", "s_suppkey FROM supplier"),
        _audit_count("not_null", "transactions", "transaction_id_dd", "lineitem", f"{_TX_ID} IS NULL"),
        _audit_count("not_null", "transactions", "transaction_date", "lineitem", "l_shipdate IS NULL"),
        _audit_count("not_null", "transactions", "account_id", "lineitem", "l_orderkey IS NULL"),
        _audit_count("not_null", "transactions", "channel_id", "lineitem", "l_linestatus IS NULL"),
        _audit_count("not_null", "transactions", "transaction_type_id", "lineitem", "l_returnflag IS NULL"),
        _audit_count("not_null", "transactions", "amount", "lineitem", "l_extendedprice IS NULL"),
        _audit_count("not_null", "transactions", "currency", "lineitem", "false"),
        _audit_count("max_length", "transactions", "transaction_id_dd", "lineitem", f"length({_TX_ID}) > 64"),
        _audit_count("max_length", "transactions", "account_id", "lineitem", "length(CAST(l_orderkey AS VARCHAR)) > 32"),
        _audit_count("max_length", "transactions", "merchant_id", "lineitem", "length(CAST(l_partkey AS VARCHAR)) > 64"),
        _audit_count("max_length", "transactions", "currency", "lineitem", "length('USD') > 8"),
        _audit_count(
            "precision", "transactions", "amount", "lineitem",
            "l_extendedprice IS NOT NULL AND TRY_CAST(l_extendedprice AS DECIMAL(18,2)) IS NULL",
        ),
        _audit_key("transactions", "transaction_id_dd", "lineitem", _TX_ID),
        _audit_count(
            "foreign_key", "transactions", "transaction_date", "lineitem",
            f"CAST(l_shipdate AS DATE) NOT BETWEEN {_FIRST_DAY} AND {_LAST_DAY}",
        ),
        _audit_orphans("transactions", "account_id", "lineitem", "l_orderkey", "o_orderkey FROM orders"),
        _audit_orphans("transactions", "merchant_id", "lineitem", "l_partkey", "p_partkey FROM part"),
    ]
)


_KEY_CHECK = """
WITH lines AS (
    SELECT l_orderkey || '-' || l_linenumber AS id, l_linenumber AS number, CAST(l_shipdate AS DATE) AS d, l_partkey, l_suppkey
    FROM lineitem),
  new AS (SELECT * FROM lines WHERE d BETWEEN DATE '1997-04-01' AND DATE '1997-06-30'),
  old AS (SELECT * FROM lines WHERE d BETWEEN DATE '1996-01-01' AND DATE '1996-12-28'),
  load AS (SELECT * FROM new UNION ALL SELECT * FROM new WHERE number = 2 UNION ALL SELECT * FROM old WHERE number = 3),
  counted AS (SELECT id, count(*) AS rows FROM load GROUP BY 1)
SELECT 'repeated in the load' AS rule, 'transaction_id_dd' AS column_name, id AS value, rows FROM counted WHERE rows > 1
UNION ALL SELECT 'held by another day', 'transaction_id_dd', id, rows FROM counted WHERE id IN (SELECT id FROM old)
UNION ALL SELECT 'no parent', 'merchant_id', CAST(l_partkey AS VARCHAR), count(*) FROM load
  WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 25) GROUP BY l_partkey
UNION ALL SELECT 'no parent', 'branch_id', CAST(l_suppkey AS VARCHAR), count(*) FROM load
  WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier) GROUP BY l_suppkey
UNION ALL SELECT 'missing', 'channel_id', NULL, count(*) FROM load WHERE number = 5 HAVING count(*) > 0"""

_HOLIDAYS = """
WITH bounds AS (
    SELECT min(d) AS lo, max(d) AS hi
    FROM (SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem UNION ALL SELECT CAST(o_orderdate AS DATE) FROM orders)),
  wide AS (
    SELECT CAST(unnest(generate_series(date_trunc('year', lo) - INTERVAL 1 YEAR, date_trunc('year', hi) + INTERVAL 2 YEAR, INTERVAL 1 DAY)) AS DATE) AS d
    FROM bounds),
  placed AS (
    SELECT d, year(d) AS y, month(d) AS m, day(d) AS n, isodow(d) AS w,
           row_number() OVER (PARTITION BY year(d), month(d), isodow(d) ORDER BY d) AS nth,
           row_number() OVER (PARTITION BY year(d), month(d), isodow(d) ORDER BY d DESC) AS nth_last
    FROM wide),
  -- Gauss's rule for Easter in the years 1900 to 2099, with its two exceptions.
  parts AS (SELECT DISTINCT y, (19 * (y % 19) + 24) % 30 AS a, y % 4 AS p, y % 7 AS q, y % 19 AS g FROM placed),
  found AS (SELECT y, a, g, (2 * p + 4 * q + 6 * a + 5) % 7 AS b FROM parts),
  easter AS (
    SELECT y, make_date(y, 3, 22) + CAST(a + b - CASE WHEN b = 6 AND (a = 29 OR (a = 28 AND g > 10)) THEN 7 ELSE 0 END AS INTEGER) AS e
    FROM found),
  us AS (
    SELECT d, isodow(d) AS w FROM placed
    WHERE (m, n) IN ((1, 1), (7, 4), (11, 11), (12, 25)) OR (m = 6 AND n = 19 AND y >= 2021)
       OR (m = 1 AND w = 1 AND nth = 3 AND y >= 1986) OR (m = 2 AND w = 1 AND nth = 3) OR (m = 5 AND w = 1 AND nth_last = 1)
       OR (m = 9 AND w = 1 AND nth = 1) OR (m = 10 AND w = 1 AND nth = 2) OR (m = 11 AND w = 4 AND nth = 4)),
  seen AS (SELECT d FROM us UNION SELECT d - 1 FROM us WHERE w = 6 UNION SELECT d + 1 FROM us WHERE w = 7),
  closed AS (
    SELECT d FROM placed WHERE (m, n) IN ((1, 1), (5, 1), (12, 25), (12, 26))
    UNION SELECT e - 2 FROM easter UNION SELECT e + 1 FROM easter),
  moved AS (
    SELECT CAST(l_shipdate AS DATE) AS d, count(*) AS rows, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS amount
    FROM lineitem GROUP BY 1)
SELECT placed.d AS calender, dayname(placed.d) AS weekday, placed.d IN (SELECT d FROM closed) AS isholiday,
       placed.d IN (SELECT d FROM seen) AS isholiday_in_us, rows, amount
FROM placed JOIN bounds ON placed.d BETWEEN lo AND hi LEFT JOIN moved ON moved.d = placed.d"""


def oracle_sql() -> dict[str, str]:
    return {
        "customer_monthly": _customer_monthly("true"),
        "customer_monthly_unmatched_type": _customer_monthly("transaction_type_id <> 'N'"),
        "segment_category_amount": _segment_amount(),
        "count_category_segment": _segment_ratio([_ratio(f"category_name = '{c}'", c.lower()) for c in CATEGORIES]),
        "is_essential_avg": _segment_ratio(
            [_ratio("is_essential", "essential"), _ratio("NOT is_essential", "non_essential")]
        ),
        "segment_size": "SELECT c_mktsegment AS segment, count(*) AS customers FROM customer GROUP BY 1",
        "daily_account_agg": """
SELECT CAST(user_id AS VARCHAR) AS account_number, strftime(ts, '%Y-%m-%d') AS day, count(*) AS tx_count,
       CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total_amount
FROM events GROUP BY 1, 2""",
        "legacy_fact": f"""
SELECT CASE WHEN length(CAST(event_id AS VARCHAR)) >= 11 THEN CAST(event_id AS VARCHAR)
            ELSE lpad(CAST(event_id AS VARCHAR), 11, '0') END AS transaction_id,
       CAST(user_id AS VARCHAR) AS account_number, CAST(user_id AS VARCHAR) AS customer_id,
       strftime(ts, '%Y-%m-%d') AS transaction_date, CAST(value AS DECIMAL(18,2)) AS amount, event_type AS type,
       {_LEGACY_TEXT}
FROM events""",
        "legacy_mixed_folder": """
SELECT user_id || '/' || event_type AS account_number, strftime(ts, '%Y-%m-%d') AS day, 2 * count(*) AS tx_count,
       CAST(2 * sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS total_amount
FROM events GROUP BY 1, 2""",
        "legacy_fact_detected": f"""
WITH rows AS ({_LEGACY_MOMENT})
SELECT *, 'ts' AS layout FROM rows UNION ALL SELECT *, 'date_and_time' AS layout FROM rows""",
        "timestamp_build": """
SELECT event_id AS transaction_id, CAST(date_trunc('second', ts) AS TIMESTAMP) AS ts FROM events""",
        "customer_age": f"""
SELECT CAST(o_orderkey AS VARCHAR) AS account_number,
       CAST(floor(date_diff('day', CAST(o_orderdate AS DATE), {AS_OF}) / 365) AS BIGINT) AS age
FROM orders""",
        "conform_transactions": f"WITH {TRANSACTIONS} SELECT *, {AS_OF} AS etl_date FROM tx",
        "conform_accounts": f"SELECT {ACCOUNT_COLUMNS}, {AS_OF} AS etl_date FROM orders",
        "conform_customers": f"SELECT {CUSTOMER_COLUMNS}, {AS_OF} AS etl_date FROM customer",
        "conform_merchants": f"""
SELECT CAST(p_partkey AS VARCHAR) AS merchant_id, p_name AS merchant_name, p_type AS category_id,
       CAST(p_size AS VARCHAR) AS city_id, {AS_OF} AS etl_date
FROM part""",
        "conform_branches": f"""
SELECT CAST(s_suppkey AS VARCHAR) AS branch_id, s_name AS branch_name, CAST(s_nationkey AS VARCHAR) AS city_id,
       {AS_OF} AS etl_date
FROM supplier""",
        "conform_cities": "SELECT CAST(n_nationkey AS VARCHAR) AS city_id, n_name AS city_name FROM nation",
        "conform_categories": f"""
SELECT DISTINCT p_type AS category_id, lower(p_type) AS category_name,
       p_type IN ('ECONOMY', 'SMALL', 'STANDARD') AS is_essential, {AS_OF} AS etl_date
FROM part""",
        "conform_channels": f"""
SELECT DISTINCT l_linestatus AS channel_id, CASE l_linestatus WHEN 'F' THEN 'branch' ELSE 'online' END AS channel_name,
       {AS_OF} AS etl_date
FROM lineitem""",
        "conform_transaction_types": f"""
SELECT DISTINCT l_returnflag AS transaction_type_id, lower(l_returnflag) AS transaction_type_name,
       l_returnflag = 'N' AS is_transfer, l_returnflag = 'R' AS is_income, {AS_OF} AS etl_date
FROM lineitem""",
        "calendar_holidays": _HOLIDAYS,
        "load_key_check": _KEY_CHECK,
        "calendar_dim": f"""
WITH dates AS (
    SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem UNION ALL SELECT CAST(o_orderdate AS DATE) FROM orders),
  bounds AS (SELECT min(d) AS lo, max(d) AS hi FROM dates),
  days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM bounds)
SELECT {CALENDAR_COLUMNS},
       d IN (DATE '1996-01-01', DATE '1996-07-04', DATE '1997-04-23') AS isholiday,
       d IN (DATE '1996-01-01', DATE '1996-07-04') AS isholiday_in_us, {CALENDAR_COUNTS}
FROM days""",
        "wide_expense_transactions": _WIDE,
        "bucketed_star": _WIDE,
        "bucketed_customer_monthly": _customer_monthly("true"),
        "day_window_load": f"{_DAY_SUMMARY} WHERE {_IN_WINDOW} GROUP BY 1",
        "day_list_load": f"""{_DAY_SUMMARY}
WHERE CAST(l_shipdate AS DATE) IN (DATE '1997-04-14', DATE '1997-04-17', DATE '1997-05-02') GROUP BY 1""",
        "partition_drop": f"""{_DAY_SUMMARY}
WHERE {_IN_WINDOW} AND CAST(l_shipdate AS DATE) <> DATE '1996-03-15'
  AND (CAST(l_shipdate AS DATE) <> DATE '1996-03-16' OR l_returnflag IN ('A', 'N'))
GROUP BY 1""",
        "month_partition_assign": """
SELECT CASE WHEN l_shipdate >= DATE '1996-01-01' AND l_shipdate < DATE '2001-01-01'
            THEN strftime(l_shipdate, '%Y_%m') ELSE 'default' END AS partition_month, count(*) AS rows
FROM lineitem GROUP BY 1""",
        "current_snapshot": f"""
WITH cust AS (SELECT {CUSTOMER_COLUMNS} FROM customer),
  loads AS (
    SELECT *, DATE '2001-01-01' AS etl_date FROM cust
    UNION ALL
    SELECT * REPLACE ('IN_DEBT' AS segment), DATE '2001-02-01' AS etl_date FROM cust WHERE monthly_salary_usd < 0)
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY etl_date DESC) AS rn FROM loads) WHERE rn = 1""",
        "load_report": f"""
WITH tx AS (
  SELECT l_linenumber AS n, CASE WHEN l_linenumber = 7 THEN NULL
    WHEN l_linenumber = 6 THEN CAST('1969' || strftime(l_shipdate, '-%m-%d') AS DATE) ELSE CAST(l_shipdate AS DATE) END AS d
  FROM lineitem WHERE l_linenumber <> 6 OR try_cast('1969' || strftime(l_shipdate, '-%m-%d') AS DATE) IS NOT NULL
  UNION ALL SELECT 7, NULL FROM lineitem WHERE l_linenumber = 6 AND try_cast('1969' || strftime(l_shipdate, '-%m-%d') AS DATE) IS NULL),
seen AS (SELECT *, CASE WHEN d IS NULL THEN 'no day' WHEN d < DATE '1970-01-01' THEN 'before 1970' ELSE 'loaded' END AS what
  FROM tx WHERE d IS NULL OR d < DATE '1970-01-01' OR d BETWEEN DATE '1996-01-01' AND DATE '1996-12-28')
SELECT what, CAST(d AS VARCHAR) AS of, count(*) AS rows FROM seen GROUP BY 1, 2
UNION ALL SELECT 'lost', 'amount', count(*) FROM seen WHERE n = 5
UNION ALL SELECT 'lost', 'balance_after_transaction', count(*) FROM seen WHERE n = 4
UNION ALL SELECT 'lost', 'transaction_date', count(*) FROM seen WHERE what = 'no day'
UNION ALL SELECT 'stored', 'all rows', count(*) FROM seen WHERE what = 'loaded'
UNION ALL SELECT 'kept apart', 'all rows', count(*) FROM seen WHERE what <> 'loaded'""",
        "load_ledger": """
SELECT CAST(l_shipdate AS DATE) AS day, 'loaded' AS outcome, count(*) AS rows,
       CAST(CASE WHEN CAST(l_shipdate AS DATE) >= DATE '1996-03-15' THEN 2 ELSE 1 END AS BIGINT) AS attempts,
       CAST(CASE WHEN CAST(l_shipdate AS DATE) = DATE '1996-03-15' THEN 1 ELSE 0 END AS BIGINT) AS failures,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS amount
FROM lineitem WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1996-03-13' AND DATE '1996-03-16' GROUP BY 1""",
        "snapshot_merge": f"""
WITH cust AS (SELECT {CUSTOMER_COLUMNS} FROM customer)
SELECT * REPLACE (CASE WHEN monthly_salary_usd < -500 THEN 'DEEP_IN_DEBT' ELSE segment END AS segment),
       CASE WHEN monthly_salary_usd < -500 THEN DATE '2001-02-01' ELSE DATE '2001-01-01' END AS etl_date
FROM cust""",
        "month_layout_scan": f"""{_DAY_SUMMARY}
WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1995-11-20' AND DATE '1996-07-10'
  AND (l_returnflag <> 'R' OR CAST(l_shipdate AS DATE) NOT BETWEEN DATE '1996-02-15' AND DATE '1996-03-15'
       OR CAST(l_shipdate AS DATE) NOT IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem WHERE l_returnflag <> 'R'))
GROUP BY 1""",
        "staged_exchange": f"{_DAY_SUMMARY}{_STAGED} GROUP BY 1",
        "staged_fact_load": f"{_DAY_SUMMARY.replace('AS amount', 'AS amount, 1::BIGINT AS versions')}{_STAGED} GROUP BY 1",
        "pk_violations": """
SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2
HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""",
        "fk_violations": _FK,
        "integrity_audit": _AUDIT,
        "null_profile": _NULL_PROFILE,
        "default_fill": """
SELECT o_orderkey AS account_number,
       CASE WHEN o_orderstatus <> 'P' THEN CAST(o_totalprice AS DECIMAL(18,2)) ELSE CAST(0 AS DECIMAL(18,2)) END
         AS initial_balance,
       0 AS overdraft_limit
FROM orders""",
        "length_violations": """
SELECT c_custkey, 'c_mktsegment' AS column_name, 8 AS max_length, length(c_mktsegment) AS length
FROM customer WHERE length(c_mktsegment) > 8
UNION ALL
SELECT c_custkey, 'c_name', 18, length(c_name) FROM customer WHERE length(c_name) > 18""",
        "precision_violations": """
SELECT o_orderkey, 'o_totalprice' AS column_name, 'decimal(7,2)' AS declared
FROM orders WHERE o_totalprice IS NOT NULL AND TRY_CAST(o_totalprice AS DECIMAL(7,2)) IS NULL
UNION ALL
SELECT o_orderkey, 'o_custkey', 'decimal(3,0)'
FROM orders WHERE o_custkey IS NOT NULL AND TRY_CAST(o_custkey AS DECIMAL(3,0)) IS NULL""",
        "top_accounts_readback": f"""
SELECT {ACCOUNT_COLUMNS} FROM orders
ORDER BY customer_id, account_open_date, account_number, initial_balance, branch_id LIMIT 6""",
        "load_reconciliation": f"""
SELECT transaction_date, source_rows, target_rows, source_rows - target_rows AS difference FROM (
  SELECT CAST(l_shipdate AS DATE) AS transaction_date, count(*) AS source_rows,
         count(*) FILTER ({_IN_WINDOW}) AS target_rows
  FROM lineitem GROUP BY 1)""",
        "source_contract": _CONTRACT,
        "csv_quoted_breaks": """
SELECT CAST(l_shipdate AS DATE) AS shipped,
       'a "quoted", comment' || chr(10) || l_returnflag || chr(10) || chr(10) || l_linestatus AS text,
       count(*) AS rows, CAST(sum(l_orderkey) AS BIGINT) AS orders
FROM lineitem GROUP BY 1, 2
UNION ALL SELECT NULL, '1,"cut' || chr(10) || 'off"', 1, 1""",
        "csv_ingest": f"""
WITH acc AS (SELECT {ACCOUNT_COLUMNS} FROM orders), cust AS (SELECT {CUSTOMER_COLUMNS} FROM customer)
SELECT acc.*, last_name, segment FROM acc LEFT JOIN cust ON acc.customer_id = cust.customer_id""",
    }
