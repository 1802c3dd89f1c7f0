"""All declared integrity rules over a set of tables, as one report."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse import rules
from tallyhouse.operators.quality import fk_violations, pk_violations

REPORT = "rule string, table_name string, column_name string, checked boolean, violations long"


def column_rules(table: str, declared: rules.Rules) -> list[tuple[str, str, Column]]:
    """NOT NULL, text length and number precision of one table: rule, column, condition of a violation."""
    checks: list[tuple[str, str, Column]] = []
    for name in declared.not_null.get(table, ()):
        checks.append(("not_null", name, F.col(name).isNull()))
    for name, limit in declared.max_length.get(table, {}).items():
        checks.append(("max_length", name, F.length(name) > limit))
    for name, (precision, scale) in declared.precision.get(table, {}).items():
        fitted = F.col(name).try_cast(f"decimal({precision},{scale})")
        checks.append(("precision", name, F.col(name).isNotNull() & fitted.isNull()))
    return checks


def audit(tables: Mapping[str, DataFrame], declared: rules.Rules = rules.OLDER) -> DataFrame:
    """One row per declared rule: rule, table, column, whether it was checked, violations.

    A key rule counts the keys (primary) or child rows (foreign) that break it. Tables may be given with all their loads: a
    dimension's key has to be unique in each load date, the fact's in the whole table. A rule on a table or column
    that is not given is reported as not checked, its violations are NULL.
    """
    have = {table: set(df.columns) for table, df in tables.items()}
    reports: list[DataFrame] = []
    unchecked: list[tuple[str, str, str, bool, int | None]] = []
    for table, key in declared.primary_keys.items():
        given = have.get(table, set())
        checks = column_rules(table, declared)
        # All column rules of a table are counted in one pass.
        known = [check for check in checks if check[1] in given]
        unchecked += [(rule, table, name, False, None) for rule, name, _ in checks if name not in given]
        if known:
            counted = tables[table].agg(*[F.count_if(broken).alias(f"broken_{i}") for i, (_, _, broken) in enumerate(known)])
            lines = [_line(rule, table, name, F.col(f"broken_{i}")) for i, (rule, name, _) in enumerate(known)]
            reports.append(counted.select(F.inline(F.array(*lines))))
        if set(key) <= given:
            by_load = ("etl_date",) if "etl_date" in given and table != "transactions" else ()
            broken = pk_violations(tables[table], (*key, *by_load)).agg(F.count(F.lit(1)).alias("n"))
            reports.append(broken.select(F.inline(F.array(_line("primary_key", table, ", ".join(key), F.col("n"))))))
        else:
            unchecked.append(("primary_key", table, ", ".join(key), False, None))
        for column, parent, parent_key in declared.foreign_keys.get(table, ()):
            if column in given and parent_key in have.get(parent, set()):
                orphans = fk_violations(tables[table], column, tables[parent], parent_key, column)
                broken = orphans.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"))
                reports.append(broken.select(F.inline(F.array(_line("foreign_key", table, column, F.col("n"))))))
            else:
                unchecked.append(("foreign_key", table, column, False, None))
    if not reports:
        raise ValueError("no declared rule applies to the given tables")
    if unchecked:
        reports.append(reports[0].sparkSession.createDataFrame(unchecked, REPORT))
    return reduce(DataFrame.unionAll, reports)


def _line(rule: str, table: str, column: str, violations: Column) -> Column:
    return F.struct(
        F.lit(rule).alias("rule"),
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit(True).alias("checked"),
        violations.cast("bigint").alias("violations"),
    )
