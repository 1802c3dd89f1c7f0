"""Pivots over a fixed list of values, as filtered aggregates.

``groupBy().pivot()`` plans two aggregations with two shuffles (by group and value, then by group). One filtered
aggregate per listed value needs a single one, combines on the map side, and leaves the result partitioned by the group
key, so a following join on that key adds no shuffle. An empty cell is NULL, as in a pivot, and values outside the list
are in no cell.

A task often meets a key only once, and then the row it sends holds all cells of the key. So cells are kept small: counts
and sums are whole numbers of eight bytes, a quarter of the state of a decimal sum.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.schemas import MONEY

CELL, HUNDREDTHS = "__cell", "__hundredths"


def _cell_number(by: Column, values: list[object]) -> Column:
    """Position of the value in the list, so that a row is compared to the listed values once and not per aggregate."""
    number = F.when(by == F.lit(values[0]), F.lit(0))
    for i, value in enumerate(values[1:], start=1):
        number = number.when(by == F.lit(value), F.lit(i))
    return number


def pivot_sum(df: DataFrame, key: str, by: str, cells: Mapping[object, str], amount: str) -> DataFrame:
    """Sum of ``amount`` per key and listed value of ``by``; ``cells`` maps the values to column names.

    ``amount`` is money with two decimals and is added up in hundredths. That is exact: a total that fits
    ``decimal(18,2)`` fits the whole number with room to spare, and one that does not is an error.
    """
    hundredths = (F.col(amount).cast(MONEY) * 100).cast("bigint")
    sums = [F.expr(f"sum({HUNDREDTHS}) FILTER (WHERE {CELL} = {i})").alias(n) for i, n in enumerate(cells.values())]
    numbered = df.withColumns({CELL: _cell_number(F.col(by), list(cells)), HUNDREDTHS: hundredths})
    return numbered.groupBy(key).agg(*sums).select(key, *[_money(name).alias(name) for name in cells.values()])


def _money(name: str) -> Column:
    return (F.col(f"`{name}`").cast("decimal(20,0)") / 100).cast(MONEY)


def pivot_count(df: DataFrame, key: str, by: str, cells: Mapping[object, str]) -> DataFrame:
    """Rows per key and listed value of ``by``; NULL, not 0, where there is none."""
    counts = [F.expr(f"sum(1) FILTER (WHERE {CELL} = {i})").alias(n) for i, n in enumerate(cells.values())]
    return df.withColumn(CELL, _cell_number(F.col(by), list(cells))).groupBy(key).agg(*counts)
