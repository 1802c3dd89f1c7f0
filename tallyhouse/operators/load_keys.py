"""Keys of a load, checked before its days take their place: repeats within it and in other days, references without a parent.

The load is small beside what is stored. Its keys become a Bloom filter, which the stored rows are passed through where they
are scanned: by their key column alone, and before any shuffle. Only what may be among the load's keys is shuffled, to an exact
join that decides. So the shuffles follow the load and not the table.

The filter has a fixed number of bitmaps of 4 KB each, which is all that is broadcast, whatever the load. More keys than it was
made for let more rows pass to the join and change no result.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bitmaps of the filter, a power of two up to 65,536: 256 of them (1 MB) hold about a million keys.
BITMAPS = 256
#: Bits of a bitmap that Spark's bitmap aggregate makes.
BITS = 32768
#: Where the three bits of a key are taken from its hash; the lowest bits choose the bitmap.
SHIFTS = (16, 31, 46)

REPEATED, STORED, ORPHAN, MISSING = "repeated in the load", "held by another day", "no parent", "missing"


def _hash(key: Column) -> Column:
    return F.xxhash64(key.cast("string"))


def _bits(of: Column) -> list[Column]:
    return [F.shiftrightunsigned(of, shift).bitwiseAND(F.lit(BITS - 1).cast("bigint")) for shift in SHIFTS]


def key_filter(keys: DataFrame, key: str, bitmaps: int = BITMAPS) -> DataFrame:
    """The Bloom filter of a column: at most ``bitmaps`` rows of ``bitmap_no__`` and ``bitmap__``."""
    if bitmaps & (bitmaps - 1) or not 0 < bitmaps <= 1 << min(SHIFTS):
        raise ValueError(f"{bitmaps} bitmaps: not a power of two up to {1 << min(SHIFTS)}")
    hashed = keys.where(F.col(f"`{key}`").isNotNull()).select(_hash(F.col(f"`{key}`")).alias("hash__"))
    number = F.pmod("hash__", F.lit(bitmaps).cast("bigint")).alias("bitmap_no__")
    return (
        hashed.select(number, F.explode(F.array(*_bits(F.col("hash__")))).alias("bit__"))
        .groupBy("bitmap_no__")
        .agg(F.bitmap_construct_agg("bit__").alias("bitmap__"))
    )


def possible_hits(stored: DataFrame, key: str, filter_rows: DataFrame, bitmaps: int = BITMAPS) -> DataFrame:
    """The stored rows whose key may be in the filter: all that are, and some that are not. Not shuffled."""

    def is_set(bit: Column) -> Column:
        byte = F.substring(F.col("bitmap__"), F.floor(bit / 8).cast("int") + 1, F.lit(1))
        return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (bit % 8).cast("int")) == 1

    hash_of = _hash(F.col(f"`{key}`"))
    bounded = F.broadcast(filter_rows)
    met = stored.join(bounded, F.pmod(hash_of, F.lit(bitmaps).cast("bigint")) == F.col("bitmap_no__"))
    return met.where(reduce(Column.__and__, [is_set(bit) for bit in _bits(hash_of)])).select(*[stored[c] for c in stored.columns])


def held_by_other_days(load: DataFrame, stored: DataFrame, key: str, day: str, bitmaps: int = BITMAPS) -> DataFrame:
    """Keys of the load that stored rows hold on days it does not replace: key and the load's rows. The load's days are broadcast."""
    counted = load.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    replaced = F.broadcast(load.select(F.col(day).alias("replaced__")).distinct())
    others = stored.select(key, day).join(replaced, F.col(day) == F.col("replaced__"), "left_anti").select(F.col(key).alias("held__"))
    held = possible_hits(others, "held__", key_filter(counted, key, bitmaps), bitmaps).distinct()
    return counted.join(held, F.col(key) == F.col("held__"), "left_semi")


def without_parent(load: DataFrame, column: str, parent: DataFrame, parent_key: str, bitmaps: int = BITMAPS) -> DataFrame:
    """Values of a column of the load that no parent row has, with the load's rows; a NULL refers to nothing and passes. Both
    columns have one type."""
    counted = load.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    known = possible_hits(parent.select(F.col(parent_key).alias("held__")), "held__", key_filter(counted, column, bitmaps), bitmaps).distinct()
    return counted.join(known, F.col(column) == F.col("held__"), "left_anti")


def check_keys(
    load: DataFrame,
    stored: DataFrame | None,
    key: str,
    day: str,
    references: Sequence[tuple[str, str, str]] = (),
    parents: Mapping[str, DataFrame] | None = None,
    not_null: Sequence[str] = (),
    bitmaps: int = BITMAPS,
) -> DataFrame:
    """What is wrong with the keys of a load: rule, column, value and the load's rows.

    ``references`` are (column, parent table, parent key); a table that ``parents`` lacks is not looked at. The load is read
    several times, so it has to be a stored table. Columns of ``not_null`` are counted in one pass.
    """

    def found(rule: str, column: str, rows: DataFrame) -> DataFrame:
        return rows.select(F.lit(rule).alias("rule"), F.lit(column).alias("column_name"), F.col(column).cast("string").alias("value"), "rows")

    counted = load.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    parts = [found(REPEATED, key, counted.where("rows > 1"))]
    if stored is not None:
        parts.append(found(STORED, key, held_by_other_days(load, stored, key, day, bitmaps)))
    for column, table, parent_key in references:
        if parents and table in parents:
            parts.append(found(ORPHAN, column, without_parent(load, column, parents[table], parent_key, bitmaps)))
    if not_null:
        counts = load.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in not_null])
        pairs = ", ".join(f"'{c}', `{c}`" for c in not_null)
        nulls = counts.selectExpr(f"stack({len(not_null)}, {pairs}) as (column_name, rows)").where("rows > 0")
        parts.append(nulls.select(F.lit(MISSING).alias("rule"), "column_name", F.lit(None).cast("string").alias("value"), "rows"))
    return reduce(DataFrame.unionAll, parts)
