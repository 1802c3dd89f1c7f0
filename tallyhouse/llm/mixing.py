"""Mixing sources to target weights: repetition rates per source, whole repeats plus one hash-seeded Bernoulli copy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.session import written

from .common import WORD_PATTERN, free_name

#: One source may hold a third of the documents: its rows are spread over this many salts where the join is shuffled.
SALTS = 64


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def unit_hash(seed: str, *keys: Column) -> Column:
    """A number in [0, 1) from a seed and the keys, the same on every run: 52 bits of an MD5."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), *[F.coalesce(k.cast("string"), F.lit("null")) for k in keys]).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def with_running(rows: DataFrame, order: Column, sums: list[str]) -> tuple[DataFrame, list]:
    """The rows with ``place`` (from 0, in the given order) and, by the name ``before_<sum>``, the sums over the rows before; and the sums over all.

    The rows are dealt by ranges of the order, a row for each range carries the sums on, and within a range a window gives
    the rest. So a task gets a range, and what is broadcast or collected has a row for each range. The ranges are written, as a
    sample decides where they end.
    """
    dealt = written(rows.withColumn("order__", order).repartitionByRange("order__").withColumn("range__", F.spark_partition_id()), "ranges")
    ends = dealt.groupBy("range__").agg(F.count("*").alias("n__"), *[F.sum(c).alias(c) for c in sums])
    earlier = Window.orderBy("range__").rowsBetween(Window.unboundedPreceding, -1)
    carried = [F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"from_{c}") for c in ["n__", *sums]]
    within = Window.partitionBy("range__").orderBy("order__")
    above = within.rowsBetween(Window.unboundedPreceding, -1)
    both = dealt.join(F.broadcast(ends.select("range__", *carried)), "range__")
    place = (F.col("from_n__") + F.row_number().over(within) - 1).alias("place")
    before = [(F.col(f"from_{c}") + F.coalesce(F.sum(c).over(above), F.lit(0))).alias(f"before_{c}") for c in sums]
    return both.select(*rows.columns, place, *before), list(dealt.agg(F.count("*"), *[F.sum(c) for c in sums]).first())


def source_rates(sizes: DataFrame, weights: list[float], share: float, cap: float) -> DataFrame:
    """``source``, ``source_size``, ``target`` and ``rate`` from one row per source (``source``, ``source_size``).

    The targets are ``min(cap * size, level * weight)`` with the level at which they sum to ``share`` of all sizes.
    Ordered by ``cap * size / weight``, the capped sources come first, and the level follows from running sums: the same
    as to hand the excess out again and again until no target is above its cap. The running sums are those of ranges of
    sources, so that no task gets all of them; three sums and the level reach the driver.
    """
    named = F.struct(F.col("source").isNull(), F.col("source"))  # null last
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked, _ = with_running(sizes, named, [])
    ranked = ranked.withColumn("w", F.get(cycle, F.pmod("place", F.lit(len(weights))).cast("int"))).drop("place")
    ranked = ranked.withColumn("most", F.lit(float(cap)) * F.col("source_size"))
    ranked, (_, *every) = with_running(ranked, F.struct((F.col("most") / F.col("w")).alias("ratio"), named.alias("named")), ["source_size", "most", "w"])
    all_sizes, _, all_weights = [float(x or 0) for x in every]
    # The level if this source and all after it are not capped; the first source for which it is no more than its cap allows is the first uncapped one.
    level = (F.lit(float(share) * all_sizes) - F.col("before_most")) / (F.lit(all_weights) - F.col("before_w"))
    fits = ranked.select("place", level.alias("level"), "w", "most").where(F.col("level") * F.col("w") <= F.col("most"))
    level = fits.agg(F.min_by("level", "place")).first()[0]
    target = F.least(F.col("most"), F.lit(level) * F.col("w")) if level is not None else F.col("most")
    ranked = ranked.withColumn("target", target)
    return ranked.select("source", "source_size", "target", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("rate"))


def mix_sources(
    docs: DataFrame, weights: list[float], share: float, cap: float = 2.0, source: str = "source", text: str = "text", doc_id: str = "doc_id", seed: str = "mix"
) -> tuple[DataFrame, dict[str, str]]:
    """The documents with their size, their source's size and target, and the number of copies the mix takes.

    Returns the frame and the names of the added columns (``size``, ``source_size``, ``target``, ``copies``), which are
    new names where the documents have such columns already. Each document is taken ``floor(rate)`` times, and once
    more if a hash of its id is below the fraction. Null texts have size 0; null is a source of its own, named last;
    a source of size 0 has target 0 and none of its documents is taken; repeated rows are taken alike. Rows without an id draw by their text.
    The result does not depend on partitions or reruns. An empty table gives an empty mix.
    """
    new = {name: free_name(docs, name) for name in ("size", "source_size", "target", "copies")}
    rate, salt, of, salt_of = (free_name(docs, name) for name in ("rate__", "salt__", "of__", "salt_of__"))
    sized = docs.withColumn(new["size"], word_count(F.col(text)))
    sums = sized.groupBy(F.col(source).alias("source")).agg(F.sum(new["size"]).alias("source_size"))
    # Written, so that its size is known: the planner broadcasts it below the session's limit. Beyond that the salts spread a hot source.
    rates = written(source_rates(sums, weights, share, cap), "rates")
    rates = rates.select(
        F.col("source").alias(of), F.col("source_size").alias(new["source_size"]), F.col("target").alias(new["target"]), F.col("rate").alias(rate),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias(salt_of),
    )
    nameless = F.when(F.col(doc_id).isNull(), F.coalesce(F.col(text), F.lit("")))
    sized = sized.withColumn(salt, F.pmod(F.xxhash64(F.lit("salt"), F.col(doc_id), nameless), F.lit(SALTS)).cast("int"))
    both = sized.join(rates, sized[source].eqNullSafe(rates[of]) & (sized[salt] == rates[salt_of]))
    whole = F.floor(F.col(rate))
    more = (unit_hash(seed, F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("null:"), nameless))) < F.col(rate) - whole).cast("long")
    both = both.withColumn(new["copies"], whole + more)
    return both.drop(of, salt_of, rate, salt), new


def emit_copies(mixed: DataFrame, copies: str, columns: list[str]) -> DataFrame:
    """``columns`` of each document, as many rows as its copies."""
    repeated = mixed.where(F.col(copies) > 0).select(*columns, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))).alias(free_name(mixed, "copy__")))
    return repeated.select(*columns)
