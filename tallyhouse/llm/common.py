"""Helpers that several operators share: tables, free column names, words, connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.session import written

#: White space that separates words (space and U+0009 to U+000D), and the pattern of a word.
WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that the frame does not have, so that a helper column clashes with nothing."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def words_of(text: str | None) -> list[bytes]:
    """The words of a text, A-Z lower-cased. ``bytes.split`` and ``bytes.lower`` know just ASCII, which is the rule."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) for every node of an undirected edge list.

    Large-star and small-star steps in turn until the edges are stars, that is O(log^2) rounds however long a chain is.
    Each round is a grouped minimum, combined on the map side, and a join of the edges with one row per node, which
    adaptive execution can split for a node that holds a large share of the edges. Each round is written to the
    shared folder, so a lost executor costs that round at most, and nothing is collected but a count and a sum.
    Loops and null ends are ignored (greatest and least skip nulls, which makes a loop). An empty edge list gives an empty result.
    """
    now = edges.select(F.greatest(a, b).alias("v"), F.least(a, b).alias("u"))
    now = written(now.where("v > u").distinct(), "edges")
    before = None
    while True:
        both = now.unionByName(now.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy(F.col("v").alias("n")).agg(F.min("u").alias("m"))
        # Large star: every larger neighbour of a node is hung on the least of its neighbourhood.
        large = both.join(least, both["v"] == least["n"]).where("u > v")
        large = large.select(F.col("u").alias("v"), F.least("m", F.col("v")).alias("u"))
        large = large.where("v > u").distinct()
        # Small star: the node and its smaller neighbours are hung on the least of these.
        least = large.groupBy(F.col("v").alias("n")).agg(F.min("u").alias("m"))
        small = large.join(least, large["v"] == least["n"])
        small = small.select(F.explode(F.array(F.struct(F.col("u").alias("v"), F.col("m").alias("u")),
                                               F.struct(F.col("v"), F.col("m").alias("u")))).alias("e")).select("e.*")
        now = written(small.where("v > u").distinct(), "edges")
        # The edge set is unchanged by a further round just when it is made of stars.
        state = now.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if tuple(state) == before:
            break
        before = tuple(state)
    roots = now.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct()
    return now.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(roots)
