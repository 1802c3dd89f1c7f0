"""URL filter: a blocked Bloom filter of listed canonical URLs passes possible hits to an exact hash join.

Everything is DataFrame work, the filling of the filter as well; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import UPPER, free_name

#: A block of the filter is one 64-bit word; a key sets this many bits in it.
BITS_PER_KEY = 4
#: The filter never takes more than this many words (8 MB), whatever the length of the list: beyond it the share of
#: false hits grows, and the exact join removes them.
MAX_WORDS = 1 << 20
WORDS_PER_RULE = 0.5


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, UPPER, UPPER.lower()), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def block_of(key: Column, words: int | Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(words).cast("bigint")).cast("int")


def mask_of(key: Column) -> Column:
    """The bits of a key in its word, six bits of a second hash for each."""
    second = F.xxhash64(F.lit("mask"), key)
    bits = [F.shiftright(second, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(BITS_PER_KEY)]
    mask = F.lit(0).cast("bigint")
    for bit in bits:
        # shiftleft() of the functions module takes a constant only
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit))
    return mask


def bloom_filter(keys: DataFrame, key: str, words: int) -> bytes:
    """The filter's words, eight bytes each, most significant first. Bounded by ``words`` whatever the number of keys.

    The bits of a word are combined on the map side; one row, at most MAX_WORDS words long, holds the filter.
    """
    set_bits = keys.select(block_of(F.col(key), words).cast("bigint").alias("block"), mask_of(F.col(key)).alias("bits"))
    no_bits = keys.sparkSession.range(words).select(F.col("id").alias("block"), F.lit(0).cast("bigint").alias("bits"))
    filled = set_bits.unionAll(no_bits).groupBy("block").agg(F.bit_or("bits").alias("bits"))
    word = F.struct("block", F.lpad(F.hex("bits"), 16, "0").alias("hex"))
    in_order = F.transform(F.sort_array(F.collect_list(word)), lambda w: w["hex"])
    return bytes(filled.agg(F.unhex(F.array_join(in_order, "")).alias("words")).first()["words"])


def may_be_listed(key: Column, bloom: Column, words: int) -> Column:
    """Whether the key's bits are all set in its word. False means that the key is not listed."""
    word = F.conv(F.hex(F.substring(bloom, block_of(key, words) * 8 + 1, F.lit(8))), 16, -10).cast("bigint")
    return word.bitwiseAND(mask_of(key)) == mask_of(key)


def candidates(host: Column, path: Column, lengths: list[int]) -> Column:
    """The canonical URLs that could fit: the host and each parent domain, with each listed length of the path."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    suffixes = F.when(host == "", F.array().cast("array<string>")).otherwise(suffixes)
    cuts = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length(path))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(cuts, lambda n: F.concat(s, F.substring(path, F.lit(1), n)))))


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", otherwise: str = "allow", keep: list[str] | None = None) -> DataFrame:
    """Each row's ``keep`` columns with ``host``, ``path``, ``rule`` and ``verdict`` (new names where ``keep`` has such columns).

    ``rules`` has host, path and verdict. A rule fits its host and all subdomains if the path starts with the rule's;
    the longest (host and path together) wins, and of one that is listed twice the first verdict by name. Rows that no rule fits, null urls
    and urls without ``://`` get a null rule and ``otherwise``. Repeated rows stay repeated; other columns of ``pages``
    are ignored, whatever their names; an empty list or an empty table gives what these rules say.

    The list of path lengths and the filter are all that leaves the rule table by way of the driver: the former has at
    most as many entries as the longest listed path has characters, the latter at most MAX_WORDS words. A row that the
    filter rejects is never shuffled. The others are judged once per distinct url, which
    is pre-aggregated before its shuffle, and adaptive execution splits a url that many rows share. The planner broadcasts
    a list below the session's limit, so that a rule that many urls fit is no shuffle key; a longer list is joined by a
    shuffle, whose frequent rules adaptive execution splits.
    """
    kept = ["page_id"] if keep is None else keep
    # Names that clash with nothing while the rows are judged; at the end the kept ones are back, and the others give way to them.
    keep = [f"keep{i}__" for i in range(len(kept))]
    listed = rules.select(
        F.translate(F.col("host"), UPPER, UPPER.lower()).alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict")
    ).where("r_host is not null and r_path is not null")
    listed = listed.select(F.concat("r_host", "r_path").alias("key"), F.length("r_path").alias("cut"), "r_verdict")
    listed = listed.groupBy("key").agg(F.min("r_verdict").alias("r_verdict"), F.collect_set("cut").alias("cuts"))
    about = listed.agg(F.count("*").alias("n"), F.array_distinct(F.flatten(F.collect_set("cuts"))).alias("lengths")).first()
    lengths = sorted(about["lengths"])
    words = int(min(MAX_WORDS, max(64, about["n"] * WORDS_PER_RULE)))
    rows = pages.select(*[F.col(c).alias(name) for c, name in zip(kept, keep)], F.col(url).alias("url__"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    bloom = F.lit(bloom_filter(listed, "key", words))
    found = candidates(F.col("host"), F.col("path"), lengths)
    rows = rows.withColumn("hits__", F.filter(found, lambda key: may_be_listed(key, bloom, words)) if lengths else F.array().cast("array<string>"))
    passed = rows.where(F.size("hits__") > 0)
    hits = passed.select("url__", "hits__").distinct().select("url__", F.explode("hits__").alias("key"))
    judged = hits.join(listed, "key").groupBy("url__").agg(
        F.max_by(F.struct(F.col("key").alias("rule"), F.col("r_verdict").alias("verdict")), F.struct(F.length("key"), F.col("key"))).alias("best")
    )
    with_rule = passed.join(judged, "url__", "left").select(*keep, "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict"))
    without = rows.where(F.size("hits__") == 0).select(*keep, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(otherwise).alias("verdict"))
    both = with_rule.unionByName(without)
    own = pages.select(*kept)
    added = [F.col(name).alias(free_name(own, name)) for name in ("host", "path", "rule", "verdict")]
    return both.select(*[F.col(name).alias(c) for c, name in zip(kept, keep)], *added)
