"""LM scoring: stupid backoff over n-gram count tables that are partitioned by hash.

Documents are dealt into blocks of some megabytes. The n-grams of a block are exploded and counted there, so what is
shuffled is one entry for each n-gram of a block and not one for each word. The entries are dealt to shards by the
n-gram's hash, where the counts of all blocks are summed: the count table. The totals join the block's n-grams again,
and the scores are summed for each document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.session import written

from .common import words_of

ORDER = 2
BACKOFF = 0.4
#: Longer n-grams than single words that the corpus holds fewer times are taken as unseen: their one witness is the scored document.
MIN_COUNT = 2
#: Bytes of text in a block on average, and blocks for each shard.
BLOCK_BYTES = 6_000_000
BLOCKS_PER_SHARD = 2


def mix(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A 64-bit hash of an n-gram from that of its head and that of its last word."""
    x = left * np.uint64(0x9E3779B97F4A7C15) + (right ^ np.uint64(0xD1B54A32D192ED03))
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


class Block:
    """The words of some documents as numbers, and the distinct n-grams of each order."""

    def __init__(self, texts, order: int):
        known: dict[bytes, int] = {}
        rows = [[known.setdefault(w, len(known)) for w in words_of(t)] for t in texts]
        self.n_words = np.array([len(r) for r in rows], np.int64)
        words = np.array([w for r in rows for w in r], np.int64)
        del rows
        self.doc = np.repeat(np.arange(len(self.n_words)), self.n_words)
        self.place = np.arange(len(words)) - np.repeat(np.cumsum(self.n_words) - self.n_words, self.n_words)
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in known], np.uint64)
        del known
        #: By order: the hash of the n-gram that ends at each word (only where it has so many words before it).
        self.at = [hashes[words]] if len(words) else [np.zeros(0, np.uint64)]
        for n in range(2, order + 1):
            longer = np.zeros(len(words), np.uint64)
            longer[1:] = mix(self.at[-1][:-1], self.at[0][1:])
            self.at.append(longer)
        #: By order: distinct hashes (sorted), their counts, and where the n-gram at each word stands among them.
        self.grams = []
        for n, at in enumerate(self.at, 1):
            whole = self.place >= n - 1
            distinct, back, counts = np.unique(at[whole], return_inverse=True, return_counts=True)
            where = np.full(len(words), -1, np.int64)
            where[whole] = back
            self.grams.append((distinct, counts, where))
        del self.at


def planes(numbers: np.ndarray) -> bytes:
    """The bytes of the numbers, all first bytes first: sorted hashes and small counts compress well so."""
    return numbers.view(np.uint8).reshape(-1, numbers.dtype.itemsize).T.tobytes()


def from_planes(raw: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(raw, np.uint8).reshape(size, -1).T.copy().view(kind).ravel()


def by_shard(distinct: np.ndarray, shards: int) -> Iterator[tuple[int, int, int]]:
    """Each shard that has some of the sorted hashes, with where they begin and end. Equal hashes have equal shards in all blocks.

    Shards split the range of hashes. The work follows the hashes and not the number of shards, so it is linear however many there are.
    """
    own = distinct // np.uint64((1 << 64) // shards + 1) if shards > 1 else np.zeros_like(distinct)
    starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.zeros(0, np.int64)
    return zip(own[starts].astype(np.int64).tolist(), starts.tolist(), [*starts[1:].tolist(), len(distinct)])


def score_documents(docs: DataFrame, order: int = ORDER, min_count: int = MIN_COUNT, backoff: float = BACKOFF, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_backoff`` and ``score`` for each row of ``docs``.

    The model is that of all documents. Words are what stands between white space, A-Z lower-cased. A word's score is
    count(n-gram) / count(its head) for the longest n-gram that ends there within the document, has at most ``order``
    words and occurs ``min_count`` times or more in the corpus, times ``backoff`` for each step down; a single word's
    is its share of all words. ``score`` is the mean natural logarithm over the document's words, null for a
    document without words (a null text is one); ``n_backoff`` counts the steps down. Repeated rows count and are
    scored each; other columns are ignored; an empty table gives an empty result.

    N-grams are known by 64-bit hashes. A word that every document holds is one entry a block. Blocks and shards grow
    in number, not in size, with the text, so memory is bounded by the largest document or the block's share.
    """
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    size = narrow.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    shards = max(1, -(-blocks // BLOCKS_PER_SHARD))
    # Tasks grow in number with the blocks and the shards; the session's number of partitions is the least.
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Rows without an id are dealt by their text. Both uses below read one shuffle.
    dealt = narrow.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")).repartition(max(least, blocks), "block")

    def explode(rows: pd.DataFrame) -> pd.DataFrame:
        block, out = Block(rows["text"], order), []
        for n, (distinct, counts, _) in enumerate(block.grams, 1):
            for shard, a, b in by_shard(distinct, shards):
                out.append((n, shard, planes(distinct[a:b]), planes(counts[a:b].astype(np.uint32))))
        made = pd.DataFrame(out, columns=["n", "shard", "hashes", "counts"])
        return made.assign(block=np.int32(rows["block"].iloc[0]))

    def total(rows: pd.DataFrame) -> pd.DataFrame:
        hashes = [from_planes(x, "u8") for x in rows["hashes"]]
        _, back = np.unique(np.concatenate(hashes), return_inverse=True)
        sums = np.bincount(back, np.concatenate([from_planes(x, "u4") for x in rows["counts"]]))[back].astype(np.uint64)
        ends = np.cumsum([len(h) for h in hashes])
        rows["totals"] = [planes(part) for part in np.split(sums, ends[:-1])]
        return rows[["block", "n", "shard", "totals"]]

    def score(rows: pd.DataFrame, counted: pd.DataFrame) -> pd.DataFrame:
        block = Block(rows["text"], order)
        counted = counted.sort_values(["n", "shard"])
        value, steps, down = np.zeros(len(block.doc)), np.zeros(len(block.doc), np.int64), np.zeros(len(block.doc), bool)
        done = np.zeros(len(block.doc), bool)
        totals = []
        for n, (distinct, _, where) in enumerate(block.grams, 1):
            parts = [from_planes(x, "u8") for x in counted.loc[counted["n"] == n, "totals"]]
            joined = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            # The count at each word, 0 where the document has no such n-gram there.
            totals.append(np.where(where >= 0, joined[where] if len(joined) else 0, 0).astype(np.float64))
        for n in range(order, 0, -1):
            own = ~done & (block.place >= n - 1) & (totals[n - 1] >= (min_count if n > 1 else 1))
            head = np.concatenate([[1.0], totals[n - 2][:-1]]) if n > 1 else np.ones(len(own))
            value[own] = np.log(totals[n - 1][own]) - np.log(head[own])
            down[own] = n == 1
            done |= own
            steps[~done & (block.place >= n - 1)] += 1
        value += steps * np.log(backoff)
        docs_n = len(block.n_words)
        return pd.DataFrame({
            "doc_id": rows["doc_id"].astype("Int64"), "n_words": block.n_words, "n_backoff": np.bincount(block.doc, steps, docs_n).astype(np.int64),
            "n_single": np.bincount(block.doc, down, docs_n).astype(np.int64), "logs": np.bincount(block.doc, value, docs_n),
        })

    entries = dealt.groupBy("block").applyInPandas(explode, "n int, shard int, hashes binary, counts binary, block int")
    if order * shards > least:
        entries = entries.repartition(order * shards, "n", "shard")
    totals = entries.groupBy("n", "shard").applyInPandas(total, "block int, n int, shard int, totals binary")
    summed = dealt.groupBy("block").cogroup(totals.groupBy("block")).applyInPandas(score, "doc_id long, n_words long, n_backoff long, n_single long, logs double")
    summed = written(summed, "scores")
    n = summed.agg(F.sum("n_words")).first()[0] or 1
    # A single word's score is its share of all words, whose number is known only now.
    mean = (F.col("logs") - F.col("n_single") * F.log(F.lit(float(n)))) / F.col("n_words")
    return summed.select("doc_id", "n_words", "n_backoff", F.when(F.col("n_words") > 0, mean).alias("score"))
