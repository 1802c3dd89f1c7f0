"""Ranked lexical search by hashed max-sketches.

The index holds a sketch of each document: its terms are hashed to a few coordinates each, and a coordinate keeps the
maximum of what falls on it. The least of a term's coordinates is therefore at least the term's own impact, and nothing
if one of them is empty. A batch of queries is looked up in every sketch at once, which gives an upper bound of each score.
The documents with the highest bounds are scored exactly; the k-th best exact score is then a threshold, and every
document whose bound still reaches it is scored exactly too. What is left out cannot be among the k best.

All terms of a document share its length, so an impact grows with the term's frequency alone. The maxima are kept as
codes of the frequency, one byte each; the index therefore does not depend on the number of documents or their mean length.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyhouse.session import written

#: Fixed value: a term in UTF-8; bytes from 0x80 on belong to code points beyond ASCII.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: Coordinates that a term is hashed to, and coordinates for each distinct term, at least.
WAYS, COORDINATES = 4, 24
#: Frequencies up to this are their own code; beyond it a code stands for the next higher power of GROWTH.
EXACT = 200
GROWTH = 1.35
#: Documents for each item, as a multiple of k, that are scored before there is a threshold.
FIRST = 2
#: Bytes of items that are searched for in one pass.
BLOCK_BYTES = 1 << 20
#: Bounds that a task holds at once.
CELLS = 2_000_000
#: Pairs of a text and an item, twelve bytes each, that may be broadcast.
BROADCAST_PAIRS = 200_000
#: Groups that choose an item's best documents before one group does.
GROUPS = 64


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in their order, A-Z lower-cased (``bytes.lower`` knows just ASCII, which is the rule)."""
    return TERM.findall(text.encode("utf-8", "surrogatepass").lower()) if text else []


def hashes_of(terms) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(t) for t in terms], np.uint64)


# Frequency that each code stands for: never less than the frequency that was coded.
STANDS_FOR = np.array([*range(EXACT + 1), *(math.ceil(EXACT * GROWTH**i) for i in range(1, 256 - EXACT))], np.int64)


def codes_of(frequencies: np.ndarray) -> np.ndarray:
    return np.searchsorted(STANDS_FOR, frequencies).astype(np.uint8)


def coordinates(hashes: np.ndarray, size: int) -> np.ndarray:
    """The coordinates of each hash (one row for each way) in a sketch of ``size``, a power of two."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return ((hashes[None, :] + np.arange(WAYS, dtype=np.uint64)[:, None] * step[None, :]) & np.uint64(size - 1)).astype(np.int64)


def sketch_of(terms: Counter, per_term: int = COORDINATES) -> np.ndarray:
    """The coordinatewise maxima of the codes of a document's terms."""
    size = 1 << max(4, (per_term * len(terms) - 1).bit_length())
    codes = codes_of(np.fromiter(terms.values(), np.int64, len(terms)))
    order = np.argsort(codes, kind="stable")
    sketch = np.zeros(size, np.uint8)
    # In rising order of all, as of several values for one place the last one stays.
    sketch[coordinates(hashes_of(terms)[order], size).T.ravel()] = np.repeat(codes[order], WAYS)
    return sketch


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", per_term: int = COORDINATES) -> DataFrame:
    """``doc_id``, ``text_hash``, ``n_terms`` and ``sketch`` for each document with a term, written to the shared folder.

    Null texts and texts without a term are not in the index; they have no score. Repeated rows and rows without an id
    are in it each. Only the columns named are read. The index serves any number of searches. ``per_term`` coordinates
    for each distinct term, at least, decide how tight the bounds are, not what a search finds.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            ids, hashes, out, lengths = batch.column(0).to_pylist(), batch.column(1).to_pylist(), [], []
            kept: tuple[list, list] = ([], [])
            for i, body in enumerate(batch.column(2)):
                terms = terms_of(body.as_py())
                if terms:
                    out.append(pack.compress(sketch_of(Counter(terms), per_term).tobytes()))
                    lengths.append(len(terms))
                    kept[0].append(ids[i])
                    kept[1].append(hashes[i])
            yield pa.record_batch({"doc_id": pa.array(kept[0], pa.int64()), "text_hash": pa.array(kept[1], pa.int64()), "n_terms": pa.array(lengths, pa.int64()), "sketch": pa.array(out, pa.binary())})

    made = _narrow(docs, doc_id, text).mapInArrow(rows, "doc_id long, text_hash long, n_terms long, sketch binary")
    return written(made, "sketches")


def _narrow(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text"))


@dataclass(frozen=True)
class Queries:
    """A block of items as arrays: the distinct terms of all, and for each item where its terms and weights stand."""

    items: list
    terms: list[bytes]
    #: Places of the items' terms one item after the other, and where each item begins.
    places: np.ndarray
    begins: np.ndarray
    n_docs: int = 0
    n_terms: int = 0
    weights: np.ndarray | None = None

    @staticmethod
    def of(rows: list[tuple]) -> Queries:
        known: dict[bytes, int] = {}
        own = [[known.setdefault(t, len(known)) for t in dict.fromkeys(terms_of(text))] for _, text in rows]
        begins = np.cumsum([0, *map(len, own)])[:-1]
        return Queries([item for item, _ in rows], list(known), np.array([p for o in own for p in o], np.int64), begins)

    def weighted(self, n_docs: int, n_terms: int, holding: np.ndarray) -> Queries:
        weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in holding]
        return Queries(self.items, self.terms, self.places, self.begins, n_docs, n_terms, np.array(weights, np.int64))

    def parts(self, frequencies: np.ndarray, length: int) -> np.ndarray:
        """What a term with each frequency adds for each unit of its weight, in a document of ``length`` terms."""
        m = 100 - 50 + (50 * length * self.n_docs) // self.n_terms
        return (1_000_000_000 * frequencies) // (1000 * frequencies + 20 * m)

    def scores(self, per_term: np.ndarray) -> np.ndarray:
        """One sum for each item of what its terms add."""
        if not len(self.places):
            return np.zeros(len(self.items), np.int64)
        sums = np.add.reduceat(np.append(per_term[self.places], 0), np.minimum(self.begins, len(self.places)))
        return np.where(np.diff(np.append(self.begins, len(self.places))) > 0, sums, 0)


def corpus_statistics(docs: DataFrame, queries: Queries, text: str) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and the documents that hold each term of the queries. Tasks send sums only."""
    place = {t: i for i, t in enumerate(queries.terms)}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, asked = np.zeros(len(place) + 2, np.int64), place.keys()
        for batch in batches:
            for body in batch.column(0):
                terms = terms_of(body.as_py())
                if terms:
                    found[-2:] += 1, len(terms)
                    found[[place[t] for t in asked & set(terms)]] += 1
        at = np.flatnonzero(found)
        yield pa.record_batch({"place": at, "n": found[at]})

    counted = docs.select(F.col(text).alias("text")).mapInArrow(rows, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    out = np.zeros(len(place) + 2, np.int64)
    for at, n in counted.collect():
        out[at] = n
    return int(out[-2]), int(out[-1]), out[:-2]


BOUNDS = "item int, doc_id long, text_hash long, bound long"


def bounds(index: DataFrame, queries: Queries, k: int, threshold: np.ndarray | None, last_id: list | None) -> DataFrame:
    """Rows of ``index`` with an upper bound of their score for items (by place).

    Without thresholds a task gives the ``k`` highest bounds above 0 of each item. With them it gives every row whose bound
    is above the item's threshold, or equal to it with an id before ``last_id``, that of the k-th best document so far.
    """
    hashes = hashes_of(queries.terms)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, places = zstandard.ZstdDecompressor(), {}
        best: list[np.ndarray] = [np.zeros((0, 4), np.int64)] * len(queries.items)
        step = max(1, CELLS // len(queries.items))
        for batch in (whole.slice(at, step) for whole in batches for at in range(0, len(whole), step)):
            ids, marks = batch.column(0), batch.column(1).to_numpy()
            rank = ids.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)
            found = np.zeros((len(ids), len(queries.items)), np.int64)
            for i, (length, packed) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3))):
                sketch = np.frombuffer(unpack.decompress(packed.as_py()), np.uint8)
                if len(sketch) not in places:
                    places[len(sketch)] = coordinates(hashes, len(sketch))
                codes = sketch[places[len(sketch)]].min(0)
                found[i] = queries.scores(queries.weights * queries.parts(STANDS_FOR, length)[codes])
            if threshold is None:
                nameless = ids.is_null().to_numpy(zero_copy_only=False)
                for item in range(len(queries.items)):
                    own = found[:, item]
                    at = np.flatnonzero(own > (best[item][-1, 0] if len(best[item]) >= k else 0))
                    if len(at):
                        both = np.vstack([best[item], np.column_stack([own[at], rank[at], marks[at], nameless[at]])])
                        best[item] = both[np.lexsort((both[:, 1], -both[:, 0]))[:k]]
            else:
                reaches = (found > threshold) | ((found == threshold) & (found > 0) & (rank[:, None] < np.array(last_id, np.int64)))
                at, item = np.nonzero(reaches)
                yield pa.record_batch({"item": pa.array(item, pa.int32()), "doc_id": ids.take(pa.array(at)), "text_hash": marks[at], "bound": found[at, item]})
        if threshold is None:
            for item, chosen in enumerate(best):
                doc_ids = pa.array(chosen[:, 1], pa.int64(), mask=chosen[:, 3].astype(bool))
                yield pa.record_batch({"item": pa.array(np.full(len(chosen), item), pa.int32()), "doc_id": doc_ids, "text_hash": chosen[:, 2], "bound": chosen[:, 0]})

    return index.select("doc_id", "text_hash", "n_terms", "sketch").mapInArrow(rows, BOUNDS)


def best_of(rows: DataFrame, value: str, k: int) -> DataFrame:
    """The ``k`` rows of each item with the highest value, ties by the smaller id, chosen in groups first; with ``rank``."""
    order = [F.desc(value), F.asc_nulls_last("doc_id"), F.asc("text_hash")]
    group = F.pmod(F.xxhash64("doc_id", "text_hash", F.spark_partition_id()), F.lit(GROUPS))
    first = rows.withColumn("group__", group).withColumn("rank", F.row_number().over(Window.partitionBy("item", "group__").orderBy(*order)))
    first = first.where(F.col("rank") <= k)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k).drop("group__")


def rescore(docs: DataFrame, candidates: DataFrame, queries: Queries, few: bool, doc_id: str, text: str) -> DataFrame:
    """``item``, ``doc_id``, ``text_hash`` and ``score`` above 0: the exact scores of all rows that hold a candidate's text.

    Texts are known by 64-bit hashes here; should two share one, both are scored by their own words. ``few`` says that
    the candidates are bounded in number, so that they may be broadcast and no text is shuffled.
    """
    wanted = candidates.groupBy("text_hash").agg(F.collect_set("item").alias("items")).withColumnRenamed("text_hash", "hash__")
    place = {t: i for i, t in enumerate(queries.terms)}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"item": [], "doc_id": [], "text_hash": [], "score": []}
            for i, mark, body, items in zip(*[batch.column(c).to_pylist() for c in range(4)]):
                terms = Counter(terms_of(body))
                frequency = np.zeros(len(place), np.int64)
                for t in place.keys() & terms.keys():
                    frequency[place[t]] = terms[t]
                scores = queries.scores(queries.weights * queries.parts(frequency, terms.total()))
                for item in items:
                    if scores[item] > 0:
                        for name, value in zip(out, (item, i, mark, int(scores[item]))):
                            out[name].append(value)
            yield pa.record_batch({"item": pa.array(out["item"], pa.int32()), **{name: pa.array(out[name], pa.int64()) for name in ("doc_id", "text_hash", "score")}})

    held = _narrow(docs, doc_id, text).join(F.broadcast(wanted) if few else wanted, F.col("text_hash") == F.col("hash__"))
    return held.select("doc_id", "text_hash", "text", "items").mapInArrow(rows, "item int, doc_id long, text_hash long, score long")


def blocks_of(items: DataFrame, item_id: str, text: str, block_bytes: int) -> Iterator[list[tuple]]:
    """The items in blocks of bounded size, one after the other on the driver. A longer item is a block of its own."""
    block, size = [], 0
    for item, body in items.select(F.col(item_id), F.col(text)).toLocalIterator():
        block.append((item, body))
        size += len(body or "") + 64
        if size >= block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def search(
    items: DataFrame,
    docs: DataFrame,
    k: int = 50,
    index: DataFrame | None = None,
    item_id: str = "item_id",
    doc_id: str = "doc_id",
    text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id`` and ``score``: for each item the ``k`` documents with the highest score above 0.

    Equal scores go by ascending id, documents without an id last. Repeated documents count and are ranked each; a
    repeated item gives its result as often. Items without a term, and documents with none, have no result; an empty table
    on either side gives an empty one. Other columns are ignored, whatever their names. Items are searched for in blocks
    of ``block_bytes``, so that what tasks hold of them is bounded; ``index`` is that of ``docs`` if it is there already.
    """
    spark: SparkSession = docs.sparkSession
    kind = items.select(item_id).schema[0].dataType.simpleString()
    schema = f"item_id {kind}, rank int, doc_id long, score long"
    found = None
    for block in blocks_of(items, item_id, text, block_bytes):
        asked = Queries.of(block)
        if not asked.terms:
            continue
        n_docs, n_terms, holding = corpus_statistics(docs, asked, text)
        if not n_docs:
            break
        index = build_index(docs, doc_id, text) if index is None else index
        best = _search_block(docs, index, asked.weighted(n_docs, n_terms, holding), k, doc_id, text)
        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(block)], f"place int, item_id {kind}")
        part = best.join(F.broadcast(names), F.col("item") == F.col("place")).select("item_id", "rank", "doc_id", "score")
        found = part if found is None else found.unionByName(part)
    return spark.createDataFrame([], schema) if found is None else found


def _search_block(docs: DataFrame, index: DataFrame, queries: Queries, k: int, doc_id: str, text: str) -> DataFrame:
    """``item`` (its place), ``rank``, ``doc_id`` and ``score``."""
    first = best_of(written(bounds(index, queries, FIRST * k, None, None), "first-bounds"), "bound", FIRST * k)
    few = FIRST * k * len(queries.items) <= BROADCAST_PAIRS
    scored = best_of(rescore(docs, first, queries, few, doc_id, text), "score", k)
    worst = {r["item"]: (r["score"], r["doc_id"]) for r in written(scored, "first-scores").where(F.col("rank") == k).collect()}
    most = np.iinfo(np.int64).max
    threshold = np.array([worst.get(i, (0, 0))[0] for i in range(len(queries.items))], np.int64)
    last_id = [most if (i := worst.get(at, (0, 0))[1]) is None else i for at in range(len(queries.items))]
    rest = written(bounds(index, queries, k, threshold, last_id), "bounds-to-beat")
    again = written(first.select("item", "text_hash").unionByName(rest.select("item", "text_hash")).distinct(), "candidates")
    few = again.count() <= BROADCAST_PAIRS
    exact = rescore(docs, again, queries, few, doc_id, text)
    return written(best_of(exact, "score", k).select("item", "rank", "doc_id", "score"), "best")
