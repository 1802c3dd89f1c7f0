"""Line dedup: sharded cuckoo filters in front of exact reference-count tables, with insertions and deletions.

The reference log holds one row for each key and document, +1 when a document came in and -1 when it went. Its sums are
the exact table: per key the number of documents and the largest of them. The cuckoo filters, one per shard of the
keys, hold the keys that enough documents share; a line whose key the filter of its shard does not know stays without
a look-up, the others are checked against the exact table. Deleting a document takes its references back and takes the
keys that are no longer shared out of the filters, so every load can be undone.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.session import scratch_path, written

from .common import WHITE, free_name

#: Shards at least; beyond so many references a shard on average there are more of them.
SHARDS = 64
REFERENCES_PER_SHARD = 32_000
#: References of a shard that one task looks up in its filter: a shard with more, as that of a very common line, is dealt into slices.
REFERENCES_PER_SLICE = 8_000
SLOTS = 4
#: A filter with more keys than this share of its slots is built anew, with room for twice its keys.
FULL = 0.8


def line_key(line: bytes) -> bytes:
    return line.strip(WHITE).lower()


def key_digest(line: bytes, least: int) -> bytes | None:
    """16 bytes for a line's key, None for a key of fewer than ``least`` code points (which is always kept)."""
    key = line_key(line)
    if len(key) < least or (len(key) < 4 * least and len(key.decode("utf-8", "surrogatepass")) < least):
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def lines_of(text: str | None) -> list[bytes]:
    """A null or empty text is one empty line."""
    return (text or "").encode("utf-8", "surrogatepass").split(b"\n")


def references(docs: DataFrame, least: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``doc_id``: each key once for each document. Documents without an id hold no references."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, found = [], []
            for one, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = {key_digest(line, least) for line in lines_of(body.as_py())} - {None}
                ids.extend([one] * len(own))
                found.extend(own)
            yield pa.record_batch({"key": pa.array(found, pa.binary()), "doc_id": pa.array(ids, pa.int64())})

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("doc_id is not null")
    return narrow.mapInArrow(keys, "key binary, doc_id long").distinct()


def in_shards(refs: DataFrame, shards: int) -> DataFrame:
    """``shard``, ``key``, ``doc_id``: the references with the shard of their key."""
    return refs.select(F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard"), "key", "doc_id")


def live(log: DataFrame) -> DataFrame:
    """The references of a log (``shard``, ``key``, ``doc_id``, ``sign``) that were not taken back."""
    return log.groupBy("shard", "key", "doc_id").agg(F.sum("sign").alias("n")).where("n > 0").drop("n")


def count_table(refs: DataFrame) -> DataFrame:
    """The exact table: per key the number of documents that hold it, and the largest."""
    return refs.groupBy("shard", "key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("keeper"))


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; a key lies in one of two buckets. Bounded by the number of keys of a shard."""

    def __init__(self, n_keys: int):
        self.mask = (1 << max(2, int(np.ceil(np.log2(max(1, n_keys) / SLOTS / FULL))))) - 1
        self.slots = np.zeros((self.mask + 1, SLOTS), np.uint16)
        #: What found no place in the buckets, and how many keys it stands for: those with one fingerprint and one pair of buckets.
        self.rest: Counter[tuple[int, int]] = Counter()

    def places(self, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprint, first and second bucket; the second is the first xor a hash of the fingerprint, and back."""
        two = digests.view(np.uint64).reshape(-1, 2)
        mark = (two[:, 1] & np.uint64(0xFFFF)).astype(np.uint16)
        mark[mark == 0] = 1
        first = (two[:, 0] & np.uint64(self.mask)).astype(np.int64)
        return mark, first, first ^ self.turn(mark)

    def turn(self, mark):
        return (mark.astype(np.int64) * 0x5BD1E995) & self.mask

    def insert(self, digests: np.ndarray) -> None:
        for mark, first, second in zip(*(x.tolist() for x in self.places(digests))):
            bucket = first if (self.slots[first] == 0).any() else second
            for kick in range(500):
                free = np.flatnonzero(self.slots[bucket] == 0)
                if free.size:
                    self.slots[bucket, free[0]] = mark
                    break
                turn = kick % SLOTS
                mark, self.slots[bucket, turn] = int(self.slots[bucket, turn]), mark
                bucket ^= int(self.turn(np.array([mark]))[0])
            else:
                self.rest[mark, min(bucket, bucket ^ int(self.turn(np.array([mark]))[0]))] += 1

    def delete(self, digests: np.ndarray) -> None:
        for mark, first, second in zip(*(x.tolist() for x in self.places(digests))):
            for bucket in (first, second):
                at = np.flatnonzero(self.slots[bucket] == mark)
                if at.size:
                    self.slots[bucket, at[0]] = 0
                    break
            else:
                self.rest[mark, min(first, second)] -= 1
                if self.rest[mark, min(first, second)] <= 0:
                    del self.rest[mark, min(first, second)]

    def __contains__(self, digest: bytes) -> bool:
        return bool(self.contains(np.frombuffer(digest, np.uint8).reshape(1, 16))[0])

    def contains(self, digests: np.ndarray) -> np.ndarray:
        mark, first, second = self.places(digests)
        found = (self.slots[first] == mark[:, None]).any(1) | (self.slots[second] == mark[:, None]).any(1)
        if self.rest:
            found |= np.array([(m, min(a, b)) in self.rest for m, a, b in zip(mark.tolist(), first.tolist(), second.tolist())])
        return found

    def dump(self) -> bytes:
        rest = np.array([(*entry, n) for entry, n in sorted(self.rest.items())], np.int64)
        return np.int64(self.mask).tobytes() + self.slots.tobytes() + rest.tobytes()

    @classmethod
    def load(cls, raw: bytes) -> CuckooFilter:
        own = cls.__new__(cls)
        own.mask = int(np.frombuffer(raw[:8], np.int64)[0])
        end = 8 + (own.mask + 1) * SLOTS * 2
        own.slots = np.frombuffer(raw[8:end], np.uint16).reshape(-1, SLOTS).copy()
        own.rest = Counter({(mark, bucket): n for mark, bucket, n in np.frombuffer(raw[end:], np.int64).reshape(-1, 3).tolist()})
        return own


FILTERS = "shard int, filter binary, slots long"


def digests_of(keys) -> np.ndarray:
    return np.frombuffer(b"".join(keys), np.uint8).reshape(-1, 16).copy()


def build_filters(table: DataFrame, min_docs: int, room: int = 1) -> DataFrame:
    """``shard``, ``filter`` and its ``slots``: the keys of the table that at least ``min_docs`` documents hold, with room for so many times their number."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        made = CuckooFilter(room * len(rows))
        made.insert(digests_of(sorted(rows["key"])))
        return pd.DataFrame({"shard": rows["shard"].iloc[:1], "filter": [made.dump()], "slots": made.slots.size})

    return table.where(F.col("n_docs") >= min_docs).select("shard", "key").groupBy("shard").applyInPandas(build, FILTERS)


def change_filters(filters: DataFrame, changes: DataFrame, table: DataFrame, min_docs: int) -> DataFrame:
    """The filters with keys put in (``sign`` 1) and taken out (-1), each key as often as it is listed.

    ``table`` is the exact table after the change. The filters of shards that have none yet, or would be full, are
    built from it, with room for twice the keys.
    """

    def change(own: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        made = CuckooFilter.load(own["filter"].iloc[0])
        made.delete(digests_of(rows.loc[rows["sign"] < 0, "key"]))
        made.insert(digests_of(rows.loc[rows["sign"] > 0, "key"]))
        return pd.DataFrame({"shard": own["shard"], "filter": [made.dump()], "slots": made.slots.size})

    needed = table.where(F.col("n_docs") >= min_docs).groupBy("shard").agg(F.count("*").alias("needed"))
    full = needed.join(filters.select("shard", "slots"), "shard", "left").where(F.col("slots").isNull() | (F.col("needed") > FULL * F.col("slots")))
    # A number for each shard at most.
    full = F.col("shard").isin([r["shard"] for r in full.collect()])
    kept, moved = filters.where(~full), changes.where(~full).select("shard", "key", "sign")
    changed = kept.groupBy("shard").cogroup(moved.groupBy("shard")).applyInPandas(change, FILTERS)
    return changed.unionByName(build_filters(table.where(full), min_docs, room=2))


def in_slices(refs: DataFrame, filters: DataFrame) -> tuple[DataFrame, DataFrame]:
    """References and filters with the slice of their shard. A shard has slices by the number of its references, and a filter goes to each.

    So the slices of all shards grow with the references, however those spread over keys. There is a row for each
    shard, written so that the planner knows its size.
    """
    counted = refs.groupBy("shard").agg(F.ceil(F.count("*") / F.lit(REFERENCES_PER_SLICE)).cast("int").alias("slices"))
    counted = written(counted, "line-slices")
    dealt = refs.join(counted, "shard").withColumn("slice", F.pmod(F.xxhash64("doc_id", "key"), F.col("slices")).cast("int")).drop("slices")
    sent = filters.join(counted, "shard").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).drop("slices")
    return dealt, sent


def possible_hits(refs: DataFrame, filters: DataFrame) -> DataFrame:
    """The references whose key the filter of their shard may hold, looked up slice by slice."""
    dealt, sent = in_slices(refs, filters)

    def probe(rows: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or own.empty:
            return rows.iloc[:0][["shard", "key", "doc_id"]]
        passed = CuckooFilter.load(own["filter"].iloc[0]).contains(digests_of(rows["key"]))
        return rows.loc[passed, ["shard", "key", "doc_id"]]

    return dealt.groupBy("shard", "slice").cogroup(sent.groupBy("shard", "slice")).applyInPandas(probe, "shard int, key binary, doc_id long")


def drops(refs: DataFrame, table: DataFrame, filters: DataFrame, min_docs: int) -> DataFrame:
    """``doc_id`` and the keys that it loses: shared ones, but for those it holds as the largest document."""
    shared = table.where(F.col("n_docs") >= min_docs).select(F.col("key").alias("t_key"), "keeper")
    hits = possible_hits(refs, filters)
    lost = hits.join(shared, hits["key"] == shared["t_key"]).where(F.col("doc_id") != F.col("keeper"))
    return lost.groupBy("doc_id").agg(F.collect_set("key").alias("keys"))


def added_names(docs: DataFrame) -> tuple[str, str]:
    """The names of the columns for lines before and lines dropped: new ones where the documents have such columns."""
    return free_name(docs, "n_lines"), free_name(docs, "n_dropped")


def strip_lines(docs: DataFrame, lost: DataFrame, least: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the lost lines taken out of the text, and two more columns: lines before, lines dropped.

    Returns all columns of ``docs`` and two more, called as ``added_names`` says.
    """
    n_lines, n_dropped = added_names(docs)
    keys = free_name(docs, "keys__")

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text)
            bodies, before, gone = [], [], []
            for body, out in zip(batch.column(at), batch.column(keys)):
                body, out = body.as_py(), out.as_py()
                if not out:
                    bodies.append(body)
                    before.append((body or "").count("\n") + 1)
                    gone.append(0)
                    continue
                out, lines = set(out), lines_of(body)
                kept = [x for x in lines if key_digest(x, least) not in out]
                bodies.append(b"\n".join(kept).decode("utf-8", "surrogatepass"))
                before.append(len(lines))
                gone.append(len(lines) - len(kept))
            columns = {name: batch.column(name) for name in batch.schema.names if name != keys}
            columns[text] = pa.array(bodies, batch.schema.field(at).type)
            yield pa.record_batch(columns | {n_lines: pa.array(before, pa.int64()), n_dropped: pa.array(gone, pa.int64())})

    of = free_name(docs, "of__")
    lost = lost.select(F.col("doc_id").alias(of), F.col("keys").alias(keys))
    both = docs.join(lost, docs[doc_id].cast("long") == lost[of], "left").drop(of)
    fields = ", ".join(f"`{name}` {kind}" for name, kind in [*docs.dtypes, (n_lines, "bigint"), (n_dropped, "bigint")])
    return both.mapInArrow(strip, fields)


def dedup_lines(docs: DataFrame, least: int = 20, min_docs: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the lines that ``min_docs`` documents or more share, but for those of the largest document id.

    All columns of ``docs`` stay; ``n_lines`` and ``n_dropped`` are added. A line's key has white space stripped and
    A-Z lower-cased; keys of fewer than ``least`` code points stay everywhere. A key repeated within a document counts
    once, and goes or stays there with all its lines. Repeated rows with one id are one document. Rows without an id
    are not counted and lose nothing. Null and empty texts are one empty line. An empty table gives an empty one.

    A line that all documents share is one row per document in the reference log, spread over slices of its shard, and
    one row of the table, as counts are combined before the shuffle. Shards and slices follow the number of references.
    """
    refs = written(references(docs, least, doc_id, text), "line-references")
    refs = in_shards(refs, max(SHARDS, -(-refs.count() // REFERENCES_PER_SHARD)))
    table = written(count_table(refs).where(F.col("n_docs") >= min_docs), "line-counts")
    filters = build_filters(table, min_docs)
    return strip_lines(docs, drops(refs, table, filters, min_docs), least, doc_id, text)


class ShardTable:
    """A table with a folder for each shard. A change writes new folders for the shards it touches; the others, and what an
    earlier reader knows, stay as they are. The driver holds a path for each shard."""

    def __init__(self, spark: SparkSession, name: str, schema: str):
        self.spark, self.name, self.schema = spark, name, schema
        self.at: dict[int, str] = {}

    def read(self, shards: list[int] | None = None) -> DataFrame:
        paths = [self.at[s] for s in sorted(self.at if shards is None else self.at.keys() & set(shards))]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def replace(self, rows: DataFrame, shards: list[int]) -> None:
        """``rows`` take the place of all rows of these shards."""
        path = scratch_path(self.spark, self.name)
        rows.withColumn("of_shard", F.col("shard")).hint("rebalance", "of_shard").write.partitionBy("of_shard").parquet(path)
        there = {r["shard"] for r in self.spark.read.schema(self.schema).parquet(path).select("shard").distinct().collect()}
        self.at = {s: p for s, p in self.at.items() if s not in set(shards)} | {s: f"{path}/of_shard={s}" for s in there}


class LineIndex:
    """An index that grows and shrinks: references, exact table and filters after each load or deletion.

    Each lies in shards by key. A load or a deletion counts and rewrites the shards of its keys only; references that were
    taken back are gone from them. ``shards`` stays what it is for an index: choose it by the references that it is to hold.
    """

    def __init__(self, spark: SparkSession, least: int = 20, min_docs: int = 3, shards: int | None = None):
        self.least, self.min_docs, self.shards = least, min_docs, shards or SHARDS
        self._log = ShardTable(spark, "line-log", "shard int, key binary, doc_id long")
        self._table = ShardTable(spark, "line-counts", "shard int, key binary, n_docs long, keeper long")
        self._filters = ShardTable(spark, "line-filters", FILTERS)

    @property
    def table(self) -> DataFrame:
        """The exact table."""
        return self._table.read()

    @property
    def filters(self) -> DataFrame:
        return self._filters.read()

    def insert(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> None:
        """Add documents. A key that a document has already in the index is not counted again."""
        new = written(in_shards(references(docs, self.least, doc_id, text), self.shards), "line-references")
        known = self._log.read(_shards_of(new))
        self._apply(new.join(known, ["shard", "key", "doc_id"], "left_anti").withColumn("sign", F.lit(1)))

    def delete(self, ids: DataFrame, doc_id: str = "doc_id") -> None:
        """Take documents back by id; ids that the index does not hold change nothing. Their references are looked up in the log."""
        ids = ids.select(F.col(doc_id).cast("long").alias("doc_id")).distinct()
        self._apply(self._log.read().join(ids, "doc_id", "left_semi").select("shard", "key", "doc_id", F.lit(-1).alias("sign")))

    def _apply(self, changes: DataFrame) -> None:
        changes = written(changes, "line-changes")
        touched = _shards_of(changes)
        was = self._table.read(touched)
        log = self._log.read(touched).withColumn("sign", F.lit(1)).unionByName(changes)
        self._log.replace(live(log), touched)
        self._table.replace(count_table(self._log.read(touched)), touched)
        now = self._table.read(touched)
        was, has = (t.where(F.col("n_docs") >= self.min_docs).select("shard", "key") for t in (was, now))
        moved = has.join(was, ["shard", "key"], "left_anti").withColumn("sign", F.lit(1)).unionByName(
            was.join(has, ["shard", "key"], "left_anti").withColumn("sign", F.lit(-1))
        )
        self._filters.replace(change_filters(self._filters.read(touched), moved, now, self.min_docs), touched)

    def strip(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """The documents without the lines that the index as it stands calls shared."""
        refs = written(in_shards(references(docs, self.least, doc_id, text), self.shards), "line-references")
        return strip_lines(docs, drops(refs, self.table, self.filters, self.min_docs), self.least, doc_id, text)


def _shards_of(rows: DataFrame) -> list[int]:
    """The shards that occur, a number for each at most."""
    return sorted(r["shard"] for r in rows.select("shard").distinct().collect())
