"""SimHash near-dedup: fingerprints split into blocks so that close pairs share some, joined on these, then verified."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.session import written

from .common import connected_components, words_of

BITS = 64
SEED = 42
#: A fingerprint is cut into DISTANCE + this many blocks; close pairs agree in at least this many of them.
SHARED = 3
#: A bucket with more fingerprints than this is cut again by the bits that its key leaves free.
BUCKET = 256
#: With so few bits free a bucket cannot hold more than 2^FREE fingerprints, and is joined in any case.
FREE = 8


def fingerprint(text: str | None, shingle: int) -> int:
    """The SimHash of a text as a signed 64-bit number: a bit is 1 if over half of the shingles' hashes have it."""
    words = words_of(text)
    if not words:
        return 0
    flat = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    first = ends - lengths
    if len(words) > shingle:
        first, ends = first[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        first, ends = first[:1], ends[-1:]
    digest, view = xxhash.xxh64_intdigest, memoryview(flat)
    hashes = np.array([digest(view[a:b], SEED) for a, b in zip(first.tolist(), ends.tolist())], "<u8")
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 4096):  # bounds the memory of a very long text
        ones += np.unpackbits(hashes[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``fp``, a row for each row of ``docs``."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [fingerprint(body.as_py(), shingle) for body in batch.column(1)]
            yield pa.record_batch({"doc_id": batch.column(0), "fp": pa.array(marks, pa.int64())})

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(hashed, "doc_id long, fp long")


def choices(held: int, distance: int) -> list[int]:
    """The masks that extend ``held`` by SHARED of the blocks of the bits that it leaves free."""
    free = np.array([b for b in range(BITS) if not held >> b & 1])
    blocks = [sum(1 << b for b in part.tolist()) for part in np.array_split(free, distance + SHARED)]
    return [held | sum(chosen) for chosen in combinations(blocks, SHARED)]


def signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def expand(rows: DataFrame, distance: int) -> DataFrame:
    """Rows of ``fp`` and ``held``, once for each choice of blocks: ``fp``, ``mask``, and ``key``, the bits that the mask holds."""

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp, held = (batch.column(i).to_numpy() for i in (0, 1))
            for one in np.unique(held):
                own = fp[held == one]
                masks = np.array([signed(m) for m in choices(int(one) % (1 << BITS), distance)], np.int64)
                each = np.tile(masks, len(own))
                own = np.repeat(own, len(masks))
                yield pa.record_batch({"fp": own, "mask": each, "key": own & each})

    return rows.select("fp", "held").mapInArrow(rows_of, "fp long, mask long, key long")


def close_pairs(prints: DataFrame, distance: int) -> DataFrame:
    """``a < b``: each pair of the distinct fingerprints ``fp`` with at most ``distance`` different bits, once.

    Such a pair leaves SHARED of ``distance + SHARED`` blocks alike, so it shares a bucket: a choice of blocks and the
    fingerprint's bits there. A bucket of more than BUCKET fingerprints is not joined but cut again, by the same
    argument, along the bits that its key leaves free. Keys grow each time, and with FREE bits free a bucket cannot hold
    more than 256 fingerprints, so this ends, nothing is capped and no bucket is paired beyond BUCKET squared. The join
    emits a pair only if it is near, and from the first choice only that it agrees on.
    """
    todo, found, first = prints.select("fp", F.lit(0).cast("bigint").alias("held")), [], True
    while True:
        rows = written(expand(todo, distance), "buckets")
        full = (F.col("count") > BUCKET) & (F.bit_count("mask") < BITS - FREE)
        hot = written(rows.groupBy("mask", "key").count().where(full).select("mask", "key"), "hot-buckets")
        again = not hot.isEmpty()
        small = rows.join(hot, ["mask", "key"], "left_anti") if again else rows
        a = small.withColumnRenamed("fp", "a")
        b = small.select(F.col("fp").alias("b"), F.col("mask").alias("mask_b"), F.col("key").alias("key_b"))
        differ = F.col("a").bitwiseXOR(F.col("b"))
        near = (F.col("mask") == F.col("mask_b")) & (F.col("key") == F.col("key_b")) & (F.col("a") < F.col("b")) & (F.bit_count(differ) <= distance)
        if first:
            masks = F.array(*[F.lit(signed(m)) for m in choices(0, distance)])
            near &= F.get(F.filter(masks, lambda m: differ.bitwiseAND(m) == 0), F.lit(0)) == F.col("mask")
        found.append(a.join(b, near).select("a", "b"))
        if not again:
            return found[0] if len(found) == 1 else reduce(DataFrame.unionByName, found).distinct()
        todo, first = rows.join(hot, ["mask", "key"], "left_semi").select("fp", F.col("mask").alias("held")).distinct(), False


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``fp`` (signed 64 bits), ``fingerprint`` (16 hex digits) and ``component_id``, a row for each row of ``docs``.

    ``component_id`` is the smallest document id that links of at most ``distance`` bits reach, itself included.
    Texts without a word, null ones too, have fingerprint zero and are linked like any other. Documents with one
    fingerprint are linked as one node, so copies are never paired, however many. Rows without an id link like others but are
    never a component's id (null if it has no other). Repeated rows stay repeated, other columns are ignored, and an
    empty table gives an empty result. Neither fingerprints nor links pass through the driver.
    """
    marked = written(fingerprints(docs, shingle, doc_id, text), "fingerprints")
    prints = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    parts = connected_components(close_pairs(prints, distance), "a", "b")
    linked = prints.join(parts, prints["fp"] == parts["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = written(linked.join(ids, "root").select(F.col("fp").alias("fp__"), "component_id"), "fingerprint-components")
    # A fingerprint that a third of all documents have is one row of the other side, so adaptive execution can split it.
    both = marked.join(of_print, marked["fp"] == of_print["fp__"], "left")
    return both.select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
