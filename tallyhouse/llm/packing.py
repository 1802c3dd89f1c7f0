"""Packing by best-fit decreasing: a segment tree over remaining capacities finds the tightest open window."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyhouse.session import written

WINDOW = 2048
END_ID = 1
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: Tokens that one group of remainders holds on average; each group is packed by one task.
GROUP_TOKENS = 2_000_000


def read_ranks(path: Path) -> dict[bytes, int]:
    with path.open("rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Encoder:
    """Token ids of a text as bytes (unsigned, little-endian, 32 bits each).

    The file of ranks beside the tokenizer is the same vocabulary, and its library gives the same ids in a quarter of
    the time. Texts that hold the string of a special token, which the tokenizer turns into its id, go to the tokenizer.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        ranks = Path(path).with_suffix(".tiktoken")
        self.fast = ranks.exists() and tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=read_ranks(ranks), special_tokens={})

    def plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        if not self.fast or any(x in text for x in self.special):
            return self.plain(text)
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def pieces(docs: DataFrame, window: int = WINDOW, tokenizer: str = TOKENIZER, with_ids: bool = True, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens`` and, if wanted, ``ids``.

    A document is its ids and then END_ID; one of more than ``window`` ids is first cut into full windows.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):  # bounds what a batch of long texts makes
                rows = []
                part = batch.slice(at, 500)
                for one, body in zip(part.column(0).to_pylist(), part.column(1)):
                    ids = encode(body.as_py() or "") + end
                    for start in range(0, len(ids), 4 * window):
                        piece = ids[start : start + 4 * window]
                        rows.append((one, start // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4, piece if with_ids else None))
                kinds = [pa.int64()] * 5 + [pa.binary()]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][: 5 + with_ids]
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)][: len(names)], names=names)

    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids)


class OpenWindows:
    """Open windows by remaining capacity: a segment tree whose leaf ``c`` counts the windows with ``c`` tokens left.

    Each inner node has the count below it, so the tightest window with room for a piece is the first filled leaf at or
    right of the piece's length, found by one way up and down.
    """

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def _add(self, capacity: int, change: int) -> None:
        at = capacity + self.leaves
        while at:
            self.count[at] += change
            at >>= 1

    def put(self, capacity: int, window: int) -> None:
        self.open[capacity].append(window)
        self._add(capacity, 1)

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Capacity and number of the tightest open window with room for ``need``, taken out of the tree."""
        at = need + self.leaves
        if not self.count[at]:
            while at > 1 and (at & 1 or not self.count[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.count[2 * at] else 2 * at + 1
        capacity = at - self.leaves
        self._add(capacity, -1)
        return capacity, self.open[capacity].pop()


def best_fit_decreasing(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each piece its window and the offset there. Longest first, ties by position."""
    bins, offsets, n, tree = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0, OpenWindows(window)
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        capacity, number = tree.tightest(need) or (window, n)
        n += number == n
        bins[i], offsets[i] = number, window - capacity
        if capacity > need:
            tree.put(capacity - need, number)
    return bins, offsets


def pack(parts: DataFrame, window: int = WINDOW, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; sequences hold at most ``window`` tokens and have no gaps.

    Pieces are dealt over groups by a hash of their document and place, as many groups as the tokens call for, and each group is packed by itself:
    a group of millions of tokens wastes next to nothing, and no task grows with the input. Rows in a group are sorted
    before they are packed, so reruns agree. Repeated rows are packed each. An empty table gives an empty result.
    """
    total = parts.agg(F.sum("length")).first()[0] or 0
    groups = max(1, -(-total // group_tokens))
    names = parts.columns
    order = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order, kind="stable", ignore_index=True)
        bins, offsets = best_fit_decreasing(rows["length"].to_numpy(), window)
        return rows[names].assign(sequence_id=(rows["group__"].to_numpy().astype(np.int64) << 32) | bins, offset=offsets)

    # Rows without an id are dealt by what else is known of them.
    dealt = parts.withColumn("group__", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups)))
    fields = ", ".join(f"`{n}` {k}" for n, k in parts.dtypes)
    return dealt.groupBy("group__").applyInPandas(fill, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, window: int = WINDOW, tokenizer: str = TOKENIZER, with_ids: bool = True, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents cut into pieces and packed: the columns of ``pieces`` and ``pack``. A null text is an empty document.

    Each token id of each document is in exactly one piece. Only ``doc_id`` and ``text`` of ``docs`` are read.
    """
    return pack(written(pieces(docs, window, tokenizer, with_ids, doc_id, text), "pieces"), window)
