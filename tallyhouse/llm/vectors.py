"""Vectors of a table: which take part, copies as one, and as a matrix."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def usable_rows(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``vec_id`` and ``v`` (array of double), each pair once: rows with an id whose vector has a direction.

    That is: not null or empty, all components finite and not all zero. Vectors of different lengths have no cosine, so
    callers take each length by itself (``lengths``).
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))
    # A negative zero is a zero, so that copies are equal.
    return rows.select("vec_id", F.transform("v", lambda x: x + 0.0).alias("v")).distinct()


def packed(column: pa.Array) -> tuple[np.ndarray, list[bytes]]:
    """Positions of the usable vectors (see ``usable_rows``) of a column of lists of one length, and the bytes of each.

    A vector is as many bytes in single precision where that loses nothing, else in double, and equal vectors are the same bytes.
    """
    values = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    if values.dtype != np.float32:
        values = values.astype(np.float64)
    values = values + values.dtype.type(0)  # a negative zero is a zero
    usable = np.flatnonzero(np.isfinite(values).all(1) & (values != 0).any(1))
    values = values[usable]
    with np.errstate(over="ignore"):
        single = values.astype(np.float32)
    exact = (single == values).all(1)
    return usable, [(s if e else v).tobytes() for s, v, e in zip(single, values, exact)]


def unpacked(vectors: list[bytes], size: int) -> np.ndarray:
    """What ``packed`` made from vectors of one length, as a matrix."""
    out = np.empty((len(vectors), size))
    for kind in (np.float32, np.float64):
        own = [i for i, v in enumerate(vectors) if len(v) == size * np.dtype(kind).itemsize]
        out[own] = np.frombuffer(b"".join([vectors[i] for i in own]), kind).reshape(-1, size)
    return out


def lengths(rows: DataFrame) -> list[int]:
    """The lengths of the vectors ``v``."""
    return sorted(r[0] for r in rows.select(F.size("v")).distinct().collect())


def distinct_vectors(rows: DataFrame, ids: int) -> DataFrame:
    """``rep`` (the smallest id), ``copies``, ``ids`` (the smallest ones) and ``v`` for each different vector.

    Ranks are limited before the shuffle, so a vector that a third of all rows have costs ``ids`` rows a task.
    """
    place = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    first = rows.withColumn("place", place).where(F.col("place") <= ids)
    return first.groupBy("v").agg(F.min("vec_id").alias("rep"), F.array_sort(F.collect_list("vec_id")).alias("ids")).select("rep", "ids", "v")


def scaled(rows: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, which changes no digit, so that squares neither overflow nor vanish."""
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(1, initial=0.0))[1][:, None])


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column of vectors of one length as a matrix of scaled rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return scaled(column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)) if len(column) else np.zeros((0, 0))
