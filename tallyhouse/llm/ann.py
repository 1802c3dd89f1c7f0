"""Approximate nearest neighbours along shifted space-filling curves.

Vectors are projected to a few dimensions several times, each time rotated and shifted anew, and ordered along a
Hilbert curve. Each ordering is cut into ranges of keys; a query looks into the ranges around its own on every curve,
and what the windows find is reranked by the exact cosine and merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from math import erf

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.session import written

from .vectors import distinct_vectors, lengths, matrix, usable_rows

CURVES, PROJECTED, BITS = 8, 4, 8
#: Rows of a range on average, and the least number of ranges of a curve.
RANGE_ROWS, MIN_RANGES = 8_192, 16
#: The sample on which the projection is fitted, and the sample queries on which the width of the windows is measured.
SAMPLE, PROBES = 4_096, 128
#: The share of true neighbours of the sample queries that the windows have to hold.
WANTED = 0.96
#: Queries that one task compares with a range, and how many of them at a time.
RANGE_QUERIES, QUERY_BATCH = 16_384, 512


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places of cells (rows of ``k`` whole numbers below ``2^bits``) along the Hilbert curve, as whole numbers of ``k * bits`` bits.

    Gray-code walk: from the highest bit down, each axis that is in the upper half turns the first axis over, each that is not swaps with it.
    """
    axes = cells.astype(np.int64).T.copy()
    for bit in range(bits - 1, 0, -1):
        low = (1 << bit) - 1
        for axis in axes:
            upper = (axis >> bit & 1).astype(bool)
            swap = np.where(upper, 0, (axes[0] ^ axis) & low)
            axes[0] ^= np.where(upper, low, swap)
            axis ^= swap
    gray = np.bitwise_xor.accumulate(axes, axis=0)
    turn = np.zeros_like(gray[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(gray[-1] >> bit & 1, (1 << bit) - 1, 0)
    gray ^= turn
    key = np.zeros_like(turn)
    for bit in range(bits - 1, -1, -1):
        for axis in gray:
            key = key << 1 | (axis >> bit & 1)
    return key


@dataclass
class Curves:
    """Rotations, scales and shifts of all curves, fitted on a bounded sample."""

    axes: np.ndarray
    centre: np.ndarray
    spread: np.ndarray
    shifts: np.ndarray

    @classmethod
    def fit(cls, sample: np.ndarray, seed: int = 11) -> Curves:
        rng = np.random.default_rng(seed)
        n = min(PROJECTED, sample.shape[1])
        axes = np.stack([np.linalg.qr(rng.normal(size=(sample.shape[1], sample.shape[1])))[0][:, :n] for _ in range(CURVES)])
        at = np.einsum("rd,cdk->crk", sample, axes)
        return cls(axes, at.mean(1), at.std(1) + 1e-12, rng.uniform(0, 0.25, (CURVES, n)))

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """A row of keys for each curve. Coordinates are spread evenly by the normal distribution, and the curve is shifted under them."""
        out = []
        for axes, centre, spread, shift in zip(self.axes, self.centre, self.spread, self.shifts):
            z = (vectors @ axes - centre) / spread
            even = 0.5 * (1 + np.vectorize(erf, otypes=[float])(z / np.sqrt(2))) if z.size else z
            cells = np.clip(((0.75 * even + shift) * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1)
            out.append(hilbert_keys(cells, BITS))
        return np.stack(out)


def nearest(vectors: DataFrame, queries: str, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` nearest found of each query, by cosine, ties to the smaller id.

    ``queries`` is a SQL condition on ``vec_id``. All rows but the query's own are candidates. Vectors that are null,
    empty, zero, or hold null or non-finite components take no part, nor do rows without an id. Vectors of another length
    than the query's are no candidates; each length has curves of its own. Repeated rows are one row. Fewer candidates than ``k`` give as many rows. Other columns are ignored; an empty
    table gives an empty result.

    Copies of a vector have one place on each curve and bring their ``k + 1`` smallest ids, as no others can be in a
    result. The width of the windows is what PROBES queries need to find WANTED of their true neighbours, which one
    pass over all rows tells: a number of ranges, measured alike at every size.
    """
    rows = usable_rows(vectors, vec_id, embedding)
    sizes = lengths(rows)
    if len(sizes) > 1:
        rows = written(rows, "usable-vectors")
    found = [_nearest(rows.where(F.size("v") == n) if len(sizes) > 1 else rows, queries, k) for n in sizes]
    if not found:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = reduce(DataFrame.unionByName, found)
    if len(sizes) == 1:
        return found
    # An id may have vectors of several lengths: what is found for each of them is ranked together.
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", place.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _nearest(rows: DataFrame, queries: str, k: int) -> DataFrame:
    """``nearest`` for usable rows of one length."""
    spark, most = rows.sparkSession, k + 1
    reps = written(distinct_vectors(rows, most), "distinct-vectors")
    # A query is known by its vector; ranked queries of one vector share what is found.
    asked = rows.where(queries).select(F.col("vec_id").alias("query_id"), F.col("v").alias("w"))
    asked = written(asked.join(reps, asked["w"] == reps["v"]).select("query_id", "rep").distinct(), "queries")
    n = reps.count()
    sample = matrix_of(reps.orderBy(F.xxhash64(F.lit("fit"), "rep")).limit(SAMPLE))
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    curves = Curves.fit(unit(sample))
    index = written(along_curves(reps.select("rep", "v"), curves, max(MIN_RANGES, -(-n // RANGE_ROWS))), "curves")
    radius = window_radius(reps, asked, index, most)
    ranges = index.select("curve", "range").distinct().groupBy().agg(F.count("*")).first()[0]
    per_range = asked.select("rep").distinct().count() * CURVES * (2 * radius + 1) / max(1, ranges)
    slices = max(1, int(-(-per_range // RANGE_QUERIES)))
    looking = index.join(asked.select("rep").distinct(), "rep", "left_semi")
    looking = looking.select("curve", F.explode(F.sequence(F.col("range") - radius, F.col("range") + radius)).alias("range"), F.pmod(F.xxhash64("rep"), F.lit(slices)).alias("slice"), "rep", "v")
    # Where there are so many queries that a range would get too many, it is compared with slices of them.
    every_slice = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))).alias("slice")
    # New names for columns: both sides come from one table.
    held = index.select(*[F.col(c).alias(c) for c in ("curve", "range")], every_slice, *[F.col(c).alias(c) for c in ("rep", "v")])

    def rerank(asking: pa.Table, rows: pa.Table) -> pa.Table:
        names = ["query", "rep", "score"]
        kinds = [pa.int64(), pa.int64(), pa.float64()]
        if not asking.num_rows or not rows.num_rows:
            return pa.table([pa.array([], t) for t in kinds], names=names)
        q, r = matrix(asking["v"]), matrix(rows["v"])
        q_id, r_id = asking["rep"].to_numpy(), rows["rep"].to_numpy()
        found = [(q_id[who], r_id[which], score) for who, which, score in top(q, r, most)]
        return pa.table([pa.array(np.concatenate(c), t) for c, t in zip(zip(*found), kinds)], names=names)

    key = ["curve", "range", "slice"]
    found = looking.groupBy(*key).cogroup(held.groupBy(*key)).applyInArrow(rerank, "query long, rep long, score double")
    found = found.distinct().join(reps.select("rep", F.explode("ids").alias("vec_id")), "rep")
    by_score = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("place", F.row_number().over(by_score)).where(F.col("place") <= most)
    best = best.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("place", "vec_id", "score"))).alias("best"))
    out = asked.join(best, asked["rep"] == best["query"])
    # Without the query's own id, k of the k + 1 are left.
    own = F.filter("best", lambda b: b["vec_id"] != F.col("query_id"))
    out = out.select("query_id", F.posexplode(F.slice(own, 1, k)).alias("at", "hit"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))


def matrix_of(rows: DataFrame) -> np.ndarray:
    """The vectors ``v`` of a frame of bounded size."""
    table = rows.select("v").toArrow()
    return matrix(table["v"]) if table.num_rows else np.zeros((0, 0))


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def top(queries: np.ndarray, rows: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Positions of queries and rows, and cosines, of the ``most`` nearest rows of each query and of what ties with the last."""
    unit_q, unit_r = unit(queries), unit(rows)
    for at in range(0, len(queries), QUERY_BATCH):
        near = unit_q[at : at + QUERY_BATCH] @ unit_r.T
        if near.shape[1] > most:
            least = np.partition(near, near.shape[1] - most, axis=1)[:, near.shape[1] - most]
            # A product may be rounded differently in another block; what is this near the last is passed on.
            who, which = np.nonzero(near >= least[:, None] - 1e-12)
        else:
            who, which = (x.ravel() for x in np.indices(near.shape))
        yield who + at, which, cosines(queries[who + at], rows[which])


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The cosine of each pair of rows, by itself, so that it does not depend on the block."""
    return np.einsum("ij,ij->i", a, b) / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))


def along_curves(reps: DataFrame, curves: Curves, ranges: int) -> DataFrame:
    """``curve``, ``range``, ``rep``, ``v``: each vector once for each curve, in ranges of the curve's keys.

    Spark's range partitioning makes the ranges; ties of a key are cut apart by the id. A range number is a partition's number.
    """

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = curves.keys(unit(matrix(batch.column(1))))
            for c, key in enumerate(keys):
                yield pa.record_batch({"curve": pa.array(np.full(len(key), c, np.int32)), "key": pa.array(key), "rep": batch.column(0), "v": batch.column(1)})

    rows = reps.select("rep", "v").mapInArrow(keyed, "curve int, key long, rep long, v array<double>")
    return rows.repartitionByRange(CURVES * ranges, "curve", "key", "rep").select("curve", F.spark_partition_id().alias("range"), "rep", "v")


def window_radius(reps: DataFrame, asked: DataFrame, index: DataFrame, most: int) -> int:
    """How many ranges to each side a query has to look, so that WANTED of the sample queries' true neighbours are found on some curve.

    Two bounded frames reach the driver: the PROBES vectors, and the ranges of them and their neighbours.
    """
    sample = asked.select("rep").distinct().orderBy(F.xxhash64(F.lit("probe"), "rep")).limit(PROBES)
    probes = reps.join(sample, "rep", "left_semi").select("rep", "v").toArrow()
    if not probes.num_rows:
        return 0
    ids, vectors = probes["rep"].to_numpy(), matrix(probes["v"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for who, which, score in top(vectors, matrix(batch.column(1)), most) if batch.num_rows else ():
                yield pa.record_batch({"probe": ids[who], "rep": batch.column(0).to_numpy()[which], "score": score})

    near = reps.select("rep", "v").mapInArrow(search, "probe long, rep long, score double")
    place = F.row_number().over(Window.partitionBy("probe").orderBy(F.desc("score"), "rep"))
    near = near.withColumn("place", place).where(F.col("place") <= most).select("probe", "rep").toPandas()
    wanted = np.unique(np.concatenate([near["rep"], near["probe"]]))
    wanted = F.broadcast(reps.sparkSession.createDataFrame([(int(x),) for x in wanted], "rep long"))
    at = index.join(wanted, "rep", "left_semi").select("rep", "curve", "range").toPandas().pivot(index="rep", columns="curve", values="range")
    apart = np.abs(at.loc[near["probe"]].to_numpy() - at.loc[near["rep"]].to_numpy()).min(1)
    return int(np.sort(apart)[min(len(apart) - 1, int(np.ceil(WANTED * len(apart))) - 1)])
