"""Embedding near-dedup: a dual traversal of cover trees finds all pairs of vectors within a threshold.

The top level of the tree is a bounded set of centres; each vector belongs to its nearest, and the vectors of a centre
are cut into chunks of bounded size. Each chunk has a tree of nested levels whose radii halve from level to level. Pairs of
chunks, and then pairs of nodes, are dropped where the distance of the centres exceeds the covering radii and the
threshold together, and linked as a whole where it is so small that every pair within must be near.

A chunk and its tree are written once, and each task reads the files of the pairs it compares, so that pairs take time but no disk.
Vectors are moved as bytes, once; ids and copies go by a digest of the vector.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.session import written

from .ann import cosines, unit
from .common import connected_components
from .vectors import packed, scaled, unpacked

#: Centres at the top at most, vectors for each on average, and vectors of a chunk.
CENTRES, PER_CENTRE, CHUNK = 1_024, 4_096, 2_048
#: Bytes of chunks that are read and compared together.
PAGE = 1 << 22
#: Nodes of so few vectors are not divided further.
LEAF = 24
#: Bytes of a vector's digest, by which copies are known.
KEY = 16
#: What double precision may be wrong by in a cosine.
TIE = 1e-9
#: What single precision may be wrong by, in a cosine and in a distance.
COSINE_SLACK, CHORD_SLACK = 1e-5, 1e-3
#: Rows of a block of products, and of one that is only held against the threshold, which the processor's cache should hold.
BLOCK, POINT_BLOCK = 1_024, 256


def chords(cosine):
    return np.sqrt(np.maximum(0, 2 - 2 * cosine))


class Tree:
    """A cover tree of some unit vectors, as arrays: vectors in tree order, and for each node its span, covering radius and children."""

    def __init__(self, points: np.ndarray):
        self.order, self.centre, self.begin, self.end, self.radius, self.children = [], [], [], [], [], []
        single = points.astype(np.float32)
        members = np.arange(len(points))
        self._node(single, members, chords(single @ single[0]))
        self.order, self.centre, self.begin, self.end = (np.array(x, np.int32) for x in (self.order, self.centre, self.begin, self.end))
        self.radius = np.array(self.radius, np.float32)

    def _node(self, points: np.ndarray, members: np.ndarray, far: np.ndarray) -> int:
        """Add the node of ``members``, whose centre is the first of them, and the nodes below it."""
        me, radius = len(self.centre), float(far.max()) if len(members) > 1 else 0.0
        self.centre.append(int(members[0]))
        self.begin.append(len(self.order))
        self.end.append(0)
        self.radius.append(radius)
        self.children.append([])
        if len(members) <= LEAF or radius < CHORD_SLACK:
            self.order += members.tolist()
        else:
            # The next level: balls of half the radius, first around the node's own centre, then around the first vector that is left uncovered.
            near = points[members] @ points[members].T
            left, covered = np.arange(len(members)), 1 - radius * radius / 8
            while len(left):
                row = near[left[0], left]
                inside = row >= covered
                inside[0] = True
                self.children[me].append(self._node(points, members[left[inside]], chords(row[inside])))
                left = left[~inside]
        self.end[me] = len(self.order)
        return me

    def place(self, points: np.ndarray) -> None:
        """Set the vectors, given in tree order, in which a node's centre is the first of its span."""
        self.points = points.astype(np.float32)
        self.centres, self.single = self.points[self.begin], self.end - self.begin == 1


class Links:
    """Counts of links, and a forest that connects what is linked, for the vectors of two trees (one tree twice if ``same``)."""

    def __init__(self, n_a: int, n_b: int, weight_a: np.ndarray, weight_b: np.ndarray, same: bool):
        self.same, self.shift = same, 0 if same else n_a
        self.weight_a, self.weight_b = weight_a, weight_b
        self.count = np.zeros(n_a + (0 if same else n_b), np.int64)
        self.label = np.arange(len(self.count))
        self.ends: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def pairs(self, i: np.ndarray, j: np.ndarray) -> None:
        np.add.at(self.count, i, self.weight_b[j])
        np.add.at(self.count, j + self.shift, self.weight_a[i])
        self._join(i, j + self.shift)

    def product(self, a: slice, b: slice) -> None:
        """Every vector of one span is linked with every one of the other."""
        self.count[a] += self.weight_b[b].sum()
        self.count[b.start + self.shift : b.stop + self.shift] += self.weight_a[a].sum()
        i, j = np.arange(a.start, a.stop), np.arange(b.start, b.stop) + self.shift
        self._join(i, np.full(len(i), j[0]))
        self._join(np.full(len(j), i[0]), j)

    def within(self, a: slice) -> None:
        """Every vector of a span is linked with every other of it."""
        self.count[a] += self.weight_a[a].sum() - self.weight_a[a]
        i = np.arange(a.start, a.stop)
        self._join(i, np.full(len(i), i[0]))

    def _join(self, i: np.ndarray, j: np.ndarray) -> None:
        self.ends.append((i, j))
        self.waiting += len(i)
        if self.waiting > 500_000:
            self.settle()

    def settle(self) -> np.ndarray:
        """Labels of the parts so far; the edges are forgotten."""
        if self.ends:
            i, j = (np.concatenate(x) for x in zip(*self.ends))
            while True:
                least = np.minimum(self.label[i], self.label[j])
                before = self.label.copy()
                np.minimum.at(self.label, before[i], least)
                np.minimum.at(self.label, before[j], least)
                np.minimum.at(self.label, i, least)
                np.minimum.at(self.label, j, least)
                self.label = self.label[self.label]
                if (self.label == before).all():
                    break
            self.ends, self.waiting = [], 0
        return self.label


def traverse(a: Tree, b: Tree, exact_a: np.ndarray, exact_b: np.ndarray, threshold: float, links: Links) -> None:
    """Find all pairs of the two trees with a cosine of ``threshold`` at least; ``exact_*`` are the vectors without loss, in tree order."""
    chord = float(np.sqrt(2 - 2 * threshold))
    todo = [(0, 0)]
    while todo:
        x, y = todo.pop()
        twice = links.same and x == y
        if twice and 2 * a.radius[x] + CHORD_SLACK < chord:
            links.within(slice(int(a.begin[x]), int(a.end[x])))
            continue
        if not a.children[x] and not b.children[y]:
            compare(a, b, slice(int(a.begin[x]), int(a.end[x])), slice(int(b.begin[y]), int(b.end[y])), exact_a, exact_b, threshold, links, twice)
            continue
        # The wider node is opened, both where it is one node with itself.
        open_x = bool(a.children[x]) and (twice or not b.children[y] or a.radius[x] >= b.radius[y] / 2)
        open_y = bool(b.children[y]) and (twice or not a.children[x] or b.radius[y] >= a.radius[x] / 2)
        xs, ys = np.array(a.children[x] if open_x else [x]), np.array(b.children[y] if open_y else [y])
        # Single vectors, which may be most of the children, have no radius; of the other pairs one node at least has.
        one, other = a.single[xs], b.single[ys]
        compare_points(a, b, xs[one], ys[other], exact_a, exact_b, threshold, links, twice)
        for own, ys_ in ((xs[~one], ys), (xs[one], ys[~other])):
            for at in range(0, len(own) if len(ys_) else 0, BLOCK):
                todo += compare_nodes(a, b, own[at : at + BLOCK], ys_, chord, links, twice)


def compare_points(a: Tree, b: Tree, xs: np.ndarray, ys: np.ndarray, exact_a, exact_b, threshold: float, links: Links, twice: bool) -> None:
    """All pairs of nodes that hold one vector each; those of one node with itself (``twice``) once."""
    p, q = a.begin[xs], b.begin[ys]
    right, least = b.points[q].T, np.float32(threshold - COSINE_SLACK)
    room = np.empty((min(len(p), POINT_BLOCK), len(q)), np.float32)
    for at in range(0, len(p) if len(q) else 0, POINT_BLOCK):
        own = p[at : at + POINT_BLOCK]
        near = np.matmul(a.points[own], right, out=room[: len(own)])
        found = np.flatnonzero((near >= least).ravel())
        if len(found):
            i, j, cosine = own[found // len(q)], q[found % len(q)], near.ravel()[found]
            if twice:
                i, j, cosine = i[i < j], j[i < j], cosine[i < j]
            settle_pairs(i, j, cosine, exact_a, exact_b, threshold, links)


def compare_nodes(a: Tree, b: Tree, own: np.ndarray, ys: np.ndarray, chord: float, links: Links, twice: bool) -> list[tuple[int, int]]:
    """Link the pairs of nodes that are near as a whole, and return those that the radii do not settle."""
    near = a.centres[own] @ b.centres[ys].T
    reach = a.radius[own][:, None] + b.radius[ys][None, :]
    # A chord d belongs to a cosine of 1 - d * d / 2.
    far = np.minimum(2, reach + (chord + CHORD_SLACK))
    keep = near >= 1 - far * far / 2
    if twice:
        keep &= own[:, None] <= ys[None, :]
    i, j = np.nonzero(keep)
    cosine, both = near[i, j], reach[i, j]
    i, j = own[i], ys[j]
    inside = (chords(cosine) + both + CHORD_SLACK < chord) & ~(links.same & (i == j))
    for u, v in zip(i[inside].tolist(), j[inside].tolist()):
        links.product(slice(int(a.begin[u]), int(a.end[u])), slice(int(b.begin[v]), int(b.end[v])))
    return list(zip(i[~inside].tolist(), j[~inside].tolist()))


def compare(a: Tree, b: Tree, s: slice, t: slice, exact_a, exact_b, threshold: float, links: Links, twice: bool) -> None:
    """All vectors of two leaves."""
    near = a.points[s] @ b.points[t].T
    keep = near >= threshold - COSINE_SLACK
    if twice:
        keep = np.triu(keep, 1)
    i, j = np.nonzero(keep)
    settle_pairs(i + s.start, j + t.start, near[i, j], exact_a, exact_b, threshold, links)


def settle_pairs(i, j, near, exact_a, exact_b, threshold: float, links: Links) -> None:
    """Link the pairs that are near, those close to the threshold by their cosine in double precision."""
    linked = near >= threshold + COSINE_SLACK
    open_ = np.flatnonzero(~linked & (near >= threshold - COSINE_SLACK))
    if len(open_):
        linked[open_] = cosines(exact_a[i[open_]].astype(np.float64), exact_b[j[open_]].astype(np.float64)) >= threshold
    if linked.any():
        links.pairs(i[linked], j[linked])


def near_duplicates(vectors: DataFrame, threshold: float = 0.9, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept``: one row for each id.

    Two vectors link if their cosine, in double precision, is ``threshold`` at least (which must be above 0). ``n_links`` counts the other
    ids linked directly, ``component_id`` is the smallest id that links reach, and ``kept`` tells whether it is the row's own. Vectors that are
    null, empty, zero, or hold null or non-finite components link with nothing: 0 links, their own component. Vectors of different lengths do not link; each length is matched by itself. Repeated rows are one row, rows without
    an id are left out, other columns are ignored, an empty table gives an empty result. An id with several vectors has the links of all of them.

    Copies of a vector are one vector with a count, however many. In a group of near copies whole nodes link at once, and each task hands on a count for each vector
    and a forest, never the pairs. No link is lost: only what the radii exclude is left out.
    """
    given = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).alias("v"))
    if given.schema["v"].dataType.simpleString() != "array<float>":
        given = given.withColumn("v", F.col("v").cast("array<double>"))
    given = given.where("vec_id is not null and size(v) > 0")
    found = []
    for size, n in sorted(tuple(r) for r in given.groupBy(F.size("v")).agg(F.approx_count_distinct(F.xxhash64("v"))).collect()):
        own = given.where(F.size("v") == size)
        # One vector of each part of the keys is a centre, so that no two are copies.
        part = F.pmod(F.xxhash64(F.lit("centre"), "key"), F.lit(min(CENTRES, max(1, -(-n // PER_CENTRE)))))
        sample = own.mapInArrow(each_vector, "key binary, v binary").groupBy(part.alias("part")).agg(F.min(F.struct("key", "v")).alias("first")).select("first.v").toArrow()["v"].to_pylist()
        if sample:
            found.append(matched(own, unit(scaled(unpacked(sorted(sample), size))), threshold))
    ids = vectors.select(F.col(vec_id).cast("long").alias("vec_id")).where("vec_id is not null").distinct()
    if not found:
        return ids.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    rows, reps, counts, edges = [reduce(DataFrame.unionByName, part) for part in zip(*found)]
    # Only the vectors that have copies or links need to be looked up.
    parts = connected_components(edges, "rep", "root")
    linked = reps.join(counts, "rep", "left").join(parts, reps["rep"] == parts["node"], "left")
    linked = linked.select("key", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "rep").alias("component")).where("copies > 1 or links > 0")
    mine = rows.join(linked, "key").groupBy("vec_id").agg(F.sum(F.col("links") + F.col("copies") - 1).alias("links"), F.min("component").alias("component"))
    out = ids.join(mine.withColumnRenamed("vec_id", "id__"), F.col("vec_id") == F.col("id__"), "left")
    out = out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def different(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list[bytes], pa.Array]:
    """Of a batch of ``vec_id`` and lists of one length: positions of the usable rows, for each the place of its vector among the different ones, and the bytes
    and keys of these. A key is a digest of the vector and its length."""
    usable, data = packed(batch.column(1)) if batch.num_rows else (np.zeros(0, np.int64), [])
    places: dict[bytes, int] = {}
    of = np.array([places.setdefault(x, len(places)) for x in data], np.int64)
    size = len(batch.column(1)[0]).to_bytes(8, "little") if data else b""
    return usable, of, list(places), pa.array([hashlib.sha256(size + x).digest()[:KEY] for x in places], pa.binary())


def each_vector(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``key`` and ``v`` (the bytes) of the different vectors of each batch."""
    for batch in batches:
        _, _, vectors, keys = different(batch)
        yield pa.record_batch({"key": keys, "v": pa.array(vectors, pa.binary())})


def matched(given: DataFrame, centres: np.ndarray, threshold: float) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """For vectors of one length: the different rows (``vec_id``, ``key``), the different vectors (``key``, ``rep``: the smallest id, ``copies``: ids), links of
    each vector (``rep``, ``links``: counted with copies), and edges (``rep``, ``root``) that connect what is linked."""
    chord = float(np.sqrt(2 - 2 * threshold))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row's key, its vector's nearest centre, and how far that is."""
        for batch in batches:
            usable, of, data, keys = different(batch)
            near = closeness(data)
            own = near.argmax(1)
            far = chords(near[np.arange(len(own)), own])
            yield pa.record_batch({"vec_id": batch.column(0).take(pa.array(usable)), "key": keys.take(pa.array(of)), "centre": own.astype(np.int64)[of], "far": far[of]})

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The bytes of each vector for its nearest centre, and for those that are as near but for rounding."""
        for batch in batches:
            _, _, data, keys = different(batch)
            near = closeness(data)
            i, c = np.nonzero(near >= near.max(1, keepdims=True) - TIE)
            yield pa.record_batch({"centre": c, "key": keys.take(pa.array(i)), "v": pa.array(data, pa.binary()).take(pa.array(i))})

    def closeness(data: list[bytes]) -> np.ndarray:
        return unit(scaled(unpacked(data, centres.shape[1]))) @ centres.T

    # Products may be rounded differently in another batch, so that copies get different centres: the vector belongs to the least of them.
    rows = written(given.mapInArrow(assign, "vec_id long, key binary, centre long, far double").groupBy("vec_id", "key").agg(F.min("centre").alias("centre"), F.max("far").alias("far")), "rows")
    reps = written(rows.groupBy("key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.min("centre").alias("centre")), "distinct-vectors")
    # One row for each of the centres, of which there are CENTRES at most.
    radius = np.full(len(centres), -np.inf)
    for r in rows.groupBy("centre").agg(F.max("far").alias("radius")).collect():
        radius[r["centre"]] = r["radius"]
    chunks = np.zeros(len(centres), np.int64)
    for r in reps.groupBy("centre").count().collect():
        chunks[r["centre"]] = -(-r["count"] // CHUNK)
    begin = np.cumsum(chunks) - chunks
    partner = (chords(centres @ centres.T) <= radius[:, None] + radius + chord + CHORD_SLACK) | np.eye(len(centres), dtype=bool)
    several = F.element_at(F.create_map(*[F.lit(int(x)) for c in np.flatnonzero(chunks) for x in (c, chunks[c])]), F.col("centre"))
    chunk = F.pmod(F.xxhash64(F.lit("chunk"), "key"), several).alias("chunk")

    def grow(rows: pa.Table, owned: pa.Table) -> pa.Table:
        """The chunk and its tree. Copies have brought their bytes several times, and rounding those of other chunks' vectors: the chunk's own are taken once."""
        out = []
        if owned.num_rows:
            c, k = owned["centre"][0].as_py(), owned["chunk"][0].as_py()
            held = dict(zip(rows["key"].to_pylist(), rows["v"].to_pylist()))
            vectors = scaled(unpacked([held[x] for x in owned["key"].to_pylist()], centres.shape[1]))
            tree = Tree(unit(vectors))
            vectors, ids, copies = (x[tree.order] for x in (vectors, owned["rep"].to_numpy(), owned["copies"].to_numpy()))
            tree.order = tree.centre = None  # not needed where the vectors are in tree order
            single = vectors.astype(np.float32)
            out = [{"place": int(begin[c]) + k, "centre": c, "chunk": pickle.dumps((ids, copies, single if (single == vectors).all() else vectors, tree))}]
        return pa.Table.from_pylist(out, schema=pa.schema([("place", pa.int64()), ("centre", pa.int64()), ("chunk", pa.binary())]))

    def bind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pages of chunks, with the centres whose chunks they may have links with."""
        held = []
        for row in (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns))):
            held.append(row)
            if sum(len(chunk) for *_, chunk in held) >= PAGE:
                yield page(held)
                held = []
        if held:
            yield page(held)

    def page(held: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        own = sorted({centre for _, centre, _ in held})
        return pa.record_batch({"page": [held[0][0]], "centres": [own], "partners": [np.flatnonzero(partner[own].any(0))], "chunks": [pickle.dumps([chunk[1:] for chunk in held])]})

    def load(chunks: pa.Scalar) -> list[tuple]:
        out = []
        for centre, chunk in pickle.loads(chunks.as_buffer()):
            ids, copies, vectors, tree = pickle.loads(chunk)
            tree.place(unit(vectors))
            out.append((centre, ids, copies, vectors, tree))
        return out

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, left = None, []
        for batch in batches:
            for x, y, a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                if x != held:
                    held, left = x, load(a)
                right = left if x == y else load(b)
                for i, (centre, ids, copies, vectors, tree) in enumerate(left):
                    for j, (centre_b, ids_b, copies_b, vectors_b, tree_b) in enumerate(right):
                        if partner[centre, centre_b] and (x != y or i <= j):
                            same = x == y and i == j
                            links = Links(len(ids), len(ids_b), copies, copies_b, same)
                            traverse(tree, tree_b, vectors, vectors_b, threshold, links)
                            every = ids if same else np.concatenate([ids, ids_b])
                            has = np.flatnonzero(links.count)
                            yield pa.record_batch({"rep": every[has], "links": links.count[has], "root": every[links.settle()[has]]})

    key = ["centre", "chunk"]
    bytes_of = given.mapInArrow(route, "centre long, key binary, v binary").select("centre", chunk, "key", "v")
    owned = reps.select("centre", chunk, "key", "rep", "copies")
    trees = bytes_of.groupBy(*key).cogroup(owned.groupBy(*key)).applyInArrow(grow, "place long, centre long, chunk binary")
    pages = written(trees.mapInArrow(bind, "page long, centres array<long>, partners array<long>, chunks binary"), "pages")
    # Each pair of pages once, in one order or the other, so that all tasks get as many. A task reads two parts of the written pages; nothing is shuffled.
    a, b = pages.select(F.col("page").alias("x"), "partners", F.col("chunks").alias("a")), pages.select(F.col("page").alias("y"), "centres", F.col("chunks").alias("b"))
    once = F.expr("x = y or (x < y) = ((x + y) % 2 = 0)")
    pairs = a.join(b.hint("shuffle_replicate_nl"), once & F.arrays_overlap("partners", "centres")).select("x", "y", "a", "b")
    found = written(pairs.mapInArrow(match, "rep long, links long, root long"), "links")
    return rows.select("vec_id", "key"), reps.select("key", "rep", "copies"), found.groupBy("rep").agg(F.sum("links").alias("links")), found.select("rep", "root")
