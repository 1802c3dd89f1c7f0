"""Embedding whitening by an exact characteristic polynomial.

Vectors become integers, so the scatter matrix of the distinct ones is a matrix of integers. Its characteristic
polynomial is found modulo many primes, each by a Hessenberg reduction in a task of its own, and put together by Chinese
remaindering. As all its roots are real, the sign changes of the shifted polynomial count the roots above a point
exactly; bisection isolates the largest ones, and inverse iteration at these with a hundred digits gives the components.

What passes through the driver is bounded by the square of the dimension, whatever the number of vectors.
"""

from __future__ import annotations

import ast
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.session import written

#: An entry c becomes floor(SCALE * c) + OFFSET. The offset changes neither centred value, so sums are kept without it.
SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
#: Bits of a limb, and rows multiplied at once: a sum of so many products of two limbs is exact in a double.
LIMB, CHUNK = 21, 2048
#: Chunks whose sums, of 53 bits each, fit 64 bits.
FLUSH = 512
#: Roots are enclosed to the trace divided by 2^ROOT_BITS; roots closer than that by 2^SAME_BITS are one cluster.
ROOT_BITS, SAME_BITS = 170, 130
#: Digits of the inverse iteration, and its steps.
DIGITS, STEPS = 110, 3
SUMS = "d int, i int, values array<decimal(38,0)>"


def integer_vectors(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``vec_id`` and ``y``, the integers without the offset. Vectors that are null, empty, or hold null or non-finite entries
    (or one whose integer is no 64-bit number) are left out; repeated rows and rows without an id stay."""
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
    usable = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float(2**62) / SCALE))
    rows = rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & usable)
    return rows.select("vec_id", F.transform("v", lambda c: F.floor(c * SCALE)).alias("y"))


def by_dimension(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The places of the vectors of each length, and these as a matrix."""
    lengths = np.diff(column.offsets.to_numpy())
    starts, flat = column.offsets.to_numpy()[:-1], column.values.to_numpy(zero_copy_only=False)
    for d in np.unique(lengths):
        at = np.flatnonzero(lengths == d)
        yield at, flat[starts[at][:, None] + np.arange(d)]


def limbs(y: np.ndarray) -> list[np.ndarray]:
    """Numbers as digits to the base 2^LIMB, the last one signed; small numbers are one digit. As doubles."""
    out = []
    while np.abs(y).max(initial=0) >= 1 << LIMB:
        out.append((y & ((1 << LIMB) - 1)).astype(np.float64))
        y = y >> LIMB
    return [*out, y.astype(np.float64)]


class Scatter:
    """Exact sums of vectors and of products of their entries."""

    def __init__(self, d: int):
        self.n, self.total, self.products = 0, np.zeros(d, object), np.zeros((d, d), object)
        self.open: dict[int, np.ndarray] = {}
        self.added = 0

    def add(self, y: np.ndarray) -> None:
        for at in range(0, len(y), CHUNK):
            part = y[at : at + CHUNK]
            digits = limbs(part)
            for k, a in enumerate(digits):
                self.total += a.sum(0).astype(np.int64).astype(object) << (LIMB * k)
                for m, b in enumerate(digits):
                    sums = (a.T @ b).astype(np.int64)
                    self.open[k + m] = self.open[k + m] + sums if k + m in self.open else sums
            self.n += len(part)
            self.added += len(digits)
            if self.added >= FLUSH:
                self.flush()

    def flush(self) -> None:
        for shift, sums in self.open.items():
            self.products += sums.astype(object) << (LIMB * shift)
        self.open, self.added = {}, 0


def scatter_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each row of the upper triangle of a task's products, and one (``i`` = -1) of its count and sums."""
    found: dict[int, Scatter] = {}
    for batch in batches:
        for _, y in by_dimension(batch.column(0)):
            found.setdefault(y.shape[1], Scatter(y.shape[1])).add(y)
    for d, s in found.items():
        s.flush()
        rows = [[s.n, *s.total], *[s.products[i, i:] for i in range(d)]]
        values = pa.array([[Decimal(int(x)) for x in row] for row in rows], pa.list_(pa.decimal128(38, 0)))
        yield pa.record_batch({"d": pa.array([d] * (d + 1), pa.int32()), "i": pa.array(range(-1, d), pa.int32()), "values": values})


@dataclass(frozen=True)
class Moments:
    """Number of vectors of one length, their sums, and n^2 times their covariance, all exact."""

    n: int
    sums: list[int]
    scatter: np.ndarray


def moments(fit: DataFrame) -> dict[int, Moments]:
    """By dimension. Tasks add up their own rows; what is collected has a row for each pair of dimensions."""
    parts = fit.select("y").mapInArrow(scatter_sums, SUMS).select("d", "i", F.posexplode("values").alias("j", "value"))
    found: dict[int, tuple[list, np.ndarray]] = {}
    for d, i, j, value in parts.groupBy("d", "i", "j").agg(F.sum("value")).collect():
        head, products = found.setdefault(d, ([0] * (d + 1), np.zeros((d, d), object)))
        if i < 0:
            head[j] = int(value)
        else:
            products[i, i + j] = products[i + j, i] = int(value)
    out = {}
    for d, (head, products) in sorted(found.items()):
        n, total = head[0], np.array([*head[1:], None], object)[:-1]
        out[d] = Moments(n, list(total), n * products - np.multiply.outer(total, total))
    return out


# -- the characteristic polynomial


def is_prime(n: int) -> bool:
    """Miller and Rabin's test; the bases decide all numbers of 31 bits."""
    odd, twos = n - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, n)
        if x not in (1, n - 1) and not any((x := x * x % n) == n - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_beyond(bound: int) -> list[int]:
    """The largest primes of 31 bits whose product is greater than ``bound``."""
    found, product, n = [], 1, 2**31 - 1
    while product <= bound:
        if is_prime(n):
            found.append(n)
            product *= n
        n -= 2
    return found


def characteristic_modulo(matrix: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(x - matrix) modulo a prime, that of x^0 first, by reduction to Hessenberg form."""
    h = (matrix % p).astype(np.int64)
    d = len(h)
    for k in range(d - 2):
        below = np.flatnonzero(h[k + 1 :, k])
        if not len(below):
            continue
        at = k + 1 + int(below[0])
        if at != k + 1:
            h[[k + 1, at]] = h[[at, k + 1]]
            h[:, [k + 1, at]] = h[:, [at, k + 1]]
        u = h[k + 2 :, k] * pow(int(h[k + 1, k]), -1, p) % p
        h[k + 2 :] = (h[k + 2 :] - u[:, None] * h[k + 1] % p) % p
        h[:, k + 1] = (h[:, k + 1] + (h[:, k + 2 :] * u % p).sum(1)) % p
    polys = np.zeros((d + 1, d + 1), np.int64)
    polys[0, 0] = 1
    for k in range(1, d + 1):
        weights, run = np.zeros(k, np.int64), 1
        weights[k - 1] = h[k - 1, k - 1]
        for m in range(k - 2, -1, -1):
            run = run * int(h[m + 1, m]) % p
            weights[m] = int(h[m, k - 1]) * run % p
        polys[k, 1:] = polys[k - 1, :-1]
        polys[k] = (polys[k] - (weights[:, None] * polys[:k] % p).sum(0)) % p
    return polys[d]


def characteristic(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """The elementary symmetric sums e_0 .. e_d of the eigenvalues of a positive semidefinite integer matrix.

    They are the polynomial's coefficients but for their signs, none is negative, and Maclaurin's inequality bounds
    e_k by C(d, k) (trace / d)^k. A prime is a task's work.
    """
    d, trace = len(matrix), int(np.trace(matrix))
    bound = max(math.comb(d, k) * (trace // d + 1) ** k for k in range(d + 1))
    primes = primes_beyond(bound)

    def residues(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column(0).to_pylist():
                yield pa.record_batch({"p": pa.array([p], pa.int64()), "c": pa.array([characteristic_modulo(matrix, p)[::-1]], pa.list_(pa.int64()))})

    tasks = min(len(primes), 4 * spark.sparkContext.defaultParallelism)
    of = spark.createDataFrame([(p,) for p in primes], "p long").repartition(tasks)
    found, modulus = [0] * (d + 1), 1
    for p, c in sorted(of.mapInArrow(residues, "p long, c array<bigint>").collect()):
        inverse = pow(modulus, -1, p)
        for k in range(d + 1):
            wanted = c[k] if k % 2 == 0 else -c[k]
            found[k] += modulus * ((wanted - found[k]) * inverse % p)
        modulus *= p
    if found[:2] != [1, trace]:
        raise ArithmeticError("the characteristic polynomial does not agree with the trace")
    return found


# -- its largest roots


def roots_above(coefficients: list[int], point: int, bits: int) -> int:
    """How many roots, counted as often as they occur, are greater than point / 2^bits.

    ``coefficients`` are those of a polynomial with real roots only, that of the highest power first. For such, the number of
    positive roots is the number of sign changes (Descartes), here of the polynomial shifted by the point.
    """
    shifted = [c << (bits * k) for k, c in enumerate(coefficients)]
    d = len(shifted) - 1
    for last in range(d, 0, -1):
        for k in range(1, last + 1):
            shifted[k] += point * shifted[k - 1]
    signs = [c > 0 for c in shifted if c]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def value_at(coefficients: list[int], point: int, bits: int) -> int:
    """The polynomial at point / 2^bits, times a power of two."""
    value = 0
    for k, c in enumerate(coefficients):
        value = value * point + (c << (bits * k))
    return value


def enclose(coefficients: list[int], k: int, trace: int) -> tuple[int, int, int]:
    """Low and high ends, as multiples of 2^-bits, and bits, of a half-open interval (low, high] that holds the k-th largest root.

    Exact counts halve the interval until it holds one root; then the sign of the polynomial does, which costs a
    d-th. A root that occurs several times never stands alone and is enclosed by counts all the way.
    """
    low, high, bits, alone = 0, trace, 0, False
    while (high - low) << ROOT_BITS > trace << bits:
        if high - low <= 1:
            low, high, bits = low << 16, high << 16, bits + 16
        middle = (low + high) // 2
        if alone:
            at = value_at(coefficients, middle, bits)
            above = at != 0 and (at > 0) == sign
        else:
            above = roots_above(coefficients, middle, bits) >= k
        low, high = (middle, high) if above else (low, middle)
        if not alone and roots_above(coefficients, low, bits) == k and roots_above(coefficients, high, bits) == k - 1:
            # Left of a single root, and right of all smaller ones, the sign is that of k roots above.
            alone, sign = True, k % 2 == 0
    return low, high, bits


def clusters(enclosed: list[tuple[int, int, int]], trace: int) -> list[tuple[int, int, Decimal]]:
    """First component (from 0), number of components and eigenvalue of each run of roots that nothing tells apart."""
    with localcontext(prec=DIGITS):
        values = [(Decimal(low) + Decimal(high)) / 2 / Decimal(2) ** bits for low, high, bits in enclosed]
        same = Decimal(trace) / Decimal(2) ** SAME_BITS
        out: list[list] = []
        for k, value in enumerate(values):
            if out and values[k - 1] - value <= same:
                out[-1][1] += 1
            else:
                out.append([k, 1, value])
    return [tuple(c) for c in out]


def null_vectors(matrix: np.ndarray, value: Decimal, size: int) -> list[list[float]]:
    """Orthonormal vectors that the matrix less ``value`` takes to almost nothing, by inverse iteration with DIGITS digits."""
    with localcontext(prec=DIGITS):
        d = len(matrix)
        exact = np.array([[Decimal(int(x)) for x in row] for row in matrix], object).reshape(d, d)
        a = exact.copy()
        a[np.diag_indices(d)] -= value
        largest = max(abs(x) for x in exact.ravel()) or Decimal(1)
        order = np.arange(d)
        for k in range(d):
            at = k + max(range(d - k), key=lambda r: abs(a[k + r, k]))
            a[[k, at]], order[[k, at]] = a[[at, k]], order[[at, k]]
            if not a[k, k]:
                a[k, k] = largest.scaleb(-DIGITS)
            a[k + 1 :, k] = a[k + 1 :, k] / a[k, k]
            a[k + 1 :, k + 1 :] -= np.multiply.outer(a[k + 1 :, k], a[k, k + 1 :])
        random = np.random.default_rng(d)
        block = [np.array([Decimal(int(x)) for x in random.integers(-(10**6), 10**6, d)], object) for _ in range(size)]
        for _ in range(STEPS):
            done: list[np.ndarray] = []
            for v in block:
                x = v[order]
                for k in range(1, d):
                    x[k] -= a[k, :k] @ x[:k]
                for k in range(d - 1, -1, -1):
                    x[k] = (x[k] - (a[k, k + 1 :] @ x[k + 1 :] if k + 1 < d else 0)) / a[k, k]
                x = x / max(abs(e) for e in x)
                for _ in range(2):
                    for other in done:
                        x = x - (x @ other) * other
                    x = x / (x @ x).sqrt()
                done.append(x)
            block = done
        for v in block:
            if max(abs(e) for e in exact @ v - value * v) > largest.scaleb(-30):
                raise ArithmeticError("the inverse iteration has not converged")
        return [[float(e) for e in v] for v in block]


# -- fitting and applying


@dataclass(frozen=True)
class Whitening:
    """For vectors of one length: number and sums of the fit list, components as columns, their eigenvalues and shares."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def centred(self, y: np.ndarray) -> np.ndarray:
        """n y - sums, exactly."""
        most = max(int(np.abs(y).max(initial=0)) * self.n, max(abs(int(s)) for s in self.sums))
        if most < 1 << 61:
            return self.n * y - self.sums.astype(np.int64)
        return self.n * y.astype(object) - self.sums

    def apply(self, y: np.ndarray) -> np.ndarray:
        """One column for each component; not a number where the eigenvalue is zero."""
        with np.errstate(divide="ignore", invalid="ignore"):
            scaled = np.where(self.eigenvalues > 0, self.components / np.sqrt(self.eigenvalues), np.nan)
        return (self.centred(y).astype(np.float64) / self.n) @ scaled

    def deviations(self, y: np.ndarray) -> list[Decimal | None]:
        """Sums of squares of ``centred``; None beyond 38 digits."""
        c = self.centred(y)
        if c.dtype != object and y.shape[1] * int(np.abs(c).max(initial=0)) ** 2 < 1 << 62:
            return [Decimal(x) for x in (c * c).sum(1).tolist()]
        return [Decimal(s) if s < 10**38 else None for s in ((c.astype(object) ** 2).sum(1)).tolist()]


def _solve(spark: SparkSession, found: Moments, components: int) -> Whitening:
    """The components of one fit list. Roots, and clusters of them, are tasks of their own."""
    d, m = len(found.sums), found.scatter
    trace, k = int(np.trace(m)), min(components, len(found.sums))
    symmetric = characteristic(spark, m)
    coefficients = [c if i % 2 == 0 else -c for i, c in enumerate(symmetric)]
    rank = min(k, max(i for i, c in enumerate(symmetric) if c))

    def each(tasks: list, work: Callable) -> list:
        """``work`` on each of a few numbered tasks, in Spark; results as text."""

        def run(batches):
            for batch in batches:
                for i in batch.column(0).to_pylist():
                    yield pa.record_batch({"i": pa.array([i], pa.int32()), "found": pa.array([repr(work(tasks[i]))])})

        numbers = spark.range(len(tasks)).select(F.col("id").cast("int").alias("i")).repartition(max(1, len(tasks)))
        return [ast.literal_eval(text) for _, text in sorted(numbers.mapInArrow(run, "i int, found string").collect())]

    enclosed = each(list(range(1, rank + 1)), lambda place: enclose(coefficients, place, trace))
    runs = clusters([tuple(e) for e in enclosed], trace)
    vectors = [v for block in each(runs, lambda run: null_vectors(m, run[2], run[1])) for v in block]
    with localcontext(prec=DIGITS):
        of_root = [value for _, size, value in runs for _ in range(size)]
        eigenvalues = [float(v / Decimal(found.n) ** 2) for v in of_root] + [0.0] * (k - rank)
        shares = [float(v / Decimal(trace)) for v in of_root] + [0.0 if trace else math.nan] * (k - rank)
    matrix = np.array(vectors + [[0.0] * d] * (k - rank)).reshape(k, d).T
    return Whitening(found.n, np.array(found.sums, object), matrix, np.array(eigenvalues), np.array(shares))


def _covariance_error(fit: DataFrame, models: dict[int, Whitening]) -> dict[int, float]:
    """By dimension: the largest absolute entry of the covariance of the whitened fit list less the identity."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for _, y in by_dimension(batch.column(0)):
                model = models[y.shape[1]]
                w = np.column_stack([np.ones(len(y)), model.apply(y)[:, model.eigenvalues > 0]])
                found[y.shape[1]] = found.get(y.shape[1], 0) + w.T @ w
        for d, total in found.items():
            i, j = np.indices(total.shape)
            yield pa.record_batch({"d": pa.array(np.full(total.size, d), pa.int32()), "i": pa.array(i.ravel(), pa.int32()), "j": pa.array(j.ravel(), pa.int32()), "s": total.ravel()})

    added = fit.select("y").mapInArrow(sums, "d int, i int, j int, s double").groupBy("d", "i", "j").agg(F.sum("s"))
    total = {d: np.zeros(((m.eigenvalues > 0).sum() + 1,) * 2) for d, m in models.items()}
    for d, i, j, s in added.collect():
        total[d][i, j] = s
    out = {}
    for d, t in total.items():
        mean = t[0, 1:] / models[d].n
        covariance = t[1:, 1:] / models[d].n - np.outer(mean, mean)
        out[d] = float(np.abs(covariance - np.eye(len(covariance))).max(initial=0.0))
    return out


def learn(vectors: DataFrame, components: int = COMPONENTS, vec_id: str = "vec_id", embedding: str = "embedding") -> dict[int, Whitening]:
    """The whitening of each vector length in the table, learned from each distinct integer vector once.

    Copies are combined before the shuffle. Vectors that ``integer_vectors`` leaves out count for nothing; an empty table
    gives no model.
    """
    fit = written(integer_vectors(vectors, vec_id, embedding).select("y").distinct(), "fit-list")
    models = {d: _solve(vectors.sparkSession, found, components) for d, found in moments(fit).items()}
    errors = _covariance_error(fit, models) if models else {}
    return {d: Whitening(m.n, m.sums, m.components, m.eigenvalues, m.explained, errors[d]) for d, m in models.items()}


def whiten(vectors: DataFrame, models: dict[int, Whitening], vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``vec_id``, ``component`` (from 1), ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``: a row for each
    usable row of ``vectors`` and each component.

    Vectors that are null, empty or not finite, or of a length that was not learned, give no row. A component whose eigenvalue is
    zero (all vectors equal, or fewer than dimensions) has null ``whitened``, and null ``explained`` if all are. Repeated rows
    and rows without an id stay; other columns are ignored, whatever their names.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for at, y in by_dimension(batch.column(1)):
                if y.shape[1] not in models:
                    continue
                model = models[y.shape[1]]
                w = model.apply(y)
                k = w.shape[1]
                each = np.repeat(np.arange(len(y)), k)
                deviation = pa.array(model.deviations(y), pa.decimal128(38, 0))
                whitened, shares = w.ravel(), np.tile(model.explained, len(y))
                yield pa.record_batch({
                    "vec_id": ids.take(pa.array(at[each])),
                    "component": pa.array(np.tile(np.arange(1, k + 1), len(y)), pa.int32()),
                    "n": pa.array(np.full(len(each), model.n)),
                    "deviation": deviation.take(pa.array(each)),
                    "whitened": pa.array(whitened, mask=np.isnan(whitened)),
                    "explained": pa.array(shares, mask=np.isnan(shares)),
                    "identity_error": pa.array(np.full(len(each), model.identity_error)),
                })

    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    return integer_vectors(vectors, vec_id, embedding).mapInArrow(rows, schema)
