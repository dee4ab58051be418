"""Whitening of embeddings by spectrum slicing.

Entries are put on an integer grid, so sums, products and the covariance of the distinct vectors are exact whatever the
order in which tasks are added. The leading eigenvalues of that small matrix are found one by one: the inertia of a
shifted LDL' factorisation counts the eigenvalues above the shift (Sylvester), halving by counts isolates the k-th one,
Rayleigh quotient iteration converges to it cubically, and two more counts beside the result certify its number.
"""

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockflow.llm.common import importable, stored, unused

GRID, OFFSET = 64, 1_000_000
EPS = np.finfo(float).eps
PIVOT = (1 + 17**0.5) / 8  # Bunch and Kaufman's bound between pivots of size one and two
EXACT, LONGEST = 2**53, 2**63
WIDEST = 2.0**40  # entries up to here have a place on the grid whose products fit a decimal of 38 digits


def inertia(matrix: np.ndarray) -> tuple[int, int, int]:
    """(negative, zero, positive) eigenvalues of a symmetric matrix, by LDL' with pivots of size one and two."""
    a, n = np.array(matrix, dtype=float), len(matrix)
    counts = [0, 0, 0]
    k = 0
    while k < n:
        size, corner = 1, abs(a[k, k])
        if k + 1 < n:
            far = k + 1 + int(np.argmax(np.abs(a[k + 1 :, k])))
            beside = abs(a[far, k])
            if corner < PIVOT * beside:
                row = np.abs(a[far, k:])
                row[far - k] = 0
                widest = row.max()
                if corner * widest < PIVOT * beside * beside:
                    swap = k
                    if abs(a[far, far]) < PIVOT * widest:
                        size, swap = 2, k + 1
                    a[[swap, far], :] = a[[far, swap], :]
                    a[:, [swap, far]] = a[:, [far, swap]]
        if size == 1:
            d = a[k, k]
            counts[int(np.sign(d)) + 1] += 1
            if d:
                column = a[k + 1 :, k].copy()
                a[k + 1 :, k + 1 :] -= np.outer(column, column / d)
        else:  # such a pivot has a negative determinant: one eigenvalue of each sign
            counts[0] += 1
            counts[2] += 1
            block, columns = a[k : k + 2, k : k + 2], a[k + 2 :, k : k + 2].copy()
            a[k + 2 :, k + 2 :] -= columns @ np.linalg.solve(block, columns.T)
        k += size
    return counts[0], counts[1], counts[2]


def _above(matrix: np.ndarray, shift: float) -> int:
    return inertia(matrix - shift * np.eye(len(matrix)))[2]


def _refined(matrix: np.ndarray, vector: np.ndarray, known: np.ndarray, steps: int = 12) -> tuple[float, np.ndarray, float]:
    """Rayleigh quotient iteration beside the known eigenvectors: value, unit vector, residual."""
    size = np.abs(matrix).sum(1).max()
    best = (0.0, vector, np.inf)
    for _ in range(steps):
        value = vector @ matrix @ vector
        gap = matrix @ vector - value * vector
        residual = float(np.linalg.norm(gap - known.T @ (known @ gap)))
        if residual < best[2]:
            best = (float(value), vector, residual)
        elif residual <= 64 * EPS * size:
            break
        try:
            after = np.linalg.solve(matrix - value * np.eye(len(matrix)), vector)
        except np.linalg.LinAlgError:
            break  # the quotient is an eigenvalue
        if not np.isfinite(after).all():
            break
        vector = _beside(after, known)
    return best


def _beside(vector: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The unit vector of what is orthogonal to the known ones."""
    for _ in range(2):
        vector = vector / np.linalg.norm(vector)
        vector = vector - known.T @ (known @ vector)
    return vector / np.linalg.norm(vector)


def leading_eigenpairs(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest positive eigenvalues (at most ``most``), falling, and their unit eigenvectors as rows.

    Eigenvalues that counts can't separate at double precision share an interval; their vectors are an orthonormal
    basis of the common space. Eigenvalues within rounding of zero are left out. A result whose number the counts don't
    confirm raises ArithmeticError.
    """
    n = len(matrix)
    size = float(np.abs(matrix).sum(1).max()) if n else 0.0
    rounding = 8 * n * EPS * size
    if not size or not (wanted := min(most, _above(matrix, rounding))):
        return np.zeros(0), np.zeros((0, n))
    bounds = {rounding: _above(matrix, rounding), size * (1 + 4 * EPS): 0}  # shift: eigenvalues above it
    values, vectors = [], np.zeros((0, n))
    for k in range(1, wanted + 1):
        while True:
            low = max(s for s, above in bounds.items() if above >= k)
            high = min(s for s, above in bounds.items() if above < k)
            middle = (low + high) / 2
            alone = bounds[low] == k and bounds[high] == k - 1
            if alone or high - low <= rounding:
                start = _beside(np.cos(np.arange(1, n + 1) * (k + 0.5)), vectors)
                shifted = matrix - (middle + rounding / 64) * np.eye(n)
                for _ in range(3):  # inverse iteration at the middle leads into the interval
                    start = _beside(np.linalg.solve(shifted, start), vectors)
                value, vector, residual = _refined(matrix, start, vectors)
                slack = rounding if high - low <= rounding else 0
                if low - slack <= value <= high + slack and residual <= 1e3 * rounding:
                    break
                if slack:
                    raise ArithmeticError(f"eigenvalue {k} did not converge")
            bounds[middle] = _above(matrix, middle)
        slack = max(residual, rounding)
        bounds[value + slack], bounds[value - slack] = _above(matrix, value + slack), _above(matrix, value - slack)
        if not bounds[value + slack] < k <= bounds[value - slack]:
            raise ArithmeticError(f"eigenvalue {value} is not number {k}")
        values.append(value)
        vectors = np.vstack([vectors, vector])
    order = np.argsort(values, kind="stable")[::-1]  # within a cluster they may come in any order
    values, vectors = np.array(values)[order], vectors[order]
    signs = np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(1)])
    return values, vectors * signs[:, None]


@dataclass(frozen=True)
class Whitening:
    """The fitted transform: n distinct vectors with sums S, components as rows with their eigenvalues."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n*x - S, exact (as Python integers where a long is too short), and the same over n as doubles."""
        wide = self.n * max(abs(int(x.min())), abs(int(x.max())), 1) >= LONGEST // 4
        kind = object if wide else np.int64
        z = self.n * x.astype(kind) - np.array(self.sums, dtype=kind)
        return z, (z / self.n).astype(float)

    def apply(self, x: np.ndarray) -> np.ndarray:
        """One row at a time in a fixed order (a matrix product would round by the size of the batch)."""
        return np.einsum("ij,kj->ik", self.centred(x)[1], self.vectors / np.sqrt(self.values)[:, None])


def grid(vector: Column) -> Column:
    """floor(64 c) + 1,000,000 of every entry; null for a vector that is null or holds null or non-finite entries.

    Also null where an entry is beyond 2^40, whose products could not be summed exactly.
    """
    entries = vector.cast("array<double>")
    fine = F.forall(entries, lambda c: c.isNotNull() & (F.abs(c) < WIDEST) & ~F.isnan(c))
    points = F.transform(entries, lambda c: F.floor(c * GRID).cast("bigint") + OFFSET)
    return F.when(vector.isNotNull() & fine & (F.size(vector) > 0), points)


def _rows(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _products(batches: Iterator[pa.RecordBatch], shift: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sums of products of the centred entries of a task's vectors, exact: one row per pair of dimensions."""
    d = len(shift)
    total = np.zeros((d, d), dtype=object)
    for batch in batches:
        for k in range(0, batch.num_rows, 4096):
            y = _rows(batch.column(0).slice(k, 4096)) - shift
            if int(np.abs(y).max(initial=0)) ** 2 * len(y) < EXACT:  # products of doubles are exact up to here
                y = y.astype(float)
                total += (y.T @ y).astype(np.int64)
            else:
                y = y.astype(object)
                total += y.T @ y
    i, j = np.triu_indices(d)
    if total.any():
        sums = pa.array([Decimal(int(v)) for v in total[i, j]], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), sums], ["i", "j", "g"])


def fit(points: DataFrame, components: int = 16) -> Whitening | None:
    """Fit on distinct vectors, a table of one column ``x``; None for an empty table.

    What reaches the driver is bounded by the square of the dimension.
    """
    dims = points.select(F.posexplode("x").alias("at", "v")).groupBy("at")
    sums = dims.agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n")).orderBy("at").collect()
    if not sums:
        return None
    n, s = sums[0]["n"], [int(r["s"]) for r in sums]
    shift = np.array([v // n for v in s], dtype=np.int64)
    pairs = points.mapInArrow(lambda batches: _products(batches, shift), "i int, j int, g decimal(38,0)")
    d = len(s)
    matrix = np.zeros((d, d))
    rest = [v - n * int(c) for v, c in zip(s, shift, strict=True)]
    for r in pairs.groupBy("i", "j").agg(F.sum("g").alias("g")).collect():
        i, j = r["i"], r["j"]
        matrix[i, j] = matrix[j, i] = (n * int(r["g"]) - rest[i] * rest[j]) / (n * n)  # whole numbers until here
    values, vectors = leading_eigenpairs(matrix, components)
    return Whitening(n, s, values, vectors, float(np.trace(matrix)))


def identity_error(points: DataFrame, fitted: Whitening) -> float:
    """Largest entry of the whitened vectors' covariance minus the identity, over the same distinct vectors."""
    k = len(fitted.values)

    def moments(batches: Iterator[pa.RecordBatch], mean: np.ndarray, order: int) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k if order == 1 else k * k)
        for batch in batches:
            if not batch.num_rows:
                continue
            w = fitted.apply(_rows(batch.column(0))) - mean
            total += w.sum(0) if order == 1 else (w.T @ w).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], ["at", "v"])

    def summed(mean: np.ndarray, order: int) -> np.ndarray:
        parts = points.mapInArrow(lambda b: moments(b, mean, order), "at int, v double")
        return np.array([r["v"] for r in parts.groupBy("at").agg(F.sum("v").alias("v")).orderBy("at").collect()])

    mean = summed(np.zeros(k), 1) / fitted.n
    covariance = summed(mean, 2).reshape(k, k) / fitted.n
    return float(np.abs(covariance - np.eye(k)).max())


OUTPUT = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)


def whitened(embeddings: DataFrame, components: int = 16) -> DataFrame:
    """Every usable vector of (vec_id, embedding) on its leading whitened components, one row each.

    Not usable, so dropped: null vectors, vectors with null or non-finite entries or with entries beyond 2^40, empty
    ones, and, where lengths differ, those of another length than the most frequent (ties: the longest). Repeated rows
    stay, and count once in the fit. A null vec_id stays null. Components without variance are left out: one distinct
    vector or none gives no row. ``deviation`` is null where it is beyond a long. Extra columns are ignored.
    """
    spark = embeddings.sparkSession
    importable(spark)
    (x,) = unused(embeddings, "x")
    found = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), grid(embeddings["embedding"]).alias(x))
    found = found.where(F.col(x).isNotNull()).withColumnRenamed(x, "x")
    lengths = found.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return spark.createDataFrame([], OUTPUT)
    found = found.where(F.size("x") == lengths["d"])
    points = stored(found.select("x").distinct(), "points")
    fitted = fit(points, components)
    if not len(fitted.values):
        return spark.createDataFrame([], OUTPUT)
    error = identity_error(points, fitted)
    return found.mapInArrow(lambda batches: _projected(batches, fitted, error), OUTPUT)


def _projected(batches: Iterator[pa.RecordBatch], fitted: Whitening, error: float) -> Iterator[pa.RecordBatch]:
    k = len(fitted.values)
    explained = fitted.values / fitted.trace
    names = [c.split()[0] for c in OUTPUT.split(", ")]
    for batch in batches:
        if not (m := batch.num_rows):
            continue
        z, _ = fitted.centred(x := _rows(batch.column(1)))
        if z.dtype != object and z.size and z.shape[1] * int(np.abs(z).max()) ** 2 >= LONGEST:
            z = z.astype(object)
        squares = [int(v) if v < LONGEST else None for v in (z * z).sum(1)]
        deviation = pa.array(squares, pa.int64())
        each = pa.array(np.repeat(np.arange(m), k))
        arrays = [
            batch.column(0).take(each),
            pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
            pa.array(np.full(m * k, fitted.n), pa.int64()),
            deviation.take(each),
            pa.array(fitted.apply(x).ravel()),
            pa.array(np.tile(explained, m)),
            pa.array(np.full(m * k, error)),
        ]
        yield pa.RecordBatch.from_arrays(arrays, names)
