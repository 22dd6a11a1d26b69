"""Whitening of embeddings, from exact sums to unit-variance principal components.

Entries become whole numbers, ``floor(scale * c) + shift``, so that sums and products can be
added exactly and the result is the same for any partitioning:

1. One pass gives the number of vectors and the sum of each dimension.
2. A second pass multiplies vectors centred at the mean's nearest whole numbers; what the
   rounding left is taken off in whole numbers afterwards. Spark adds the products, the
   driver gets one number per pair of dimensions.
3. The driver factors this centred scatter by Cholesky with diagonal pivots and turns the
   columns of the triangular factor by one-sided Jacobi until they are orthogonal. Their
   squared norms are the scatter's eigenvalues, the columns over their norms its
   eigenvectors; the products of the factor are never formed.
4. Vectors are projected where they lie. Nothing is shuffled but sums.

Vectors that are null, or hold a null, an entry that is not finite, or one of 2**32 or more
(beyond exact sums), are left out of the fit and of the result. So are vectors of another
length than most have (of several such lengths, the longest). Repeated rows and ids, null
ids among them, each count and come back. Fewer components than asked for come back where
the vectors span fewer dimensions; an empty table, or equal vectors only, give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8
LARGEST = 2.0**32
#: Whole numbers below this are exact as doubles, so matrix products of them are too.
EXACT = 2**53
SWEEPS = 60
WHOLE = pa.decimal128(38, 0)


@dataclass(frozen=True)
class Whitening:
    """Fitted map. ``rest`` is what ``n * nearest`` lacks of the sums, whole numbers."""

    n: int
    nearest: np.ndarray
    rest: list[int]
    trace: float
    eigenvalues: np.ndarray
    components: np.ndarray
    scale: int
    shift: int

    @property
    def width(self) -> int:
        return len(self.nearest)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.nearest) - np.array([r / self.n for r in self.rest])

    def project(self, x: np.ndarray, k: int) -> np.ndarray:
        return self.centred(x) @ (self.components[:k] / np.sqrt(self.eigenvalues[:k, None])).T

    def deviations(self, x: np.ndarray) -> list[int]:
        """Per vector, the sum over dimensions of ``(n * x - sum) ** 2``, exact."""
        y = x - self.nearest
        reach = self.n * (int(np.abs(y).max(initial=0)) + 1)
        if reach * reach * self.width < 2**63:
            return ((self.n * y - np.array(self.rest, np.int64)) ** 2).sum(axis=1).tolist()
        y = y.astype(object) * self.n - np.array(self.rest, object)
        return (y * y).sum(axis=1).tolist()


def _whole_vectors(column: pa.Array, scale: int, shift: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per length, the rows whose vectors are usable and their whole-number entries."""
    starts, ends = column.offsets.to_numpy()[:-1], column.offsets.to_numpy()[1:]
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    present = column.is_valid().to_numpy(zero_copy_only=False)
    widths = ends - starts
    for width in np.unique(widths[present]):
        rows = np.flatnonzero(present & (widths == width))
        x = values[starts[rows, None] + np.arange(width)]
        good = (np.abs(x) < LARGEST).all(axis=1)  # false for NaN, which nulls become, and infinity
        yield rows[good], np.floor(scale * x[good]).astype(np.int64) + shift


def _of_width(column: pa.Array, model: Whitening) -> tuple[np.ndarray, np.ndarray]:
    for rows, x in _whole_vectors(column, model.scale, model.shift):
        if x.shape[1] == model.width:
            return rows, x
    return np.zeros(0, np.int64), np.zeros((0, model.width), np.int64)


def _sums(scale: int, shift: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            for _, x in _whole_vectors(batch.column(0), scale, shift):
                if len(x):
                    held = found.setdefault(x.shape[1], [0, np.zeros(x.shape[1], object)])
                    held[0] += len(x)
                    held[1] += x.sum(axis=0).astype(object)
        for width, (n, total) in found.items():
            at = np.arange(-1, width, dtype=np.int32)  # entry -1 holds the number of vectors
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(width + 1, width, np.int32)), pa.array(at), pa.array([n, *total], WHOLE)], ["width", "i", "total"]
            )

    return rows


def _exact_products(y: np.ndarray) -> Iterator[np.ndarray]:
    """Matrices of whole numbers that add up to ``y.T @ y``."""
    most = int(np.abs(y).max(initial=0))
    step = EXACT // (most * most) if most else len(y)
    if step == 0:
        big = y.astype(object)
        yield big.T @ big
        return
    for k in range(0, len(y), step):
        part = y[k : k + step].astype(np.float64)
        yield (part.T @ part).astype(np.int64).astype(object)


def _scatter(nearest: np.ndarray, scale: int, shift: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(nearest)
        total = np.zeros((width, width), object)
        for batch in batches:
            for _, x in _whole_vectors(batch.column(0), scale, shift):
                if x.shape[1] == width:
                    for part in _exact_products(x - nearest):
                        total += part
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(list(total[i, j]), WHOLE)], ["i", "j", "total"]
        )

    return rows


def pivoted_cholesky(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(l, order)`` with ``a[order][:, order] = l @ l.T``; ``l`` is lower triangular with as
    many columns as ``a`` has rank to working precision."""
    d = len(a)
    order, left, l = np.arange(d), a.diagonal().copy(), np.zeros((d, d))
    least = d * np.finfo(float).eps * left.max(initial=0.0)
    for k in range(d):
        p = k + int(np.argmax(left[k:]))
        if left[p] <= least:
            return l[:, :k], order
        for held in (order, left, l):
            held[[k, p]] = held[[p, k]]
        l[k, k] = np.sqrt(left[k])
        l[k + 1 :, k] = (a[order[k + 1 :], order[k]] - l[k + 1 :, :k] @ l[k, :k]) / l[k, k]
        left[k + 1 :] -= l[k + 1 :, k] ** 2
    return l, order


def _rounds(n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rounds of disjoint pairs in which each of ``n`` columns meets each other once."""
    ring = list(range(n)) + [-1] * (n % 2)
    out = []
    for _ in range(len(ring) - 1):
        pairs = [(a, b) for a, b in zip(ring[: len(ring) // 2], ring[::-1], strict=False) if min(a, b) >= 0]
        out.append(tuple(np.array(side, int) for side in zip(*pairs, strict=True)))
        ring = [ring[0], ring[-1], *ring[1:-1]]
    return out


def orthogonal_columns(l: np.ndarray) -> np.ndarray:
    """Columns of ``l``, turned in pairs until all are orthogonal to working precision."""
    g = l.T.copy()
    least = len(g) * np.finfo(float).eps
    rounds = _rounds(len(g)) if len(g) > 1 else []
    for _ in range(SWEEPS):
        worst = 0.0
        for first, second in rounds:
            x, y = g[first], g[second]
            a, b, c = (x * x).sum(axis=1), (y * y).sum(axis=1), (x * y).sum(axis=1)
            cosine = np.abs(c) / np.sqrt(a * b)
            worst = max(worst, float(cosine.max()))
            turn = cosine > least
            zeta = (b - a)[turn] / (2 * c[turn])
            tangent = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            cos = 1 / np.hypot(1.0, tangent)
            sin = cos * tangent
            x, y = x[turn], y[turn]
            g[first[turn]] = cos[:, None] * x - sin[:, None] * y
            g[second[turn]] = sin[:, None] * x + cos[:, None] * y
        if worst <= least:
            break
    return g.T


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues above rounding, falling, and unit eigenvectors as rows."""
    l, order = pivoted_cholesky(a)
    g = orthogonal_columns(l)
    norms = np.sqrt((g * g).sum(axis=0))
    rank = np.argsort(-norms, kind="stable")
    vectors = np.empty((len(rank), len(a)))
    vectors[:, order] = (g[:, rank] / norms[rank]).T
    return norms[rank] ** 2, vectors


def fit(df: DataFrame, vector_col: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> Whitening | None:
    """Whitening map of all usable vectors; None if there are none.

    The driver gets a row per dimension, then one per pair of dimensions.
    """
    vectors = df.select(F.col(vector_col).cast("array<double>").alias("v"))
    sums = vectors.mapInArrow(_sums(scale, shift), "width int, i int, total decimal(38,0)")
    found: dict[int, dict[int, int]] = {}
    for r in sums.groupBy("width", "i").agg(F.sum("total").alias("total")).collect():
        found.setdefault(r["width"], {})[r["i"]] = int(r["total"])
    if not found:
        return None
    width = max(found, key=lambda w: (found[w][-1], w))
    n, totals = found[width][-1], [found[width][i] for i in range(width)]
    nearest = [(2 * t + n) // (2 * n) for t in totals]
    rest = [t - n * m for t, m in zip(totals, nearest, strict=True)]
    centre = np.array(nearest, np.int64)
    products = vectors.mapInArrow(_scatter(centre, scale, shift), "i int, j int, total decimal(38,0)")
    a = np.zeros((width, width))
    trace = 0
    for r in products.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        i, j = r["i"], r["j"]
        exact = n * int(r["total"]) - rest[i] * rest[j]
        a[i, j] = a[j, i] = exact / n
        trace += exact if i == j else 0
    values, components = eigen(a)
    return Whitening(n, centre, rest, trace / n / n, values / n, components, scale, shift)


def whiten(df: DataFrame, model: Whitening, k: int = COMPONENTS, vector_col: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """``(vec_id, whitened, deviation)`` of every usable vector: its first ``k`` whitened
    components, and its exact squared distance from the mean times ``n`` squared."""
    k = min(k, len(model.eigenvalues))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, x = _of_width(batch.column(1), model)
            flat = model.project(x, k)
            ends = np.arange(len(at) + 1, dtype=np.int32) * k
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.ravel())), pa.array(model.deviations(x), WHOLE)],
                ["vec_id", "whitened", "deviation"],
            )

    named = df.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    kind = named.schema["vec_id"].dataType.simpleString()
    return named.mapInArrow(rows, f"vec_id {kind}, whitened array<double>, deviation decimal(38,0)")


def identity_error(df: DataFrame, model: Whitening, k: int = COMPONENTS, vector_col: str = "embedding") -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, measured
    on all of them. The driver gets ``k * (k + 1)`` sums."""
    k = min(k, len(model.eigenvalues))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for batch in batches:
            z = model.project(_of_width(batch.column(0), model)[1], k)
            total[:k] += z.T @ z
            total[k] += z.sum(axis=0)
        at = np.arange(total.size, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel())], ["at", "total"])

    sums = df.select(F.col(vector_col).cast("array<double>").alias("v")).mapInArrow(rows, "at int, total double")
    total = np.zeros((k + 1, k))
    for r in sums.groupBy("at").agg(F.sum("total").alias("total")).collect():
        total[divmod(r["at"], k)] = r["total"]
    mean = total[k] / model.n
    return float(np.abs(total[:k] / model.n - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def whitening_report(df: DataFrame, k: int = COMPONENTS, vector_col: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """A row per vector and component, with the fit's figures. A deviation beyond 64 bits is
    null here; ``whiten`` has it."""
    model = fit(df, vector_col)
    if model is None or not len(model.eigenvalues):
        kind = df.schema[id_col].dataType.simpleString()
        names = f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
        return df.sparkSession.createDataFrame([], names)
    shares = F.array(*[F.lit(float(e / model.trace)) for e in model.eigenvalues[:k]])
    error = identity_error(df, model, k, vector_col)
    rows = whiten(df, model, k, vector_col, id_col)
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("bigint").alias("n"),
        F.expr("try_cast(deviation as bigint)").alias("deviation"),
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
