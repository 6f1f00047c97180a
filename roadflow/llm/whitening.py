"""Whitening of embeddings by covariances from polarisation: variances of sums give covariances.

Entries become whole numbers, x = floor(64 * c) + 1000000. One pass sums them; with the sums, x is centred at a whole number
next to its mean, y = x - floor(S / n). A second pass adds up y^2 of every dimension and (y_i + y_j)^2 of every pair of
dimensions, as whole numbers: n * sum(y^2) - sum(y)^2 is then exactly n^2 times the variance of a dimension or of a
sum of two, and half of what the variance of a sum exceeds those of its parts by is their covariance, without any
rounding. Tasks send one row for each pair (d * (d + 1) / 2 of them, whatever the number of vectors), Spark adds them up,
and only the d x d matrix comes to the driver, for its eigenvectors.

Vectors that are null, empty or hold null or non-finite entries take no part; zero vectors do. Vectors of a length other
than the most frequent one (ties: the shorter) take no part either. Entries beyond LARGEST in size count as LARGEST. A
deviation that doesn't fit a long is null. Where the fit list has no spread along a component (all vectors equal, fewer
vectors than dimensions), ``whitened`` is null there, and identity_error leaves it out. Repeated ids and null ids are rows
like others; an empty table gives an empty one. Other columns don't matter, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import sizes_of

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 32
#: Entries are cut to this size, so that x stays exact in double precision.
LARGEST = float(1 << 46)
#: Vectors that are taken at once; eigenvalues below this share of the largest are no spread.
ROWS, LEAST = 4096, 1e-12
OUT = "component int, n long, deviation long, whitened double, explained double"


def fit_list(vectors: DataFrame, vec: str = "embedding") -> DataFrame:
    """``vectors`` less those that take no part (but for their length), with it in ``d``; the entries are doubles."""
    v = F.col(f"`{vec}`")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where(v.isNotNull() & (F.size(v) > 0) & ~bad).withColumns({"v": v.cast("array<double>"), "d": F.size(v)})


def _whole(batch: pa.RecordBatch, d: int) -> Iterator[tuple[int, np.ndarray]]:
    """The x of a batch, ROWS vectors at a time, with the place of the first."""
    flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
    for i in range(0, len(flat), ROWS):
        yield i, np.floor(SCALE * np.clip(flat[i : i + ROWS], -LARGEST, LARGEST)).astype(np.int64) + SHIFT


def _safe_sum(values: np.ndarray) -> list[int]:
    """Sums of the columns' squares as exact whole numbers."""
    most = int(np.abs(values).max(initial=0))
    if most * most * len(values) < 1 << 62:
        return np.einsum("ij,ij->j", values, values).tolist()
    return [sum(int(x) * int(x) for x in column) for column in values.T]


def _added(totals: list[tuple[int, int, int]]) -> pa.RecordBatch:
    i, j, total = zip(*totals, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([str(t) for t in total])], names=["i", "j", "total"])


def sums(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of vectors and the sum of each dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for batch in batches:
            for _, x in _whole(batch, d):
                n += len(x)
                total = [a + b for a, b in zip(total, x.sum(0).tolist(), strict=True)]
        yield _added([(i, 0, t) for i, t in enumerate(total)] + [(-1, 0, n)])

    rows = fit.select("v").mapInArrow(add, "i int, j int, total string").groupBy("i").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("t")).collect()
    found = {r["i"]: int(r["t"]) for r in rows}  # d + 1 rows
    return found.get(-1, 0), [found.get(i, 0) for i in range(d)]


def covariance(fit: DataFrame, d: int, n: int, total: list[int]) -> list[list[int]]:
    """n^2 times the covariance matrix, exactly."""
    centre = np.array([t // n for t in total], np.int64)
    rest = [t % n for t in total]  # the sums of y
    first, second = np.triu_indices(d, 1)

    def square(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        single, double = [0] * d, [0] * len(first)
        for batch in batches:
            for _, x in _whole(batch, d):
                y = x - centre
                single = [a + b for a, b in zip(single, _safe_sum(y), strict=True)]
                for k in range(0, len(y), 256):  # all pairs of few vectors at a time
                    part = y[k : k + 256]
                    double = [a + b for a, b in zip(double, _safe_sum(part[:, first] + part[:, second]), strict=True)]
        yield _added([(i, i, s) for i, s in enumerate(single)] + [(int(i), int(j), s) for i, j, s in zip(first, second, double, strict=True)])

    rows = fit.select("v").mapInArrow(square, "i int, j int, total string").groupBy("i", "j").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("t"))
    square_of = {(r["i"], r["j"]): int(r["t"]) for r in rows.collect()}  # d * (d + 1) / 2 rows
    spread = {(i, j): n * t - (rest[i] if i == j else rest[i] + rest[j]) ** 2 for (i, j), t in square_of.items()}
    out = [[0] * d for _ in range(d)]
    for (i, j), s in spread.items():
        out[i][j] = out[j][i] = s if i == j else (s - spread[i, i] - spread[j, j]) // 2
    return out


def axes(matrix: list[list[int]], n: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues from the largest down, unit eigenvectors as columns (the largest entry positive), and the trace."""
    v = np.array([[s / n**2 for s in row] for row in matrix])
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    u = u * np.where(np.take_along_axis(u, np.abs(u).argmax(0)[None], 0)[0] < 0, -1.0, 1.0)
    return np.maximum(e, 0.0), u, sum(row[i] for i, row in enumerate(matrix)) / n**2


class Projection:
    """The centred x of vectors, and what they are on the first components over the roots of the eigenvalues."""

    def __init__(self, n: int, total: list[int], e: np.ndarray, u: np.ndarray, most: int):
        self.n, self.centre, self.rest = n, np.array([t // n for t in total], np.int64), np.array([t % n for t in total], np.int64)
        self.k = min(most, len(total))
        self.flat = e[: self.k] <= LEAST * max(float(e[0]), 0.0)
        self.u = u[:, : self.k] / np.sqrt(np.where(self.flat, 1.0, e[: self.k]))

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.centre) - self.rest / self.n) @ self.u

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n * x - S)^2, exactly; None where one doesn't fit a long."""
        y = x - self.centre
        most = int(np.abs(y).max(initial=0)) + 1
        if (most * self.n) ** 2 * x.shape[1] < 1 << 63:
            z = self.n * y - self.rest
            return np.einsum("ij,ij->i", z, z).tolist()
        every = [sum((self.n * int(a) - int(r)) ** 2 for a, r in zip(row, self.rest, strict=True)) for row in y]
        return [s if s < 1 << 63 else None for s in every]


def identity_error(fit: DataFrame, d: int, p: Projection) -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity."""
    k = p.k

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, outer = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for _, x in _whole(batch, d):
                w = p.whitened(x)
                mean, outer = mean + w.sum(0), outer + w.T @ w
        i, j = np.meshgrid(np.arange(k), np.arange(-1, k), indexing="ij")
        values = np.concatenate([mean[:, None], outer], 1)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel().astype(np.int32)), pa.array(j.ravel().astype(np.int32)), pa.array(values.ravel())], names=["i", "j", "value"])

    rows = fit.select("v").mapInArrow(products, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value")).collect()  # k * (k + 1) rows
    found = {(r["i"], r["j"]): r["value"] / p.n for r in rows}
    used = [i for i in range(k) if not p.flat[i]]
    # The whitened vectors are centred already; what rounding leaves of their mean is taken off.
    return max((abs(found[i, j] - found[i, -1] * found[j, -1] - (i == j)) for i in used for j in used), default=0.0)


def whiten(vectors: DataFrame, ident: str = "vec_id", vec: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """A row for each vector that takes part and each of the first ``most`` components: ``ident, component`` (from 1),
    ``n, deviation, whitened, explained, identity_error``."""
    kind = vectors.select(F.col(f"`{ident}`")).schema[0].dataType.simpleString()
    fit = fit_list(vectors.select(F.col(f"`{ident}`").alias("ident"), F.col(f"`{vec}`").alias("vec")), "vec")
    sizes = sizes_of(fit)
    if not sizes:
        return vectors.sparkSession.createDataFrame([], f"`{ident}` {kind}, {OUT}, identity_error double")
    d = sizes[0]
    fit = fit.where(F.col("d") == d).select("ident", "v")
    n, total = sums(fit, d)
    e, u, trace = axes(covariance(fit, d, n, total), n)
    p = Projection(n, total, e, u, most)
    error = identity_error(fit, d, p)
    explained = [float(x / trace) if trace > 0 else 0.0 for x in e[: p.k]]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in _whole(batch, d):
                w, k = p.whitened(x), p.k
                w = np.where(p.flat, np.nan, w)
                place = np.repeat(np.arange(at, at + len(x)), k)
                deviation = pa.array(p.deviation(x), pa.int64())
                columns = [
                    batch.column("ident").take(pa.array(place)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(len(place), n)),
                    deviation.take(pa.array(place - at)), pa.array(w.ravel(), from_pandas=True), pa.array(np.tile(explained, len(x))),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["ident", "component", "n", "deviation", "whitened", "explained"])

    made = fit.mapInArrow(rows, f"ident {kind}, {OUT}")
    return made.withColumnRenamed("ident", ident).withColumn("identity_error", F.lit(error))
