"""What the vector operators share: which vectors take part."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(v: Column) -> Column:
    """Not null, not zero, and without null or non-finite components."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return v.isNotNull() & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0)


def digests(v: Column) -> list[Column]:
    """``h1, h2``: 128 bits that tell equal vectors."""
    return [F.xxhash64(F.lit(1), v).alias("h1"), F.xxhash64(F.lit(2), v).alias("h2")]


def sizes_of(vectors: DataFrame, col: str = "d") -> list[int]:
    """The numbers of components that occur, one row each, the commonest first."""
    return [r[col] for r in vectors.groupBy(col).count().orderBy(F.desc("count"), col).collect()]


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, summed component by component, so that equal rows give equal sums."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        out += a[:, j].astype(np.float64) * b[:, j].astype(np.float64)
    return out
