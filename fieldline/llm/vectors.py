"""Helpers for operators on embedding vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_doubles(column: str) -> Column:
    """The vector as doubles, or null if it takes no part: null, zero, or with null or non-finite components."""
    v = F.col(column).cast("array<double>")
    big = F.lit(float("inf"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == big))
    return F.when(~F.coalesce(bad, F.lit(True)) & F.exists(v, lambda x: x != 0), v)


def common_size(vectors: DataFrame, column: str) -> int:
    """The most frequent vector length (the smaller on a tie); 0 for an empty table."""
    sizes = vectors.where(F.col(column).isNotNull()).groupBy(F.size(column).alias("n")).count()
    top = sizes.orderBy(F.desc("count"), "n").first()
    return top.n if top else 0


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """Rows of a list column of equal lengths as a (rows, size) array."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaled by the largest component first, so that squares neither vanish nor overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 0) -> np.ndarray:
    """Centres of k clusters of the rows of x (Lloyd's rounds from distinct random rows); fewer if x has fewer rows."""
    x = np.unique(x, axis=0)
    rng = np.random.default_rng(seed)
    centres = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds if len(centres) > 1 else 0):
        own = nearest(x, centres, 1)[:, 0]
        total = np.zeros_like(centres)
        np.add.at(total, own, x)
        count = np.bincount(own, minlength=len(centres))
        centres[count > 0] = total[count > 0] / count[count > 0, None]
    return centres


def nearest(x: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """The n nearest centres of each row, nearest first."""
    n = min(n, len(centres))
    half = (centres ** 2).sum(axis=1) / 2
    out = np.empty((len(x), n), np.int64)
    for low in range(0, len(x), 4096):
        d = half - x[low:low + 4096] @ centres.T
        top = np.argpartition(d, n - 1, axis=1)[:, :n] if n < d.shape[1] else np.tile(np.arange(n), (len(d), 1))
        order = np.argsort(np.take_along_axis(d, top, 1), axis=1, kind="stable")
        out[low:low + 4096] = np.take_along_axis(top, order, 1)
    return out


def sample_rows(vectors: DataFrame, key: str, column: str, n: int) -> np.ndarray:
    """At most n rows (those of the smallest hashed keys) as a matrix on the driver."""
    rows = vectors.orderBy(F.xxhash64(key, F.lit(3)), key).limit(n).select(column).collect()
    return np.array([r[0] for r in rows], float)
