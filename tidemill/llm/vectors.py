"""What the vector operators share: valid vectors, k-means, blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def valid(column: str = "embedding") -> Column:
    """Neither null, empty nor zero, and all components finite numbers."""
    c = F.col(column)
    odd = F.exists(c, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(c.isNotNull() & (F.size(c) > 0) & ~odd & F.exists(c, lambda x: x != 0), F.lit(False))


def stack(column) -> np.ndarray:
    """A pandas column of arrays as rows of doubles."""
    return np.stack([np.asarray(v, dtype=np.float64) for v in column])


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def sample(rows: DataFrame, n: int, key: str, column: str = "embedding") -> np.ndarray:
    """At most ``n`` vectors of the most common length, by a hash of ``key``, as rows
    of doubles."""
    got = rows.select(F.xxhash64(key).alias("h"), key, column).orderBy("h", key, column).limit(n).select(column).toArrow()
    lists = got.column(0).combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy()) if len(lists) else np.empty(0, np.int64)
    if not len(lengths):
        return np.empty((0, 0))
    values, counts = np.unique(lengths, return_counts=True)
    common = int(values[len(counts) - 1 - counts[::-1].argmax()])
    flat = lists.filter(pa.array(lengths == common)).flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, common)


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of rows."""
    return np.maximum((x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * x @ y.T, 0)


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """Lloyd's algorithm from distinct rows; an empty centre keeps its place."""
    x = np.asarray(x, dtype=np.float64)
    distinct = np.unique(x, axis=0)
    k = min(k, len(distinct))
    centres = distinct[np.random.default_rng(seed).choice(len(distinct), k, replace=False)]
    for _ in range(rounds):
        nearest = squared(x, centres).argmin(axis=1)
        for c in range(k):
            if (mine := nearest == c).any():
                centres[c] = x[mine].mean(axis=0)
    return centres


def kmeans_two_level(x: np.ndarray, k: int) -> np.ndarray:
    """About ``k`` centres: those of some sqrt(k) parts, each cut again by its share
    of the rows."""
    if k <= 64 or len(x) <= k:
        return kmeans(x, k)
    top = kmeans(x, int(np.sqrt(k)))
    part = squared(x, top).argmin(axis=1)
    shares = [(x[part == c], max(1, round(k * float((part == c).mean())))) for c in range(len(top))]
    return np.concatenate([kmeans(mine, n) for mine, n in shares if len(mine)])
