"""Helpers of the exact vector operators: integer vectors, packed blocks and a
bounded sample to fit rotations and codebooks on."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Every integer below is a double; sums of products stay exact up to here.
EXACT = float(2 ** 53)
#: Stands for a null id inside a packed block; sorts last.
NO_ID = np.iinfo(np.int64).max


def whole(vec: Column, scale: int) -> Column:
    """floor(scale * x) of every component, as doubles; null if the vector is
    null or holds a null or non-finite component."""
    x = vec.cast("array<double>")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return F.when(vec.isNotNull() & ~bad,
                  F.transform(x, lambda v: F.floor(v * F.lit(float(scale))).cast("double")))


def padded(vec: Column, dim: int) -> Column:
    """Vectors of one length: missing components count as 0."""
    return F.concat(vec, F.array_repeat(F.lit(0.0), F.lit(dim) - F.size(vec)))


def sample(rows: DataFrame, key: str, n: int, dim: int, limit: int = 20_000,
           cells: int = 1 << 22) -> np.ndarray:
    """About ``limit`` vectors at most (``cells`` numbers at most), chosen by a
    hash of ``key``: rotations and codebooks are fitted on them, nothing else."""
    limit = max(1, min(limit, cells // max(dim, 1)))
    if n > limit:
        share = max(1, int(limit / n * 2 ** 32))
        rows = rows.where(F.pmod(F.xxhash64(F.lit(3), key), F.lit(2 ** 32)) < F.lit(share))
    got = rows.select("vec").toArrow()["vec"].combine_chunks()
    return np.asarray(got.flatten(), dtype=np.float64).reshape(-1, dim)


def matrix(column, dim: int) -> np.ndarray:
    """A list<double> Arrow column as a matrix."""
    c = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    return np.asarray(c.flatten(), dtype=np.float64).reshape(-1, dim)


def ids_of(column) -> np.ndarray:
    c = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    return c.fill_null(int(NO_ID)).to_numpy(zero_copy_only=False).astype(np.int64)


def floats(blob, dim: int) -> np.ndarray:
    return np.frombuffer(blob, dtype=np.float64).reshape(-1, dim)


def longs(blob) -> np.ndarray:
    return np.frombuffer(blob, dtype=np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows: as doubles while every sum stays
    below 2^53, else by Python integers (kept inside the range of a long)."""
    most = np.linalg.norm(a, axis=1).max(initial=0.0) * np.linalg.norm(b, axis=1).max(initial=0.0)
    if most < EXACT / 2:
        return a @ b.T
    x, y = ([[int(v) for v in r] for r in m] for m in (a, b))
    edge = 2 ** 63 - 1
    return np.array([[max(-edge, min(edge, sum(p * q for p, q in zip(r, c)))) for c in y] for r in x],
                    dtype=np.int64).reshape(len(a), len(b))


def best(owner: np.ndarray, score: np.ndarray, ids: np.ndarray, rid: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of every owner, higher scores first, then smaller ids."""
    order = np.lexsort((rid, ids, -score, owner))
    o = owner[order]
    start = np.flatnonzero(np.r_[True, o[1:] != o[:-1]]) if len(o) else np.zeros(0, np.int64)
    rank = np.arange(len(o)) - np.repeat(start, np.diff(np.r_[start, len(o)]))
    return order[rank < k]
