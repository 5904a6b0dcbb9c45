"""Integer vectors for the vector searches: which rows take part, and inner
products that are exact whatever the size of the components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 256
#: Integers below this are exact as doubles, and so are sums of them.
EXACT = float(1 << 53)


def finite(vector: str) -> Column:
    """Whether the vector is there and every component is a finite number."""
    return F.col(vector).isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))


def integers(column: pa.ChunkedArray | pa.Array, rows: int, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of a column of lists of equal length, as doubles: a
    double holds each of these integers exactly."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)
    return np.floor(values * scale)


def norms(vectors: np.ndarray) -> np.ndarray:
    """Lengths, without overflow where components are large."""
    if vectors.size == 0:
        return np.zeros(len(vectors))
    top = np.abs(vectors).max(axis=1)
    safe = np.where(top > 0, top, 1.0)
    return safe * np.sqrt(((vectors / safe[:, None]) ** 2).sum(axis=1)) * (top > 0)


def inner(vectors: np.ndarray, sizes: np.ndarray, query: np.ndarray, query_size: float) -> np.ndarray:
    """Exact inner products of integer ``vectors`` (rows, as doubles, of
    lengths ``sizes``) with ``query``: doubles where no partial sum can pass
    2^53, else Python integers for those rows and an array of objects."""
    plain = vectors @ query if vectors.size else np.zeros(len(vectors))
    large = np.flatnonzero(sizes * query_size * (1 + 1e-9) >= EXACT)
    if not large.size:
        return plain
    exact = plain.astype(object)
    weights = [int(x) for x in query.tolist()]
    for i in range(len(vectors)):
        exact[i] = int(plain[i]) if sizes[i] * query_size * (1 + 1e-9) < EXACT else sum(int(x) * w for x, w in zip(vectors[i].tolist(), weights))
    return exact


def as_long(score: object) -> int:
    """A score as an integer that fits in a long; raises if it doesn't."""
    out = int(score)
    if not -(1 << 63) <= out < 1 << 63:
        raise OverflowError(f"a score of {out} does not fit in a long")
    return out


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The first k (id, score): larger scores first, then smaller ids."""
    if scores.dtype == object:
        order = sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k]
    else:
        if scores.size > k:
            some = np.flatnonzero(scores >= kth_largest(scores, k))
            scores, ids = scores[some], ids[some]
        order = np.lexsort((ids, -scores))[:k]
    return [(int(ids[i]), as_long(scores[i])) for i in order]


def kth_largest(values: np.ndarray, k: int) -> float:
    """The k-th largest value; minus infinity if there are fewer."""
    if values.size < k:
        return -np.inf
    if values.dtype == object:
        return sorted(values, reverse=True)[k - 1]
    return float(np.partition(values, values.size - k)[values.size - k])


def reference_directions(rows: DataFrame, n: int, scale: int, dims: int = 16) -> dict[int, np.ndarray]:
    """Unit vectors of the ``n`` rows with the smallest hashes, for each of
    the ``dims`` most frequent dimensions; others have none."""
    most = [r["dim"] for r in rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(dims).collect()]
    out = {}
    for d in most:
        picked = rows.where(F.size("v") == d).orderBy(F.xxhash64("id", "v"), "id").limit(n).select("v").collect()
        vectors = np.floor(np.array([r["v"] for r in picked], np.float64).reshape(len(picked), d) * scale)
        lengths = norms(vectors)
        out[d] = vectors[lengths > 0] / lengths[lengths > 0][:, None]
    return out
