"""Exact top-k inner products by Fagin's threshold algorithm.

Vectors are dealt into blocks of bounded size: by the reference direction they
are nearest to, then by a hash of their key, so that vectors of one block are
alike where the data have clusters.  Inside a block each dimension has its list
of the block's vectors sorted by value.  A query reads all its lists in step,
from the top where its weight is positive and from the bottom where it is
negative; each vector that turns up is scored in full, and the values last read
bound the score of every vector not yet seen.  Reading stops when that bound is
below the k-th best score.

The heads of a block's lists bound the scores of the whole block in the same
way.  A query searches the block with the best bound first; then only blocks
whose bound reaches its k-th score so far.  Blocks meet chunks of queries, so no
task holds more than one block and one chunk.  What they find is merged per
query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.vectors import SCALE, best, finite, inner, integers, kth_largest, norms, reference_directions
from basketry.session import materialize

K = 5
#: Vectors, and queries, that one group holds.
BLOCK_ROWS = 8192
QUERY_ROWS = 1024
#: Entries read from each list before the bound is first tested; doubled each time.
FIRST_DEPTH = 64
#: Reference directions that vectors are dealt by.
CELLS = 16
#: Blocks whose bounds are made at once.
_HEADS = 1024
#: More than the relative error of a bound's sum of doubles.
_ERROR = 1e-12


class SortedLists:
    """The per-dimension lists of a block of integer vectors (doubles)."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray):
        self.vectors = np.asarray(vectors, np.float64)
        self.sizes = norms(self.vectors)
        self.ids = ids
        self.ascending = np.ascontiguousarray(np.argsort(self.vectors, axis=0, kind="stable").T.astype(np.int32))
        self.values = np.take_along_axis(np.ascontiguousarray(self.vectors.T), self.ascending, axis=1)

    def search(self, query: np.ndarray, own: int, k: int = K, first_depth: int = FIRST_DEPTH) -> tuple[list[tuple[int, int]], int]:
        """The k best (score, id), larger score first, then smaller id, without
        rows of id ``own``; and how deep the lists were read."""
        n = self.ids.size
        query = np.asarray(query, np.float64)
        size = float(norms(query[None, :])[0])
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        seen = np.zeros(n, bool)
        scored = self.ids == own
        score_of, id_of = np.empty(0), np.empty(0, np.int64)
        read, depth = 0, first_depth
        while True:
            depth = min(depth, n)
            seen[self.ascending[up, n - depth : n - read]] = True
            seen[self.ascending[down, read:depth]] = True
            if not up.size and not down.size:  # every score is 0
                depth, seen[:] = n, True
            new = np.flatnonzero(seen & ~scored)
            scored[new] = True
            score_of = np.concatenate((score_of, inner(self.vectors[new], self.sizes[new], query, size)))
            id_of = np.concatenate((id_of, self.ids[new]))
            least = kth_largest(score_of, k)
            if score_of.size > k:
                kept = np.flatnonzero(score_of >= least)
                score_of, id_of = score_of[kept], id_of[kept]
            if depth == n:
                break
            if score_of.size >= k:
                last = np.concatenate((self.values[up, n - depth] * query[up], self.values[down, depth - 1] * query[down]))
                if last.sum() + _ERROR * np.abs(last).sum() < least:
                    break
            read, depth = depth, depth * 2
        return [(s, i) for i, s in best(score_of, id_of, k)], depth


def block_bounds(queries: np.ndarray, top: np.ndarray, bottom: np.ndarray) -> np.ndarray:
    """A bound, safe against rounding, of the scores of each query (rows) in
    each block (columns) with the greatest and least values ``top`` and
    ``bottom`` of each dimension."""
    bound = np.maximum(queries, 0) @ top.T + np.minimum(queries, 0) @ bottom.T
    return bound + _ERROR * (np.abs(queries) @ np.maximum(np.abs(top), np.abs(bottom)).T)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    scale: int = SCALE,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
    cells: int = CELLS,
) -> DataFrame:
    """(query_id long, rank int from 1, key long, score long) of the rows for
    which ``is_query`` holds against all others.

    Components become floor(scale * x) with x as double; the score is the
    integer inner product, exact whatever its size (one that does not fit in a
    long raises), ties go to the smaller key, and a query with fewer than k
    candidates has all of them.  A query is not compared with rows of its own
    key.  Vectors that are null or hold a null or non-finite component take no
    part, nor do those without key.  Vectors of another length than the
    query's are not compared with it.  Rows that repeat key and vector count
    once."""
    rows = (
        vectors.where(F.col(key).isNotNull() & finite(vector))
        .select(F.col(key).cast("long").alias("id"), F.transform(vector, lambda x: x.cast("double")).alias("v"), is_query.alias("q"))
        .dropDuplicates(["id", "v"])
    )
    rows = materialize(rows, "vectors")
    celled = materialize(_cells(rows, reference_directions(rows, cells, scale), scale).withColumn("dim", F.size("v")), "cells")
    sizes = celled.groupBy("dim", "cell").agg(F.ceil(F.count("*") / block_rows).alias("n"))
    dealt = celled.join(sizes, ["dim", "cell"]).select("dim", "cell", F.pmod(F.xxhash64("id", "v"), F.col("n")).cast("int").alias("block"), "id", "v")
    blocks = materialize(dealt.groupBy(*_BLOCK).applyInArrow(_block_row(scale), "dim int, cell int, block int, ids binary, vectors binary, top array<double>, bottom array<double>"), "blocks")
    n = celled.where("q").count()
    parts = -(-n // query_rows) or 1
    queries = celled.where("q").select("dim", F.pmod(F.xxhash64("id", "v"), F.lit(parts)).cast("int").alias("part"), F.col("id").alias("query_id"), F.xxhash64("v").alias("h"), "v")
    heads = blocks.select(*_BLOCK, "top", "bottom", F.pmod(F.xxhash64(*_BLOCK), F.lit(head_parts := blocks.count() // _HEADS + 1)).cast("int").alias("heads"))

    def reached(some: DataFrame, first: bool) -> DataFrame:
        """(dim, part, query_id, h, cell, block, bound) of the blocks of each
        query of ``some``: the one with the best bound among some blocks, or
        all but the one searched first that reach its k-th score."""

        def run(asked: pa.Table, tops: pa.Table) -> pa.Table:
            columns = ["dim", "part", "query_id", "h", "cell", "block"]
            if not asked.num_rows or not tops.num_rows:
                return pa.table([pa.array([], t) for t in _PAIR_TYPES], [*columns, "bound"])
            q, high, low = integers(asked.column("v"), asked.num_rows, scale), _matrix(tops, "top"), _matrix(tops, "bottom")
            bound = block_bounds(q, high, low)
            if first:
                i, j = np.arange(len(q)), bound.argmax(axis=1)
            else:
                cell, block = (np.array(tops.column(c).to_pylist()) for c in ("cell", "block"))
                searched = (asked.column("cell").to_numpy()[:, None] == cell) & (asked.column("block").to_numpy()[:, None] == block)
                i, j = np.nonzero((bound >= asked.column("kth").to_numpy()[:, None]) & ~searched)
            taken = [asked.column(c).take(pa.array(i)) for c in columns[:4]] + [tops.column(c).take(pa.array(j)) for c in columns[4:]]
            return pa.table([*taken, pa.array(bound[i, j])], [*columns, "bound"])

        spread = some.select("*", F.explode(F.sequence(F.lit(0), F.lit(head_parts - 1))).alias("heads"))
        tops = heads.select("*", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"))
        return _own(spread).groupBy("dim", "part", "heads").cogroup(_own(tops).groupBy("dim", "part", "heads")).applyInArrow(run, "dim int, part int, query_id long, h long, cell int, block int, bound double")

    def search(pairs: DataFrame) -> DataFrame:
        """(query_id, h, id, score): the k best of each pair's block."""

        def run(block: pa.Table, asked: pa.Table) -> pa.Table:
            out: list[tuple] = []
            if block.num_rows and asked.num_rows:
                ids = np.frombuffer(block.column("ids")[0].as_py(), np.int64)
                lists = SortedLists(np.frombuffer(block.column("vectors")[0].as_py(), np.float64).reshape(ids.size, -1), ids)
                for own, h, q in zip(asked.column("query_id").to_pylist(), asked.column("h").to_pylist(), integers(asked.column("v"), asked.num_rows, scale)):
                    out += [(own, h, i, s) for s, i in lists.search(q, own, k)[0]]
            columns = list(zip(*out)) or [[]] * 4
            return pa.table([pa.array(c, pa.int64()) for c in columns], ["query_id", "h", "id", "score"])

        keys = [*_BLOCK, "part"]
        asked = pairs.select(*keys, "query_id", "h").join(queries.select("query_id", "h", "v"), ["query_id", "h"])
        held = blocks.select(*_BLOCK, "ids", "vectors").join(pairs.select(*keys).distinct(), list(_BLOCK))
        return _own(held).groupBy(*keys).cogroup(_own(asked).groupBy(*keys)).applyInArrow(run, "query_id long, h long, id long, score long")

    def ranked(found: DataFrame) -> DataFrame:
        best_ = Window.partitionBy("query_id", "h").orderBy(F.desc("score"), "id")
        return found.withColumn("rank", F.row_number().over(best_)).where(F.col("rank") <= k)

    best_block = F.max_by(F.struct("dim", "part", "cell", "block"), F.struct("bound", "cell", "block")).alias("b")
    first = materialize(reached(queries, True).groupBy("query_id", "h").agg(best_block).select("query_id", "h", "b.*"), "first")
    found = materialize(search(first), "found")
    kth = ranked(found).where(F.col("rank") == k).select("query_id", "h", F.col("score").cast("double").alias("kth"))
    then = queries.join(first.select("query_id", "h", "cell", "block"), ["query_id", "h"]).join(kth, ["query_id", "h"], "left").withColumn("kth", F.coalesce("kth", F.lit(float("-inf"))))
    rest = materialize(reached(then, False), "rest")
    return ranked(found.union(search(rest))).select("query_id", "rank", F.col("id").alias(key), "score")


_BLOCK = ("dim", "cell", "block")
_PAIR_TYPES = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.float64())


def _own(df: DataFrame) -> DataFrame:
    """With columns of its own: the two sides of a cogroup must share none."""
    return df.select(*[F.col(c).alias(c) for c in df.columns])


def _matrix(table: pa.Table, column: str) -> np.ndarray:
    return np.array(table.column(column).to_pylist(), np.float64).reshape(table.num_rows, -1)


def _cells(rows: DataFrame, references: dict[int, np.ndarray], scale: int) -> DataFrame:
    """``rows`` (id, v, q) with ``cell``: the reference direction nearest to
    the vector, 0 where its length has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size = b.column(1).value_lengths().to_numpy()
            cell = np.zeros(b.num_rows, np.int32)
            for d in np.unique(size).tolist():
                if len(references.get(d, ())):
                    at = np.flatnonzero(size == d)
                    cell[at] = (integers(b.column(1).take(pa.array(at)), at.size, scale) @ references[d].T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell)], ["id", "v", "q", "cell"])

    return rows.mapInArrow(run, "id long, v array<double>, q boolean, cell int")


def _block_row(scale: int):
    """A block's rows as one: ids, integer vectors, and the heads of its lists."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        vectors = integers(rows.column("v"), rows.num_rows, scale)
        values = [rows.column("id").to_numpy().tobytes(), vectors.tobytes(), vectors.max(axis=0).tolist(), vectors.min(axis=0).tolist()]
        types = [pa.int32()] * 3 + [pa.binary()] * 2 + [pa.list_(pa.float64())] * 2
        return pa.table([pa.array([x], t) for x, t in zip([*(k.as_py() for k in key), *values], types)], [*_BLOCK, "ids", "vectors", "top", "bottom"])

    return run
