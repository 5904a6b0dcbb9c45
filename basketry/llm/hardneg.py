"""Hard-negative mining with angular triangle filtering.

Every vector stores its length and its angles to a few reference directions
(vectors of the table, those with the smallest hashes).  On the sphere angles
obey the triangle inequality, so the angle between an anchor and a row lies
between the largest difference and the smallest sum of their angles to the same
reference.  The cosines of that interval times both lengths, widened by more
than all rounding, bound the integer score.

Positives: only rows of the anchor's label whose upper bound reaches the k-th
largest lower bound are scored.  Negatives: only rows of other labels whose
interval overlaps the window of one of the anchor's positives, and still can
be among its first, are scored.

Rows are dealt into blocks by a hash and anchors into chunks; every block meets
every chunk in a group of bounded size, and the blocks' best are merged per
anchor (and positive).
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import col
from basketry.llm.vectors import SCALE, best, finite, inner, integers, kth_largest, norms, reference_directions
from basketry.session import materialize

POSITIVES = 5
NEGATIVES = 3
#: A negative's score lies between these percentages of its positive's.
WINDOW = (50, 95)
#: Reference directions.
REFERENCES = 16
BLOCK_ROWS = 16_384
ANCHOR_ROWS = 2048
#: More than the error of an angle (radians), and of a cosine or product.
_ANGLE_ERROR = 1e-6
_SHARE_ERROR = 1e-9


def angles(vectors: np.ndarray, lengths: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angle of each vector to each reference (unit vectors); 0 for a zero
    vector, whose scores are 0 anyhow."""
    safe = np.where(lengths > 0, lengths, 1.0)
    return np.arccos(np.clip((vectors / safe[:, None]) @ references.T, -1, 1))


def score_bounds(own_angles: np.ndarray, own_length: float, all_angles: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) possible integer score of the vector with the first
    two and each of those with the others, safe against rounding."""
    product = own_length * lengths
    if not all_angles.shape[1]:
        least, most = np.zeros(len(lengths)), np.full(len(lengths), np.pi)
    else:
        least = np.abs(all_angles - own_angles).max(axis=1)
        sums = all_angles + own_angles
        most = np.minimum(sums, 2 * np.pi - sums).min(axis=1)
    high = np.cos(np.clip(least - _ANGLE_ERROR, 0, np.pi))
    low = np.cos(np.clip(most + _ANGLE_ERROR, 0, np.pi))
    slack = product * _SHARE_ERROR + 1
    return product * low - slack, product * high + slack


class Block:
    """Rows of one group, with what their bounds are made of."""

    def __init__(self, table: pa.Table, scale: int):
        n = table.num_rows
        self.ids = table.column("id").to_numpy()
        self.labels = table.column("label").to_numpy()
        self.vectors = integers(table.column("v"), n, scale)
        self.lengths = table.column("length").to_numpy()
        self.angles = np.asarray(table.column("angles").combine_chunks().flatten().to_numpy(zero_copy_only=False), np.float64).reshape(n, -1)
        self.scored = 0  # how many integer scores were made

    def score(self, rows: np.ndarray, anchor: Block, a: int) -> np.ndarray:
        self.scored += rows.size
        return inner(self.vectors[rows], self.lengths[rows], anchor.vectors[a], float(anchor.lengths[a]))

    def positives(self, anchor: Block, a: int, k: int) -> list[tuple[int, int]]:
        rows = np.flatnonzero((self.labels == anchor.labels[a]) & (self.ids != anchor.ids[a]))
        low, high = score_bounds(anchor.angles[a], float(anchor.lengths[a]), self.angles[rows], self.lengths[rows])
        rows = rows[high >= kth_largest(low, k)]
        return best(self.score(rows, anchor, a), self.ids[rows], k)

    def negatives(self, anchor: Block, a: int, positives: list[tuple[int, int]], window: tuple[int, int], k: int) -> list[tuple[int, int, int, int]]:
        """(positive id, its score, negative id, its score) of the first k of
        this block for each positive."""
        rows = np.flatnonzero(self.labels != anchor.labels[a])
        low, high = score_bounds(anchor.angles[a], float(anchor.lengths[a]), self.angles[rows], self.lengths[rows])
        wanted = np.zeros(rows.size, bool)
        ranges = []
        for p, score in positives:
            # integer bounds of 100 * negative, rounded inwards
            least, most = -(-window[0] * score // 100), window[1] * score // 100
            if least > most:
                continue
            ranges.append((p, score, least, most))
            # once k rows surely lie inside, those surely below them don't count
            inside = kth_largest(low[(low >= least) & (high <= most)], k)
            wanted |= (high >= max(least - 1, inside)) & (low <= most + 1)
        rows = rows[wanted]
        scores = self.score(rows, anchor, a) if rows.size else np.zeros(0)
        out = []
        for p, score, least, most in ranges:
            fit = np.flatnonzero((scores >= least) & (scores <= most))
            out += [(p, score, i, s) for i, s in best(scores[fit], self.ids[rows[fit]], k)]
        return out


def _stored(rows: DataFrame, references: np.ndarray, scale: int) -> DataFrame:
    """``rows`` (id, label, v) with length and angles to the references of
    their own dimension."""

    def run(batches):
        for b in batches:
            size = b.column(2).value_lengths().to_numpy() if b.num_rows else np.zeros(0)
            lengths, found = np.zeros(b.num_rows), [[]] * b.num_rows
            for d in np.unique(size).tolist():
                at = np.flatnonzero(size == d)
                vectors = integers(b.column(2).take(pa.array(at)), at.size, scale)
                lengths[at] = norms(vectors)
                for i, x in zip(at.tolist(), angles(vectors, lengths[at], references.get(d, np.zeros((0, d)))).tolist()):
                    found[i] = x
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lengths), pa.array(found, pa.list_(pa.float64()))], ["id", "label", "v", "anchor", "length", "angles"])

    return rows.mapInArrow(run, "id long, label long, v array<double>, anchor boolean, length double, angles array<double>")


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    window: tuple[int, int] = WINDOW,
    scale: int = SCALE,
    references: int = REFERENCES,
    block_rows: int = BLOCK_ROWS,
    anchor_rows: int = ANCHOR_ROWS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score), long but for rank int: per anchor and positive the first
    ``negatives`` rows of another label with window[0] * positive_score <= 100 *
    negative_score <= window[1] * positive_score.

    Components become floor(scale * x); scores are integer inner products,
    larger first, ties by smaller key.  An anchor's positives are its first
    ``positives`` other rows of the same label.  Rows with a null key, label or
    vector, or a null or non-finite component, take no part; a row is not
    compared with rows of its own key, nor with vectors of another length.
    Rows that repeat key, label and vector count once.  An empty table gives no
    rows.  A score that does not fit in a long raises."""
    rows = (
        vectors.where(col(key).isNotNull() & label.isNotNull() & finite(vector))
        .select(col(key).cast("long").alias("id"), label.cast("long").alias("label"), F.transform(vector, lambda x: x.cast("double")).alias("v"), is_anchor.alias("anchor"))
        .dropDuplicates(["id", "label", "v"])
    )
    rows = materialize(rows, "vectors")
    stored = materialize(_stored(rows, reference_directions(rows, references, scale), scale), "angles").withColumn("dim", F.size("v"))
    counts = stored.agg(F.count("*").alias("n"), F.count_if("anchor").alias("a")).first()
    blocks, chunks = -(-counts["n"] // block_rows) or 1, -(-counts["a"] // anchor_rows) or 1
    dealt = lambda n: F.pmod(F.xxhash64("id", "label", "v"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    named = [F.col(c).alias(c) for c in ("dim", "id", "label", "v", "length", "angles")]  # columns of their own on either side
    left = stored.select(*named, dealt(blocks).alias("block"), every(chunks).alias("part"))
    anchors = stored.where("anchor").select(*named, dealt(chunks).alias("part"), F.xxhash64("label", "v").alias("h"))

    def search(of: Callable[[Block, Block, int, list], list[tuple]], right: DataFrame, names: list[str]) -> DataFrame:
        """What ``of`` finds for every anchor in every block."""

        def run(candidates: pa.Table, queries: pa.Table) -> pa.Table:
            out: list[tuple] = []
            if candidates.num_rows and queries.num_rows:
                block, anchor = Block(candidates, scale), Block(queries, scale)
                given = queries.column("given").to_pylist() if "given" in queries.column_names else [[]] * queries.num_rows
                for a, (own, h) in enumerate(zip(anchor.ids.tolist(), queries.column("h").to_pylist())):
                    out += [(own, h, *x) for x in of(block, anchor, a, [(g["id"], g["score"]) for g in given[a]])]
            columns = list(zip(*out)) or [[]] * (2 + len(names))
            return pa.table([pa.array(c, pa.int64()) for c in columns], ["anchor_id", "h", *names])

        keys = ["dim", "block", "part"]
        spread = right.select("*", every(blocks).alias("block"))
        return left.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInArrow(run, ", ".join(f"{c} long" for c in ["anchor_id", "h", *names]))

    def merged(found: DataFrame, per: list[str], score: str, id_: str, k: int) -> DataFrame:
        order = Window.partitionBy(*per).orderBy(F.desc(score), id_)
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    near = merged(search(lambda b, x, a, _: b.positives(x, a, positives), anchors, ["id", "score"]), ["anchor_id", "h"], "score", "id", positives)
    given = near.groupBy("anchor_id", "h").agg(F.collect_list(F.struct("id", "score")).alias("given"))  # at most ``positives``
    ready = anchors.join(given.withColumnRenamed("anchor_id", "id"), ["id", "h"])
    names = ["positive_id", "positive_score", "negative_id", "negative_score"]
    hard = search(lambda b, x, a, g: b.negatives(x, a, g, window, negatives), ready, names)
    return merged(hard, ["anchor_id", "h", "positive_id", "positive_score"], "negative_score", "negative_id", negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
