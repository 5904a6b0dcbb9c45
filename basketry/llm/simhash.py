"""SimHash near-duplicates by the generalised pigeonhole principle.

1. A 64-bit fingerprint per document from the XXH64 hashes of its word
   shingles (:func:`fingerprints`).
2. Equal fingerprints collapse to one row; everything after works on distinct
   fingerprints, so a group of exact copies costs one row, however large.
3. The 64 bits are grouped into partitions, correlated bits together
   (:func:`group_bits`, from the 64x64 co-occurrence counts of all distinct
   fingerprints).  A threshold t_i per partition with sum t_i = d - m + 1
   guarantees that two fingerprints within d bits are within t_i in some
   partition i.  :func:`allocate` chooses the number of partitions and the
   (unequal) thresholds by dynamic programming on estimated candidate counts;
   t_i = -1 skips a partition.
4. Probe: a fingerprint is sent to one bucket per partition and per choice of
   t_i cleared bits.  Verify: inside a bucket the whole 64-bit distance is
   tested.  A bucket yields a spanning forest of its links, never all pairs.
   Buckets over ``BUCKET_LIMIT`` members are linked exactly by meeting points
   instead: two fingerprints are within 2 bits iff they share a fingerprint
   at most one bit from both (for d bits: d/2 flips from both, rounded up).
5. Connected components of the links by alternating large-star and small-star
   rounds, each written to the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import join_hot, map_batches, slices, text_bytes
from basketry.session import materialize

BITS = 64
SHINGLE_WORDS = 3
MAX_DISTANCE = 2
HASH_SEED = 42
#: Members of a bucket that one task compares with each other (at most
#: 2^27 64-bit comparisons, under a second); larger buckets are linked by
#: meeting points, spread over all tasks.
BUCKET_LIMIT = 1 << 14
#: Weight of one probe row (shuffled) against one verified pair (a XOR).
PROBE_COST, PAIR_COST = 100.0, 1.0
_CHUNK = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE_WORDS, seed: int = HASH_SEED) -> int:
    """Unsigned 64-bit SimHash of UTF-8 ``text``: ASCII letters lower-cased,
    words split at ASCII white space, a bit is set if it is set in more than
    half of the shingles' XXH64 hashes.  No word: 0; fewer words than a
    shingle: the whole sequence is the one shingle."""
    words = text.lower().split()
    if not words:
        return 0
    hashed = partial(xxhash.xxh64_intdigest, seed=seed)
    joined = b" ".join(words)
    if len(words) <= shingle:
        return hashed(joined)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - shingle + 1].tolist()
    stops = (ends[shingle - 1 :] - 1).tolist()
    n = len(starts)
    ones = np.zeros(BITS, np.int64)
    for i in range(0, n, _CHUNK):
        part = zip(starts[i : i + _CHUNK], stops[i : i + _CHUNK])
        h = np.fromiter((hashed(joined[a:b]) for a, b in part), "<u8", min(_CHUNK, n - i))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE_WORDS, seed: int = HASH_SEED) -> DataFrame:
    """(key, text_hash long, fp long): one row per row of ``docs``.  ``fp``
    holds the 64 bits as a signed long; null text counts as empty.
    ``text_hash`` names the text, so that rows without or with repeated keys
    stay distinguishable."""
    kind = docs.schema[key].dataType.simpleString()
    slim = docs.select(F.col(key).alias("k"), F.xxhash64(text).alias("h"), F.col(text).cast("string").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "t"):
            fps = np.array([fingerprint(t, shingle, seed) for t in text_bytes(b.column(2))], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))], ["k", "h", "fp"])

    return map_batches(slim, run, f"k {kind}, h long, fp long").select(F.col("k").alias(key), F.col("h").alias("text_hash"), "fp")


# --- planning: partitions and thresholds -----------------------------------


def bit_counts(groups: DataFrame) -> tuple[int, np.ndarray]:
    """Rows of ``groups`` and the 64x64 matrix of how often two bits are set
    together, over all rows.  4096 sums come to the driver, whatever the
    input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        together = np.zeros((BITS, BITS))
        n = 0
        for b in batches:
            fps = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for i in range(0, len(fps), _CHUNK):
                bits = np.unpackbits(fps[i : i + _CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                together += bits.T @ bits
                n += len(bits)
        if n:
            cell = np.arange(BITS * BITS + 1, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(np.append(together.ravel(), n).astype(np.int64))], ["cell", "n"])

    rows = groups.select("fp").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    flat = np.zeros(BITS * BITS + 1, np.int64)
    for r in rows:
        flat[r["cell"]] = r["n"]
    return int(flat[-1]), flat[:-1].reshape(BITS, BITS)


def group_bits(n: int, together: np.ndarray, parts: int) -> list[list[int]]:
    """``parts`` groups of bits, widths equal up to one.  Each group starts at
    the unused bit with the strongest correlations and takes the bits most
    correlated with what it holds."""
    p = np.diag(together) / max(n, 1)
    sd = np.sqrt(np.clip(p * (1 - p), 1e-12, None))
    corr = np.abs((together / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    free = list(range(BITS))
    out = []
    for i in range(parts):
        width = len(free) // (parts - i)
        group = [max(free, key=lambda b: (corr[b, free].sum(), -b))]
        free.remove(group[0])
        while len(group) < width:
            best = max(free, key=lambda b: (corr[b, group].sum(), -b))
            group.append(best)
            free.remove(best)
        out.append(group)
    return out


def within(n: int, together: np.ndarray, group: Sequence[int], most: int) -> list[float]:
    """Estimated share of pairs that differ in at most 0..``most`` bits of
    ``group``.  Agreement along the group's bits is taken as a Markov chain
    whose steps come from the joint frequencies of neighbouring bits, so
    correlated bits are not mistaken for independent ones."""
    share = lambda a, b: together[a, b] / max(n, 1)
    first = share(group[0], group[0])
    agree = first**2 + (1 - first) ** 2
    # state[d][s]: d differing bits so far, last bit agrees (1) or not (0)
    state = np.zeros((most + 2, 2))
    state[0, 1], state[1, 0] = agree, 1 - agree
    for a, b in zip(group, group[1:]):
        p11 = share(a, b)
        p10, p01 = share(a, a) - p11, share(b, b) - p11
        p00 = 1 - p11 - p10 - p01
        both = p11**2 + p10**2 + p01**2 + p00**2
        only_a = 2 * (p11 * p10 + p01 * p00)
        only_b = 2 * (p11 * p01 + p10 * p00)
        neither = max(0.0, 1 - both - only_a - only_b)
        if_agree = np.array([only_a, both]) / max(only_a + both, 1e-300)
        if_not = np.array([neither, only_b]) / max(neither + only_b, 1e-300)
        new = np.zeros_like(state)
        for d in range(most + 2):
            a1, a0 = state[d, 1], state[d, 0]
            new[d, 1] += a1 * if_agree[1] + a0 * if_not[1]
            new[min(d + 1, most + 1), 0] += a1 * if_agree[0] + a0 * if_not[0]
        state = new
    return np.cumsum(state.sum(axis=1))[: most + 1].tolist()


def allocate(n: int, together: np.ndarray, distance: int = MAX_DISTANCE) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each partition that is probed.  For every number
    of partitions m up to distance + 1, thresholds with the sum
    distance - m + 1 are found by dynamic programming over the partitions; the
    cost of a threshold t is n * C(width, t) probe rows plus the estimated
    candidate pairs within t."""
    n = max(n, 1)
    best: tuple[float, list[tuple[list[int], int]]] | None = None
    for m in range(1, distance + 2):
        groups = group_bits(n, together, m)
        # reach[s]: cheapest cost and thresholds of the groups so far with sum s
        reach: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for g in groups:
            pairs = [n * n / 2 * share for share in within(n, together, g, distance)]
            cost = {-1: 0.0} | {t: PROBE_COST * n * comb(len(g), t) + PAIR_COST * pairs[t] * comb(len(g), t) for t in range(distance + 1)}
            step: dict[int, tuple[float, list[int]]] = {}
            for s, (c, ts) in reach.items():
                for t, own in cost.items():
                    if s + t not in step or c + own < step[s + t][0]:
                        step[s + t] = (c + own, [*ts, t])
            reach = step
        c, ts = reach[distance - m + 1]
        if best is None or c < best[0]:
            best = (c, [(sorted(g), t) for g, t in zip(groups, ts) if t >= 0])
    return best[1]


# --- probe and verify --------------------------------------------------------


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def masks(plan: Sequence[tuple[Sequence[int], int]]) -> list[int]:
    """A mask per partition and choice of cleared bits: two fingerprints
    within t bits in a partition agree under one of its masks."""
    return [_signed(sum(1 << b for b in bits if b not in off)) for bits, t in plan for off in map(set, combinations(bits, t))]


def links(fps: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (root, member) of the links within ``distance`` bits
    among distinct ``fps``, by breadth-first search over whole arrays."""
    left = np.sort(fps)
    roots, members = [], []
    while left.size > 1:
        root, frontier, left = left[0], left[:1], left[1:]
        while frontier.size and left.size:
            near = np.zeros(left.size, bool)
            step = max(1, (1 << 22) // left.size)
            for i in range(0, frontier.size, step):
                near |= (np.bitwise_count(frontier[i : i + step, None] ^ left[None, :]) <= distance).any(axis=0)
            frontier, left = left[near], left[~near]
            roots.append(np.full(frontier.size, root, np.uint64))
            members.append(frontier)
    none = [np.empty(0, np.uint64)]
    return np.concatenate(roots or none), np.concatenate(members or none)


def _verify(distance: int):
    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Whole buckets only: (bucket number, fp) of rows sorted by bucket."""
        rest: list[np.ndarray] = []
        for b in batches:
            if not b.num_rows:
                continue
            rows = np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)])
            rest.append(rows)
            key = rows[:2]
            changes = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            if not changes.size and (len(rest) == 1 or (rest[0][:2, 0] == key[:, 0]).all()):
                continue
            whole = np.concatenate(rest, axis=1)
            edge = np.flatnonzero((whole[:2, 1:] != whole[:2, :-1]).any(axis=0)) + 1
            cut = edge[-1]
            rest = [whole[:, cut:]]
            yield np.concatenate(([0], edge)), whole[2, :cut].view(np.uint64)
        if rest:
            whole = np.concatenate(rest, axis=1)
            edge = np.flatnonzero((whole[:2, 1:] != whole[:2, :-1]).any(axis=0)) + 1
            yield np.concatenate(([0], edge, [whole.shape[1]])), whole[2].view(np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for edge, fps in buckets(batches):
            size = np.diff(edge)
            out = []
            # buckets of two, the usual case, at once
            two = edge[:-1][size == 2]
            a, b = fps[two], fps[two + 1]
            near = np.bitwise_count(a ^ b) <= distance
            out.append((a[near], b[near]))
            for start, n in zip(edge[:-1][size > 2].tolist(), size[size > 2].tolist()):
                out.append(links(fps[start : start + n], distance))
            a, b = (np.concatenate(x).view(np.int64) for x in zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return run


def linked(groups: DataFrame, distance: int = MAX_DISTANCE, plan: Sequence[tuple[Sequence[int], int]] | None = None, limit: int = BUCKET_LIMIT) -> DataFrame:
    """(a long, b long): links between the distinct fingerprints ``groups.fp``
    that connect exactly what the relation "within ``distance`` bits"
    connects.  ``plan`` overrides the partitions chosen from the data."""
    if plan is None:
        plan = allocate(*bit_counts(groups), distance)
    probes = groups.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks(plan)])).alias("part", "sig"))
    sizes = probes.groupBy("part", "sig").agg(F.count("*").alias("n")).where("n > 1")
    shared = probes.join(sizes, ["part", "sig"])
    small = shared.where(F.col("n") <= limit).select("part", "sig", "fp").repartition("part", "sig").sortWithinPartitions("part", "sig", "fp")
    found = small.mapInArrow(_verify(distance), "a long, b long")
    large = shared.where(F.col("n") > limit).select("fp").distinct()
    return found.union(_meeting_points(large, distance)).distinct()


def _meeting_points(fps: DataFrame, distance: int) -> DataFrame:
    """Links of ``fps`` through shared neighbours: all fingerprints at most
    distance // 2 flips from the same point are within ``distance`` bits, and
    any two within an even ``distance`` share such a point.  For an odd
    distance the points take the larger half and each link is verified."""
    reach = (distance + 1) // 2
    flips = [0] + [sum(1 << b for b in c) for r in range(1, reach + 1) for c in combinations(range(BITS), r)]
    near = fps.select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(_signed(x))) for x in flips])).alias("point"))
    if distance % 2 == 0:
        hub = near.groupBy("point").agg(F.min("fp").alias("hub"), F.count("*").alias("n")).where("n > 1")
        return near.join(hub, "point").where("fp <> hub").select(F.col("hub").alias("a"), F.col("fp").alias("b"))
    other = near.withColumnRenamed("fp", "other")
    return near.join(other, "point").where((F.col("fp") < F.col("other")) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= distance)).select(F.col("fp").alias("a"), F.col("other").alias("b"))


# --- components --------------------------------------------------------------


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links_: DataFrame) -> DataFrame:
    """(node long, root long) of every node of the links (a, b); the root is
    the smallest node of the component.  Alternating large-star and small-star
    rounds (about log n of them); each round is written, so lineage stays
    short and an executor's loss costs one round at most."""
    edges = materialize(links_.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")
    before = None
    while (now := _state(edges)) != before:
        before = now
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        down = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(down.union(low.select("u", F.col("m").alias("v"))).where("u > v").distinct(), "links")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE, seed: int = HASH_SEED, limit: int = BUCKET_LIMIT
) -> DataFrame:
    """One row per row of ``docs``: (key, text_hash, fingerprint, component_id,
    kept).  ``fingerprint`` is 16 lowercase hex digits; ``component_id`` the
    smallest key reachable over links of at most ``distance`` bits (null only
    if no member has a key); ``kept`` marks the component's first row by (key,
    nulls last, text_hash), true for every exact repeat of that row.

    Null text counts as empty, empty texts share fingerprint zero, an empty
    table gives no rows.  Other columns of ``docs`` are not read."""
    fps = materialize(fingerprints(docs, key, text, shingle, seed), "fingerprints")
    first = F.struct(F.col(key).isNull().alias("no_key"), F.col(key).alias("key"), F.col("text_hash").alias("h"))
    groups = materialize(fps.groupBy("fp").agg(F.min(first).alias("first"), F.count("*").alias("copies")), "groups")
    found = components(linked(groups, distance, limit=limit))
    chained = found.join(groups.withColumnRenamed("fp", "node"), "node")
    lowest = chained.groupBy("root").agg(F.min("first").alias("first"))
    # few fingerprints have links; the others are their own component
    owner = chained.select("node", "root").join(lowest, "root").select(F.col("node").alias("fp"), F.col("first").alias("linked"))
    named = groups.join(owner, "fp", "left").select("fp", "copies", F.coalesce("linked", "first").alias("first"))
    return join_hot(fps, named, "fp", "copies").select(
        key,
        "text_hash",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first.key").alias("component_id"),
        (F.col(key).eqNullSafe(F.col("first.key")) & F.col("text_hash").eqNullSafe(F.col("first.h"))).alias("kept"),
    )


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE) -> DataFrame:
    """``docs`` with one row of each near-duplicate component, all columns
    kept: the component's first by (key, nulls last, text), exact repeats of
    that row counted as one."""
    # a key that is never null: join and clean-up then share one partitioning
    name = lambda c: F.when(F.col(c).isNull(), "-").otherwise(F.concat(F.lit("+"), F.col(c).cast("string")))
    keep = near_duplicates(docs, key, text, shingle, distance).where("kept").select(name(key).alias("__name"), F.col("text_hash").alias("__hash"))
    marked = docs.withColumns({"__name": name(key), "__hash": F.xxhash64(text)})
    return marked.join(keep, ["__name", "__hash"], "left_semi").dropDuplicates(["__name", "__hash"]).drop("__name", "__hash")
