"""N-gram Jaccard join with prefix filters under several global token orders.

Two sets of sizes n and m link when their Jaccard similarity is at least
``percent`` / 100.  Then the first n - ceil(percent * n / 100) + 1 tokens of
both, in *any* order of all tokens, share one.  So a pair is verified only if
it shares a prefix token under every one of several orders.

1. :func:`token_sets`: a node (hash of the whole set) for each document, and
   how often the tokens of each of 2^23 buckets occur, over all documents.
   Documents of equal sets are one node from here on.
2. Every order sorts by the class of the token's bucket (rare ones first, by
   powers of two) and then by a hash of its own, so common passages come into
   no prefix of a document that has enough else.  The first class ends a few
   deviations above the mean bucket, so common tokens stay out of it however
   full the buckets are.
3. :func:`prefixes`, shuffled by (order, token).  Nodes that share a token of
   the first class in an order are a candidate pair of that order if their sizes
   and the token's places allow; pairs that are not candidates of every order go.
   A prefix that goes beyond the first class stands for :func:`signatures`
   instead: all tokens of the set are dealt into more parts than linked sets
   can have differences, so two of them have a part in common as a whole.  Nodes
   of a signature (or of a token with too many for pairs) are chained to one of
   them.  Pairs and chains fall into connected classes, and every link lies
   within one.
4. :func:`_verify`: the sets of a class meet once.  Inside, a breadth-first
   search tests a node against all that are not yet reached: size, a common
   prefix token under every order, then the whole intersection.  A class of
   more than ``CLASS_TOKENS`` tokens is dealt into blocks, and every two of its
   blocks meet; a task never holds more than two blocks.
5. Connected components of the links.

Sets are made of 64-bit hashes, which are made anew from the text in each pass
(see ``shingles``) rather than kept or shuffled.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import col, join_hot, map_batches, slices
from basketry.llm.shingles import mix, seeds, shingle_sets
from basketry.llm.simhash import components
from basketry.session import materialize

SHINGLE_WORDS = 3
PERCENT = 90
ORDERS = 3
#: Token counts are kept in 2^TABLE_BITS buckets, summed in chunks of 2^16.
TABLE_BITS = 23
_CHUNK_BITS = 16
#: Most nodes of a token that are paired, and occurrences in a bucket of the
#: first class.  Both rise with the mean bucket, see ``_first_class``.
GROUP = 64
FIRST_CLASS = 32
#: Standard deviations above the mean at which the first class ends.
_DEVIATIONS = 4
#: Sizes from one band of sizes to the next; parts with fewer tokens are poor.
_BAND = 1.4
_POOR = 3
#: Tokens of a block of a class of candidates.
CLASS_TOKENS = 1 << 21
#: Subgroups of the nodes of a common token.
SALTS = 16
#: Nodes that a task remembers to have dealt with.
_REMEMBERED = 1 << 18
#: Bits of the filter for the texts that are candidates (2 MB).
_FILTER_BITS = 1 << 24
_SIGNATURE_SEED = 1 << 20


def prefix_size(n: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """n - ceil(percent * n / 100) + 1; 0 for the empty set."""
    return np.where(n > 0, n - (percent * n + 99) // 100 + 1, 0)


def _nodes(tokens: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A hash of each set, 0 for the empty one."""
    n = np.diff(bounds)
    out = np.zeros(n.size, np.uint64)
    some = np.flatnonzero(n)
    if some.size:
        starts = bounds[:-1][some]
        total = np.add.reduceat(mix(tokens + np.uint64(1)), starts) + mix(np.bitwise_xor.reduceat(tokens, starts))
        out[some] = mix(total + n[some].astype(np.uint64))
    return out


def _bucket(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def token_sets(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """Per document (k, h: hash of the text, n: size of its set, node), with a
    null ``chunk``; per task and chunk of the bucket table a row (chunk,
    counts: compressed 32-bit numbers)."""
    kind = docs.schema[key].dataType.simpleString()
    slim = docs.select(col(key).alias("k"), F.xxhash64(col(text)).alias("h"), col(text).cast("string").alias("t"))
    names = ["k", "h", "n", "node", "chunk", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << TABLE_BITS, np.int32)
        keys = pa.null()
        for b in slices(batches, "t"):
            tokens, bounds = shingle_sets(b.column(2), size)
            np.add.at(table, _bucket(tokens), 1)
            keys, none = b.column(0).type, pa.nulls(b.num_rows, pa.int32())
            columns = [b.column(0), b.column(1), pa.array(np.diff(bounds), pa.int64()), pa.array(_nodes(tokens, bounds).view(np.int64)), none, pa.nulls(b.num_rows, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names)
        chunks = table.reshape(-1, 1 << _CHUNK_BITS)
        some = np.flatnonzero(chunks.any(axis=1))
        if some.size:
            none = [pa.nulls(some.size, t) for t in (keys, pa.int64(), pa.int64(), pa.int64())]
            counts = pa.array([zlib.compress(chunks[i].astype("<i4").tobytes(), 1) for i in some], pa.binary())
            yield pa.RecordBatch.from_arrays([*none, pa.array(some, pa.int32()), counts], names)

    return map_batches(slim, run, f"k {kind}, h long, n long, node long, chunk int, counts binary")


def _first_class(total: int) -> int:
    """Most occurrences in a bucket of the first class, of ``total`` tokens: so
    a token that is common beside the deviations of a full bucket is not in it."""
    mean = total >> TABLE_BITS
    return max(FIRST_CLASS, mean + _DEVIATIONS * math.isqrt(mean))


def _classes(sets: DataFrame, first: int) -> bytes:
    """The class of each bucket, a byte each, compressed: 0 for buckets of up
    to ``first`` tokens, then one more for each doubling.  At most 8 MB,
    whatever the input."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        counts = np.zeros(1 << _CHUNK_BITS, np.int64)
        for c in rows.column("counts").to_pylist():
            counts += np.frombuffer(zlib.decompress(c), "<i4")
        level = np.zeros(counts.size, np.uint8)
        high = counts > first
        level[high] = np.clip(np.ceil(np.log2(counts[high] / first)), 1, 200).astype(np.uint8)
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([zlib.compress(level.tobytes(), 1)], pa.binary())], ["chunk", "level"])

    rows = sets.where("chunk is not null").groupBy("chunk").applyInArrow(run, "chunk int, level binary").collect()
    table = np.zeros((1 << TABLE_BITS - _CHUNK_BITS, 1 << _CHUNK_BITS), np.uint8)
    for r in rows:
        table[r["chunk"]] = np.frombuffer(zlib.decompress(r["level"]), np.uint8)
    return zlib.compress(table.tobytes(), 1)


def ordered_prefixes(tokens: np.ndarray, bounds: np.ndarray, level: np.ndarray, orders: int, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of each order: (the prefix tokens of each set, one set after the other;
    their bounds).  A token stands as its class and 56 bits of the order's own
    hash of it."""
    sizes = prefix_size(np.diff(bounds), percent)
    ends = np.concatenate(([0], np.cumsum(sizes)))
    take = np.repeat(bounds[:-1] - ends[:-1], sizes) + np.arange(ends[-1])
    top = level[_bucket(tokens)].astype(np.uint64) << np.uint64(56)
    for seed in seeds(0, orders):
        ranked = top | (mix(tokens ^ seed) >> np.uint64(8))
        for a, z in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            ranked[a:z].sort()
        yield ranked[take], ends


def least_common(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Tokens that sets of these sizes have in common at least if they link."""
    return -(-percent * (n + m) // (100 + percent))


def _bands(largest: int, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first size of each band; its parts; how many of these may be poor).
    Linked sets lie in one band or in two neighbours.  Counted are the parts for
    links whose smaller set is in the band: of at most d different tokens, d + 1
    and the poor ones, so that one that is not poor is without a difference."""
    edges = [1]
    while edges[-1] <= largest:
        edges.append(max(edges[-1] + 1, math.ceil(edges[-1] * max(_BAND, 100 / percent)), -(-edges[-1] * 100 // percent)))
    top = np.array(edges[1:]) - 1
    differ = (top + top * 100 // percent) * (100 - percent) // (100 + percent)
    return np.array(edges), differ + 1 + differ // 16, differ // 16


def signatures(tokens: np.ndarray, bounds: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(signatures as tokens of class 1; the place of each one's set), some two
    for every ten tokens.  Sets that link share one: a signature stands for all
    tokens of a set in one of the parts of its band, or of the band below if it
    can link with a set of that.  Parts of a few tokens say little and are left
    out unless the set has many."""
    n = np.diff(bounds)
    edges, parts, poor = _bands(int(n.max(initial=1)), percent)
    band = np.searchsorted(edges, n, side="right") - 1
    own = np.flatnonzero(n)
    below = own[(band[own] > 0) & (100 * (edges[band[own]] - 1) >= percent * n[own])]
    out, sets = [], []
    salt, pick = seeds(_SIGNATURE_SEED, 2)
    for at, of in ((own, band[own]), (below, band[below] - 1)):
        if not at.size:
            continue
        ends = np.cumsum(parts[of])
        start, sizes = ends - parts[of], n[at]
        stop = np.cumsum(sizes)
        some = tokens[np.repeat(bounds[at] - (stop - sizes), sizes) + np.arange(stop[-1])]
        cell = np.repeat(start, sizes) + (mix(some ^ pick) % np.repeat(parts[of], sizes).astype(np.uint64)).astype(np.int64)
        held = np.bincount(cell, minlength=ends[-1])
        whole = np.zeros(ends[-1], np.uint64)
        np.add.at(whole, cell, mix(some ^ salt))
        which = np.repeat(np.arange(at.size), parts[of])
        few = held < _POOR
        keep = ~few | (np.add.reduceat(few, start, dtype=np.int64) > poor[of])[which]
        place = (of[which] << 32) + np.arange(ends[-1]) - start[which]
        out.append((mix(whole + mix(place.astype(np.uint64) ^ salt))[keep] >> np.uint64(8)) | np.uint64(1 << 56))
        sets.append(at[which[keep]])
    return (np.concatenate(out), np.concatenate(sets)) if out else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def prefixes(docs: DataFrame, text: str, size: int, classes, orders: int, percent: int) -> DataFrame:
    """(ord: a bit per order, token, salt, node, n: size, and above 32 bits the
    token's place in the order): the prefix tokens of the first class of every
    distinct set that can link (again where it is met again after many others,
    or in another task), and the signatures of sets whose prefixes have others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = np.frombuffer(zlib.decompress(classes.value), np.uint8)
        met: set[int] = set()
        for b in slices(batches, "t"):
            tokens, bounds = shingle_sets(b.column(0), size)
            nodes = _nodes(tokens, bounds).view(np.int64)
            fresh = np.zeros(nodes.size, bool)
            for i, x in enumerate(nodes.tolist()):
                if x not in met:
                    met.add(x)
                    held = bounds[i + 1] - bounds[i]
                    fresh[i] = 100 * held >= percent * (held + 1)  # else it links with no other set
            if len(met) > _REMEMBERED:
                met.clear()
            n = np.diff(bounds)
            tokens = tokens[np.repeat(fresh, n)]
            nodes, n = nodes[fresh], n[fresh]
            bounds = np.concatenate(([0], np.cumsum(n)))
            beyond = np.zeros(n.size, bool)
            for k, (found, ends) in enumerate(ordered_prefixes(tokens, bounds, level, orders, percent)):
                of = np.repeat(np.arange(n.size), np.diff(ends))
                place = np.arange(of.size) - ends[of]
                first = found >> np.uint64(56) == 0
                beyond[of[~first]] = True  # the same sets in every order
                of = of[first]
                yield rows_of(1 << k, found[first], nodes[of], n[of] | place[first] << 32)
            if beyond.any():
                few = tokens[np.repeat(beyond, n)]
                found, of = signatures(few, np.concatenate(([0], np.cumsum(n[beyond]))), percent)
                yield rows_of(1, found, nodes[beyond][of], n[beyond][of])

    def rows_of(order: int, found: np.ndarray, of: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        salt = np.where(found >> np.uint64(56) > 0, of & (SALTS - 1), 0)
        columns = [np.full(of.size, order, np.int8), found.view(np.int64), salt.astype(np.int8), of, n]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["ord", "token", "salt", "node", "n"])

    return map_batches(docs.select(col(text).cast("string").alias("t")), run, "ord byte, token long, salt byte, node long, n long")


def _candidates(percent: int, limit: int):
    """Rows sorted by (ord, token, salt, node, n) to edges (ord, a, b, token):
    candidate pairs a < b with a null token; chains with the token where it is
    common and salted (so that its subgroups' hubs can be chained), else 0.
    Sets whose first common token has so many others before it in one of them
    that too few can be left are no pair."""

    def emit(ord_: np.ndarray, a: np.ndarray, b: np.ndarray, token: np.ndarray | None) -> pa.RecordBatch:
        marks = pa.nulls(a.size, pa.int64()) if token is None else pa.array(token, pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(ord_.astype(np.int8)), pa.array(a), pa.array(b), marks], ["ord", "a", "b", "token"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((5, 0), np.int64)
        hub: np.ndarray | None = None  # of the chained group that goes on
        for b in _with_end(batches):
            rows = held if b is None else np.concatenate((held, np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns])), axis=1)
            if not rows.shape[1]:
                continue
            if hub is not None:
                more = (rows[:3] == hub[:3, None]).all(axis=0)
                if more.any():
                    yield emit(rows[0, more], np.full(int(more.sum()), hub[3]), rows[3, more], np.full(int(more.sum()), hub[1] if hub[1] >> 56 else 0))
                    rows = rows[:, ~more]
                if rows.shape[1]:
                    hub = None
                else:
                    held = rows
                    continue
            fresh = np.ones(rows.shape[1], bool)
            fresh[1:] = (rows[:4, 1:] != rows[:4, :-1]).any(axis=0)
            rows = rows[:, fresh]
            begins = np.flatnonzero(np.concatenate(([True], (rows[:3, 1:] != rows[:3, :-1]).any(axis=0))))
            last = int(begins[-1])
            if b is not None and rows.shape[1] - last <= limit and not rows[1, last] >> 56:
                rows, held = rows[:, :last], rows[:, last:]
                begins = begins[:-1]
            elif b is not None:  # a chained group whose end is not yet there
                hub, held = rows[:, last], rows[:, :0]
            if not begins.size:
                continue
            sizes = np.diff(np.append(begins, rows.shape[1]))
            chained = (sizes > limit) | (rows[1, begins] >> 56 != 0)
            first, group = np.repeat(begins, sizes), np.repeat(chained, sizes)
            if group.any():
                at, of = np.flatnonzero(group), first[group]
                yield emit(rows[0, at], rows[3, of], rows[3, at], np.where(rows[1, at] >> 56 != 0, rows[1, at], 0))
            end = first + np.repeat(sizes, sizes)
            at = np.flatnonzero(~group)
            for d in range(1, limit):
                at = at[at + d < end[at]]
                if not at.size:
                    break
                (n, m), (i, j) = (rows[4, [at, at + d]] & 0xFFFFFFFF), (rows[4, [at, at + d]] >> 32)
                least = least_common(n, m, percent)
                near = (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (n - i >= least) & (m - j >= least)
                yield emit(rows[0, at[near]], rows[3, at[near]], rows[3, at[near] + d], None)

    return run


def _with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def candidate_edges(postings: DataFrame, orders: int, percent: int, limit: int) -> DataFrame:
    """(a, b): edges whose connected classes hold every pair that shares a
    prefix token under all orders and may link by its sizes."""
    dealt = postings.repartition("ord", "token", "salt").sortWithinPartitions("ord", "token", "salt", "node", "n")
    edges = materialize(dealt.mapInArrow(_candidates(percent, limit), "ord byte, a long, b long, token long"), "candidates")
    pairs = edges.where("token is null").groupBy("a", "b").agg(F.bit_or("ord").alias("seen")).where(F.col("seen") == (1 << orders) - 1)
    chains = edges.where("token is not null")
    hubs = chains.where("token <> 0").select("ord", "token", "a").distinct()
    top = hubs.groupBy("ord", "token").agg(F.min("a").alias("top"))
    joined = hubs.join(top, ["ord", "token"]).select(F.col("top").alias("a"), F.col("a").alias("b"))
    return pairs.select("a", "b").union(chains.select("a", "b")).union(joined).where("a <> b")


def spanning_links(tokens: np.ndarray, bounds: np.ndarray, prefix: list[tuple[np.ndarray, np.ndarray]], percent: int) -> list[tuple[int, int]]:
    """Links (by position) that connect what all links of the sets connect:
    breadth-first search, each reached set against all that are not."""
    n = np.diff(bounds)
    count = n.size
    dense = lambda x: np.unique(x, return_inverse=True)[1]
    whole = dense(tokens)
    mark = np.zeros(int(whole.max(initial=-1)) + 1, bool)
    orders = [(dense(t), e) for t, e in prefix]
    marks = [np.zeros(int(d.max(initial=-1)) + 1, bool) for d, _ in orders]
    left = np.ones(count, bool)
    out = []
    for root in range(count):
        if not left[root]:
            continue
        left[root] = False
        queue = [root]
        while queue and left.any():
            x = queue.pop()
            near = left & (100 * np.minimum(n, n[x]) >= percent * np.maximum(n, n[x]))
            for (d, e), m in zip(orders, marks):
                if not near.any():
                    break
                own = d[e[x] : e[x + 1]]
                m[own] = True
                near &= np.add.reduceat(m[d], e[:-1], dtype=np.int64) > 0
                m[own] = False
            near = np.flatnonzero(near)
            if not near.size:
                continue
            own = whole[bounds[x] : bounds[x + 1]]
            mark[own] = True
            sizes = n[near]
            ends = np.cumsum(sizes)
            at = np.repeat(bounds[near] - (ends - sizes), sizes) + np.arange(ends[-1])
            common = np.add.reduceat(mark[whole[at]], ends - sizes, dtype=np.int64)
            mark[own] = False
            linked = near[100 * common >= percent * (n[x] + sizes - common)]
            left[linked] = False
            out += [(x, y) for y in linked.tolist()]
            queue += linked.tolist()
    return out


def _verify(size: int, classes, orders: int, percent: int):
    """Rows (class, i, j, node, t) sorted by the first three to links (a, b)."""

    def solve(nodes: np.ndarray, texts: pa.Array, level: np.ndarray) -> pa.RecordBatch:
        _, one = np.unique(nodes, return_index=True)
        tokens, bounds = shingle_sets(texts.take(pa.array(one)), size)
        found = spanning_links(tokens, bounds, list(ordered_prefixes(tokens, bounds, level, orders, percent)), percent)
        a, b = (np.array([nodes[one[p[i]]] for p in found], np.int64) for i in range(2))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = np.frombuffer(zlib.decompress(classes.value), np.uint8)
        group, parts = None, []
        for b in slices(batches, "t"):
            keys = np.stack([b.column(i).to_numpy() for i in range(3)])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1).tolist(), b.num_rows]
            for a, z in zip(cuts, cuts[1:]):
                if group != (now := tuple(keys[:, a].tolist())):
                    if parts:
                        yield solve(*_joined(parts), level)
                    group, parts = now, []
                parts.append((b.column(3).slice(a, z - a).to_numpy(), b.column(4).slice(a, z - a)))
        if parts:
            yield solve(*_joined(parts), level)

    return run


def _joined(parts: list) -> tuple[np.ndarray, pa.Array]:
    return np.concatenate([p[0] for p in parts]), pa.concat_arrays([p[1] for p in parts])


def _maybe_wanted(wanted: bytes):
    """Keep the rows whose hash h may be wanted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(zlib.decompress(wanted.value), np.uint8)
        for b in batches:
            at = b.column(1).to_numpy().view(np.uint64) % np.uint64(_FILTER_BITS)
            yield b.filter(pa.array(bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1 == 1))

    return run


def _filter_of(hashes: DataFrame) -> bytes:
    """A bitmap of the hashes' residues, in 512 pieces of 4 KB at most."""
    at = F.pmod(F.conv(F.hex("h"), 16, 10).cast("decimal(20,0)"), F.lit(_FILTER_BITS)).cast("long")
    rows = hashes.select(at.alias("at")).groupBy(F.bitmap_bucket_number(F.col("at") + 1).alias("piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("at") + 1)).alias("bits")).collect()
    out = bytearray(_FILTER_BITS // 8)
    for r in rows:
        out[(r["piece"] - 1) * 4096 : r["piece"] * 4096] = r["bits"]
    return zlib.compress(bytes(out), 1)


def links(docs: DataFrame, sets: DataFrame, key: str, text: str, size: int, percent: int, orders: int, limit: int, class_tokens: int) -> DataFrame:
    """(a, b): links between nodes that connect what all links connect."""
    share = docs.sparkSession.sparkContext.broadcast
    first = _first_class(sets.agg(F.sum("n").alias("n")).first()["n"] or 0)
    classes = share(_classes(sets, first))
    # no token of the first class has more than ``first`` nodes, so by default none has too many for pairs
    most = max(limit, limit * first // max(1, FIRST_CLASS))
    reached = components(candidate_edges(prefixes(docs, text, size, classes, orders, percent), orders, percent, most))
    name = lambda c: F.when(c.isNull(), "-").otherwise(F.concat(F.lit("+"), c.cast("string")))
    rows = sets.where("chunk is null and n > 0")
    met_at = rows.groupBy("node").agg(F.min(F.struct(name(F.col("k")).alias("name"), "h")).alias("at"), F.first("n").alias("n"))
    members = materialize(reached.join(met_at, "node").select("node", "root", "at.name", "at.h", "n"), "members")
    held = members.groupBy("root").agg(F.ceil(F.sum("n") / class_tokens).cast("int").alias("blocks"))
    wanted = share(_filter_of(members))
    texts = map_batches(docs.select(name(col(key)).alias("name"), F.xxhash64(col(text)).alias("h"), col(text).cast("string").alias("t")), _maybe_wanted(wanted), "name string, h long, t string")
    own = F.pmod(F.hash("node"), F.col("blocks"))
    others = F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: x != own))
    met = members.join(held, "root").withColumn("other", F.explode(others)).select("root", F.least(own, "other").alias("i"), F.greatest(own, "other").alias("j"), "node", "name", "h")
    meet = met.join(texts, ["name", "h"]).select("root", "i", "j", "node", "t").repartition("root", "i", "j").sortWithinPartitions("root", "i", "j")
    return map_batches(meet, _verify(size, classes, orders, percent), "a long, b long")


def jaccard_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE_WORDS, percent: int = PERCENT, orders: int = ORDERS, limit: int = GROUP, class_tokens: int = CLASS_TOKENS
) -> DataFrame:
    """(key, n_shingles long, component_id): one row per row of ``docs``.

    Documents link when 100 * intersection >= ``percent`` * union of their
    sets of ``size``-word shingles (words between ASCII white space, A-Z in
    lower case); one with fewer words has its whole sequence as one shingle.
    ``component_id`` is the smallest key reachable by links, itself included;
    documents without words, null texts among them, link with nothing.  Rows
    that repeat a key or a text are rows of their own; a null key is nobody's
    component id unless no member has a key.  An empty table gives no rows;
    other columns are not read.  Sets of distinct nodes are told apart by
    64-bit hashes."""
    sets = materialize(token_sets(docs, key, text, size), "sets")
    found = components(links(docs, sets, key, text, size, percent, orders, limit, class_tokens))
    rows = sets.where("chunk is null")
    full = rows.where("n > 0")
    least = materialize(full.groupBy("node").agg(F.min("k").alias("least"), F.count("*").alias("copies")), "least")
    chained = found.join(least, "node")
    lowest = chained.groupBy("root").agg(F.min("least").alias("lowest"))
    owner = chained.select("node", "root").join(lowest, "root").select("node", "lowest")
    named = least.join(owner, "node", "left").select("node", "copies", F.coalesce("lowest", "least").alias("component_id"))
    joined = join_hot(full.select("k", "n", "node"), named, "node", "copies").select("k", "n", "component_id")
    lone = rows.where("n = 0").select("k", "n", F.col("k").alias("component_id"))
    return joined.union(lone).select(F.col("k").alias(key), F.col("n").alias("n_shingles"), "component_id")
