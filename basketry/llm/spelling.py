"""Spelling variants: words that are one edit apart, and the usual form.

1. :func:`word_counts`: the words of all texts and how often they occur.
   Counts are summed per task before they are shuffled.
2. Tiles.  A word of L code points is cut into segments of ``SEGMENT``.  Two
   words that differ by one edit at place p agree before and after the segment
   of the shorter one that holds p.  So each word goes, per segment, to the
   tile named by what surrounds it, once as the shorter (or equally long) word
   and once as the longer one.  With p the length of the common prefix, a pair
   meets in exactly one tile that counts it.  A tile's words differ in at most
   three code points, so its size is bounded by the alphabet and not by the
   corpus.
3. :func:`edit_pairs`: inside a tile padded code-point matrices are compared
   block against block.  The lengths of the common prefix and of the common
   suffix come from whole columns; where together they reach the longer length
   minus one, the pair is a single edit.
4. Per word the near word of largest count, and its form; roots by following
   forms with pointer jumping (a form has at least ``RATIO`` times the count of
   its variant, so chains are short).
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import col, map_batches, slices
from basketry.session import materialize

#: Maximal runs of these are words; shorter ones never count.
LETTERS = "A-Za-zÀ-ÿ"
LEAST_LENGTH = 7
LEAST_COUNT = 2
RATIO = 10
#: One in so many runs has a code point deleted.
NOISE = 31
#: Code points of a segment.
SEGMENT = 2
#: Rows of a block of a tile.
BLOCK = 512
#: Distinct words that a task gathers before it gives out their counts.
_HELD = 200_000
#: Pairs compared at once.
_PAIRS = 1 << 16
#: Tiles of up to so many rows are compared side by side.
_SIDE_BY_SIDE = 64


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_LENGTH, noise: int = NOISE) -> DataFrame:
    """(word, n long) of all words of at least ``least`` code points.

    A word is a maximal run of letters (Latin-1), A-Z in lower case.  Let h be
    the CRC-32 of "<key>:<run>"; where ``noise`` divides h, code point
    h % length of the run is deleted (0: never).  Null texts have no words; a
    null key counts as the empty string."""
    found = re.compile(f"[{LETTERS}]{{{least},}}")

    def words(key_: object, text_: bytes) -> Iterator[tuple[str, int]]:
        start = zlib.crc32(b"" if key_ is None else str(key_).encode()) if noise else 0
        start = zlib.crc32(b":", start)
        for run, n in Counter(found.findall(text_.lower().decode())).items():
            if noise and (h := zlib.crc32(run.encode(), start)) % noise == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
                if len(run) < least:
                    continue
            yield run, n

    def batch(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for b in slices(batches, "t"):
            for key_, text_ in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if text_:
                    for w, n in words(key_, text_):
                        held[w] += n
            if len(held) >= _HELD:
                yield batch(held)
                held.clear()
        yield batch(held)

    slim = docs.select(col(key).alias("k"), col(text).cast("string").cast("binary").alias("t"))
    return map_batches(slim, run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def tiles(words: DataFrame, least: int = LEAST_LENGTH, segment: int = SEGMENT) -> DataFrame:
    """(tile, base, at, word, n): each word in its tiles.  ``base`` is the
    shorter words' length, ``at`` where the tile's segment begins."""
    length = F.length("word")

    def cut(base: Column) -> Column:
        at = F.sequence(F.lit(0), base - 1, F.lit(segment))
        return F.transform(at, lambda a: F.struct(base.alias("base"), a.alias("at")))

    here = F.explode(F.concat(cut(length), F.when(length > least, cut(length - 1)).otherwise(F.array().cast("array<struct<base:int,at:int>>"))))
    rest = F.greatest(F.col("base") - F.col("at") - segment, F.lit(0))
    around = F.xxhash64("base", "at", F.substr("word", F.lit(1), F.col("at")), F.when(rest > 0, F.substr("word", length - rest + 1, rest)).otherwise(""))
    return words.select("word", "n", here.alias("c")).select("word", "n", "c.*").select(around.alias("tile"), "base", "at", "word", "n")


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(matrix of code points, zeros on the right; lengths)."""
    size = np.array([len(w) for w in words], np.int64)
    width = int(size.max(initial=0))
    out = np.zeros((len(words), width), np.uint32)
    out[np.arange(width) < size[:, None]] = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    return out, size


def single_edits(a: np.ndarray, la: np.ndarray, b: np.ndarray, lb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether row i of ``a`` and row i of ``b`` are one edit apart, length
    of their common prefix), the lengths at most one apart, none empty."""
    width = a.shape[1]
    shorter, longer = np.minimum(la, lb), np.maximum(la, lb)
    same = a == b
    same &= np.arange(width) < shorter[:, None]
    prefix = np.where(same.all(axis=1), width, same.argmin(axis=1))
    # the suffix: columns counted from each word's own end
    back = np.arange(1, width + 1)
    rows = np.arange(len(a))[:, None]
    equal = a[rows, np.maximum(la[:, None] - back, 0)] == b[rows, np.maximum(lb[:, None] - back, 0)]
    equal &= back <= shorter[:, None]
    suffix = np.where(equal.all(axis=1), width, equal.argmin(axis=1))
    return (prefix + suffix >= longer - 1) & ((prefix < longer) | (la != lb)), prefix


def edit_pairs(words: list[str], tile: np.ndarray, base: np.ndarray, at: np.ndarray, segment: int = SEGMENT, block: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of rows of whole tiles, rows sorted by tile, that are one
    edit apart and counted there.  In a tile its shorter words are compared
    with each other and with the longer ones: small tiles side by side, each
    row with the one d further down, larger ones block against block."""
    if len(words) < 2:
        return
    matrix, size = code_points(words)
    cuts = np.flatnonzero(np.concatenate(([True], tile[1:] != tile[:-1], [True])))
    sizes = np.diff(cuts)
    long = size > base

    def compare(i: np.ndarray, j: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        swap = long[i]
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        keep = ~long[i]
        i, j = i[keep], j[keep]
        for s in range(0, i.size, _PAIRS):
            a, b = i[s : s + _PAIRS], j[s : s + _PAIRS]
            near, prefix = single_edits(matrix[a], size[a], matrix[b], size[b])
            near &= (prefix >= at[a]) & ((at[a] + segment >= base[a]) | (prefix < at[a] + segment))
            yield a[near], b[near]

    end = np.repeat(cuts[1:], sizes)
    rows = np.flatnonzero(np.repeat(sizes <= _SIDE_BY_SIDE, sizes))
    for d in range(1, _SIDE_BY_SIDE):
        rows = rows[rows + d < end[rows]]
        if not rows.size:
            break
        yield from compare(rows, rows + d)
    for k in np.flatnonzero(sizes > _SIDE_BY_SIDE).tolist():
        own = np.arange(cuts[k], cuts[k + 1])
        short, longer = own[~long[own]], own[long[own]]
        for s in range(0, short.size, block):
            left = short[s : s + block]
            for other in (short[s:], longer):
                for t in range(0, other.size, block):
                    right = other[t : t + block]
                    i, j = np.repeat(left, right.size), np.tile(right, left.size)
                    keep = (i < j) | long[j]
                    yield from compare(i[keep], j[keep])


def near_words(words: DataFrame, least: int = LEAST_LENGTH) -> DataFrame:
    """(word, other, n): both directions of every pair of ``words`` (distinct,
    with counts n) that are one edit apart; n is the other's."""
    sorted_ = tiles(words, least).repartition("tile").sortWithinPartitions("tile", "base", "at")

    def pairs(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        tile, base, at = (b.column(i).to_numpy() for i in range(3))
        for i, j in edit_pairs(b.column(3).to_pylist(), tile, base, at):
            both = pa.array(np.concatenate((i, j))), pa.array(np.concatenate((j, i)))
            yield pa.RecordBatch.from_arrays([b.column(3).take(both[0]), b.column(3).take(both[1]), b.column(4).take(both[1])], ["word", "other", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            tile = b.column(0).to_numpy()
            cut = int(np.searchsorted(tile, tile[-1])) if b.num_rows else 0
            if not cut:  # all of one tile, as far as seen
                if b.num_rows:
                    if held and held[-1].column(0)[-1].as_py() != tile[0]:
                        yield from pairs(_one(held))
                        held.clear()
                    held.append(b)
                continue
            yield from pairs(_one([*held, b.slice(0, cut)]))
            held = [b.slice(cut)]
        if held:
            yield from pairs(_one(held))

    return map_batches(sorted_, run, "word string, other string, n long")


def _one(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0] if len(batches) > 1 else batches[0]


def follow(forms: DataFrame) -> DataFrame:
    """(word, root) of the rows (word, form): the last form that following
    forms leads to, by pointer jumping; forms must not lead in a circle."""
    steps = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        jumped = materialize(steps.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "roots")
        if jumped.where("moved").isEmpty():
            return jumped.select("word", "root")
        steps = jumped.select("word", "root")


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, ratio: int = RATIO, noise: int = NOISE) -> DataFrame:
    """(word, form, root, n, n_near, form_n), a row per distinct word of at
    least ``least`` code points and ``least_count`` occurrences.

    Near words differ by exactly one inserted, deleted or replaced code point;
    ``n_near`` counts them.  ``form`` is the near word of largest n (ties:
    smallest in code-point order) if that n is at least ``ratio`` * the word's
    own, else null; ``root`` the last form that following forms leads to, the
    word itself if none.  Words come from :func:`word_counts`; rows that repeat
    count again, an empty table gives no rows, other columns are not read."""
    words = materialize(word_counts(docs, key, text, least, noise).where(F.col("n") >= least_count), "words")
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("other").alias("form")))
    near = near_words(words, least).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    usual = -F.col("best.less") >= ratio * F.col("n")
    found = materialize(
        words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(usual, F.col("best.form")).alias("form"), F.when(usual, -F.col("best.less")).alias("form_n")),
        "forms",
    )
    roots = follow(found.where("form is not null").select("word", "form"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
