"""Mixing sources to target weights by systematic sampling.

DataFrame functions only.  Every document of a source is expected
``target / source_size`` times.  Documents are put in a fixed order within
their source, the expected copies are prefix-summed, one random offset per
source is added, and a document is emitted once per integer boundary its
stretch crosses.  So a document comes floor or ceil of the expected copies,
and a rerun takes the same ones.

Documents are ordered by size class first, so every stretch of sizes is
sampled evenly and a source's words come near its target.  The prefix sum has
two levels, because one source may hold a third of all rows: rows are counted
per block (source, size class, hash of the key), the few block counts are
summed up within each source, and only a block's rows are sorted together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import WORD, col

WEIGHTS = (5, 2, 1)
#: A source's target is at most so many times its size.
MAX_REPEATS = 3
#: Hex digits of the key's MD5 that split a size class: 256 blocks.
BLOCK_DIGITS = 2
#: Expected copies are fractions of 2^24, so sums of them are exact integers.
UNIT = 1 << 24


def word_count(text: str = "text") -> Column:
    """Words in the text, null text: 0."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def size_class(size: Column) -> Column:
    """Digits of the size and its first two digits: at most 90 classes for
    each power of ten, in ascending order of size."""
    digits = size.cast("string")
    return (F.length(digits) * 100 + F.substring(digits, 1, 2).cast("int")).cast("int")


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``sizes``, one row per source with ``source`` and ``source_size``, plus
    ``target`` double.

    Sources in code-point order, null last, take the weights in turn and share
    the sum of all sizes.  With cap = max_repeats * source_size, the shares
    are min(cap, level * weight): sources are filled up in the order of
    cap / weight, and the level is what is left over for the others."""
    name = [F.col("source").isNull(), F.col("source")]
    number = F.row_number().over(Window.orderBy(*name)) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (number % len(weights) + 1).cast("int"))
    caps = sizes.withColumns({"__w": weight, "__cap": (F.col("source_size") * max_repeats).cast("double")})
    everything = Window.partitionBy()
    before = Window.orderBy(F.col("__cap") / F.col("__w"), *name).rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("__cap").over(before), F.lit(0.0))
    level = left / (F.sum("__w").over(everything) - F.coalesce(F.sum("__w").over(before), F.lit(0.0)))
    # Full: the level of this source and all after it would exceed its cap.
    # The first that is not full has the level that holds for the rest.
    levelled = caps.withColumn("__level", level).withColumn("__full", F.col("__cap") <= F.col("__level") * F.col("__w"))
    rest = F.max(F.when(~F.col("__full"), F.col("__level"))).over(everything)
    target = F.when(F.col("__full"), F.col("__cap")).otherwise(rest * F.col("__w"))
    return levelled.withColumn("target", target).drop("__w", "__cap", "__level", "__full")


def mix_counts(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    seed: int = 0,
    size: Column | None = None,
) -> DataFrame:
    """All rows of ``docs`` as a struct ``row`` with size, source_size, target
    and copies (int).

    ``size`` is the number of words unless given (a long that is never null).
    Null sources form one source; null keys are in one block of their size
    class; a source without words has target 0 and no copies; repeated rows
    are documents of their own; an empty table gives no rows."""
    rows = docs.select(
        F.struct(*[col(c) for c in docs.columns]).alias("row"),
        F.when(F.col(source).isNull(), "-").otherwise(F.concat(F.lit("+"), F.col(source).cast("string"))).alias("s"),
        F.col(key).cast("string").alias("key"),
        (word_count(text) if size is None else size).alias("size"),
    )
    rows = rows.withColumns({"c": size_class(F.col("size")), "p": F.substring(F.md5(F.coalesce("key", F.lit(""))), 1, BLOCK_DIGITS)})
    blocks = rows.groupBy("s", "c", "p").agg(F.count("*").alias("rows"), F.sum("size").alias("words"))
    sizes = blocks.groupBy("s").agg(F.sum("words").alias("source_size"))
    goal = targets(sizes.withColumn("source", F.when(F.col("s") != "-", F.substring("s", 2, 1 << 30))), weights, max_repeats)
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    goal = goal.select(
        "s",
        "source_size",
        "target",
        F.floor(copies).cast("long").alias("whole"),
        F.round((copies - F.floor(copies)) * UNIT).cast("long").alias("part"),
        # 24 random bits: the offset in [0, 1)
        F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), "s")), 1, 6), 16, 10).cast("long").alias("offset"),
    )
    earlier = Window.partitionBy("s").orderBy("c", "p").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("s", "c", "p", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("ahead")).join(goal, "s")
    within = Window.partitionBy("s", "c", "p").orderBy("size", F.length("key"), "key")
    placed = rows.join(starts, ["s", "c", "p"]).withColumn("rank", F.col("ahead") + F.row_number().over(within))
    crossed = lambda rank: F.shiftright(F.col("offset") + rank * F.col("part"), 24)
    taken = F.col("whole") + crossed(F.col("rank")) - crossed(F.col("rank") - 1)
    return placed.select("row", "size", "source_size", "target", taken.cast("int").alias("copies"))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: int = 0) -> DataFrame:
    """The mixed corpus: each document as often as it is taken, columns as in
    ``docs``."""
    counted = mix_counts(docs, key, text, source, weights, max_repeats, seed).where("copies > 0")
    return counted.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row.*")
