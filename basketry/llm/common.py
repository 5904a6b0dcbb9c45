"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: A word: a run of characters other than space and \t \n \v \f \r.
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of an Arrow batch between Spark and a worker (one row may be larger),
#: and text bytes handled at once inside a task.
BATCH_BYTES = 4 << 20
SLICE_BYTES = 1 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def col(name: str) -> Column:
    """Column by its exact name, also when the name holds dots."""
    return F.col("`" + name.replace("`", "``") + "`")


def map_batches(df: DataFrame, run: Callable, schema: str | StructType) -> DataFrame:
    """``df.mapInArrow(run, schema)`` with batches bounded in bytes.  By
    default a batch is bounded in rows alone, and ten thousand long texts are
    more than a worker should hold."""
    spark = df.sparkSession
    if int(spark.conf.get(_BATCH_CONF, str(2**31 - 1))) > BATCH_BYTES:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def release() -> None:
    """Give memory that is free again back to the system.  The C library
    keeps it for the process otherwise, and the workers of an executor live
    as long as the executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``limit`` bytes of
    ``text`` (at least one row), whatever the length of single texts.  Memory
    is given back after each batch."""
    for batch in batches:
        yield from _cut(batch, text, limit)
        del batch
        release()


def _cut(batch: pa.RecordBatch, text: str, limit: int) -> Iterator[pa.RecordBatch]:
    column = batch.column(batch.schema.get_field_index(text))
    if batch.num_rows <= 1 or column.nbytes <= limit:
        if batch.num_rows:
            yield batch
        return
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    start = taken = 0
    for i, n in enumerate(sizes):
        if i > start and taken + n > limit:
            yield batch.slice(start, i - start)
            start, taken = i, 0
        taken += n
    yield batch.slice(start)


def text_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null counts as empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


#: Keys with more than one in so many of all rows count as hot.
HOT_SHARE = 1000


def join_hot(rows: DataFrame, facts: DataFrame, key: str, copies: str) -> DataFrame:
    """``rows`` joined with the one row that ``facts`` has for their ``key``
    (never null), where ``copies`` says how many rows have it.  Keys that hold
    more than a thousandth of all rows are at most a thousand, so their facts
    are broadcast and their rows stay where they are; only the others meet by
    a shuffle.  ``copies`` is dropped; ``rows`` is read twice."""
    total = facts.agg(F.sum(copies).alias("n")).first()["n"] or 0
    hot = facts.where(F.col(copies) * HOT_SHARE > total)
    rest = facts.where(F.col(copies) * HOT_SHARE <= total).drop(copies)
    few = F.broadcast(hot.select(key))
    return rows.join(F.broadcast(hot.drop(copies)), key).unionByName(rows.join(few, key, "left_anti").join(rest, key))
