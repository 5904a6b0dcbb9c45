"""Token-id files: documents as compressed ids, and back.

Documents are sorted by key over range partitions; each task encodes its part
and writes it in segments of whole documents.  A row of the (Parquet) file is
one segment: the keys and lengths of its documents, and its ids as
independently coded, checksummed blocks (see ``idcoder``).  Spark's writer
commits whole files, so a lost or repeated task leaves no trace.  Reading
needs nothing but the rows: any task decodes any segment.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketry.llm.common import map_batches, release, slices
from basketry.llm.idcoder import BLOCK_IDS, decode_blocks, encode_blocks
from basketry.llm.tokens import encoder

END_ID = 2
#: A segment is closed from so many ids on: 2048 blocks, side by side.
SEGMENT_IDS = 2048 * BLOCK_IDS


def write_ids(docs: DataFrame, path: str, vocabulary: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID, spaces: str = "lead", segment_ids: int = SEGMENT_IDS, block: int = BLOCK_IDS) -> None:
    """Write the ids of every text of ``docs``, each followed by ``end_id``, in
    ascending order of the key to the folder ``path``.

    Null texts have the end id alone.  Null keys come first; documents of
    equal keys are in the order of a hash of their text; an empty table gives
    a file without segments.  A text is never split over segments, so the
    longest one bounds a segment from below."""
    ordered = (
        docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
        .repartitionByRange("k")
        .sortWithinPartitions("k", F.xxhash64("t"))
    )
    kind = docs.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        made, first = 0, 0
        keys: list[pa.Array] = []
        parts: list[np.ndarray] = []
        sizes: list[np.ndarray] = []

        def segment() -> pa.RecordBatch:
            nonlocal made, first
            ids, lengths = np.concatenate(parts), np.concatenate(sizes)
            names = pa.concat_arrays(keys)
            row = [
                pa.array([shard], pa.int32()),
                pa.array([made], pa.int32()),
                pa.array([first], pa.int64()),
                pa.array([ids.size], pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names),
                pa.array([lengths], pa.list_(pa.int64())),
                pa.array([encode_blocks(ids, block)], pa.list_(pa.binary())),
            ]
            made, first = made + 1, first + ids.size
            for held in (keys, parts, sizes):
                held.clear()
            return pa.RecordBatch.from_arrays(row, ["shard", "segment", "first", "n_ids", "keys", "lengths", "blocks"])

        for b in slices(batches, "t"):
            ids, bounds = encoder(vocabulary, spaces).encode(b.column(1))
            lengths = np.diff(bounds) + 1
            with_end = np.full(ids.size + lengths.size, end_id, np.uint32)
            keep = np.ones(with_end.size, bool)
            keep[np.cumsum(lengths) - 1] = False
            with_end[keep] = ids
            at = 0
            while at < b.num_rows:
                have = sum(p.size for p in parts)
                ends = np.cumsum(lengths[at:])
                take = min(b.num_rows - at, int(np.searchsorted(ends, segment_ids - have)) + 1)
                start = int(lengths[:at].sum())
                keys.append(b.column(0).slice(at, take))
                sizes.append(lengths[at : at + take])
                parts.append(with_end[start : start + int(ends[take - 1])])
                at += take
                if sum(p.size for p in parts) >= segment_ids:
                    yield segment()
        if parts:
            yield segment()

    schema = f"shard int, segment int, first long, n_ids long, keys array<{kind.simpleString()}>, lengths array<long>, blocks array<binary>"
    map_batches(ordered, run, schema).write.parquet(path)


def _starts(files: DataFrame) -> DataFrame:
    """(shard, base): ids of all shards before.  One row a shard."""
    totals = files.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def _read(spark: SparkSession, path: str, key: str, extra: str, fields: list[tuple[str, pa.DataType]], of: Callable[[np.ndarray], tuple]) -> DataFrame:
    """(key, start, n_tokens, what ``of`` makes of a document's ids)."""
    files = spark.read.parquet(path)
    kind = files.schema["keys"].dataType.elementType.simpleString()
    based = files.join(_starts(files.select("shard", "n_ids")), "shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                b = batch.slice(i, 1)
                ids = np.concatenate([np.zeros(0, np.uint32), *decode_blocks(b.column(4)[0].as_py())])
                lengths = b.column(3).flatten().to_numpy(zero_copy_only=False)
                ends = np.cumsum(lengths)
                rows = [of(ids[a:z]) for a, z in zip((ends - lengths).tolist(), ends.tolist())]
                start = ends - lengths + (b.column(0)[0].as_py() + b.column(1)[0].as_py())
                columns = [b.column(2).flatten(), pa.array(start, pa.int64()), pa.array(lengths, pa.int64())]
                columns += [pa.array(c, t) for c, (_, t) in zip(zip(*rows), fields)]
                yield pa.RecordBatch.from_arrays(columns, ["k", "start", "n_tokens", *(n for n, _ in fields)])
                del b, ids, rows, columns
                release()

    return based.select("base", "first", "keys", "lengths", "blocks").mapInArrow(run, f"k {kind}, start long, n_tokens long, {extra}").withColumnRenamed("k", key)


def read_ids(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids array<int>) of every document in the folder;
    ``start`` counts the ids of all documents before it."""
    return _read(spark, path, key, "ids array<int>", [("ids", pa.list_(pa.int32()))], lambda ids: (ids.astype(np.int32),))


def read_checksums(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32): as ``read_ids``, but only the CRC-32
    of the decoded ids as little-endian unsigned 32-bit integers."""
    return _read(spark, path, key, "ids_crc32 long", [("ids_crc32", pa.int64())], lambda ids: (zlib.crc32(ids.astype("<u4")),))
