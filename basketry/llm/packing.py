"""Packing documents into training sequences by bounded-space best-fit.

A task keeps a fixed number of open sequences in a bitset keyed by free space.
A piece goes to the open sequence it fills best; if it fits nowhere and all
places are taken, the fullest sequence closes and a new one opens.  The place
of a piece is known at once, so rows stream out in constant memory, and each
input partition packs on its own: no shuffle, no group, no task that sees all
rows.  Only a partition's last open sequences stay partly empty.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import map_batches, slices
from basketry.llm.tokens import encoder

CAPACITY = 2048
OPEN_SEQUENCES = 512
END_ID = 0


class OpenBins:
    """At most ``most`` open bins of ``capacity``; bit f of ``free`` is set if
    an open bin has exactly f places left."""

    def __init__(self, capacity: int = CAPACITY, most: int = OPEN_SEQUENCES):
        self.capacity, self.most = capacity, most
        self.free = 0
        self.bins: dict[int, list[int]] = {}
        self.open = self.made = 0

    def _take(self, space: int) -> int:
        same = self.bins[space]
        number = same.pop()
        if not same:
            self.free ^= 1 << space
        self.open -= 1
        return number

    def place(self, size: int) -> tuple[int, int]:
        """(bin number, offset) for a piece of 1 to ``capacity`` places."""
        fits = self.free >> size
        if fits:
            space = size + (fits & -fits).bit_length() - 1
            number = self._take(space)
        else:
            if self.open == self.most:  # the fullest closes
                self._take((self.free & -self.free).bit_length() - 1)
            space, number = self.capacity, self.made
            self.made += 1
        left = space - size
        if left:
            self.bins.setdefault(left, []).append(number)
            self.free |= 1 << left
            self.open += 1
        return number, self.capacity - space


def pack(
    docs: DataFrame,
    vocabulary: str,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    open_sequences: int = OPEN_SEQUENCES,
    end_id: int = END_ID,
    spaces: str = "drop",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: (key, piece int, start long, length long, ids_crc32
    long, sequence_id long, offset long[, ids array<int>]).

    A document's ids are those of its text (null: none) and ``end_id``; only a
    document of more than ``capacity`` ids is cut, into full pieces and a
    rest.  Null keys stay null, repeated rows are documents of their own, an
    empty table gives no rows; other columns of ``docs`` are not read.
    ``spaces`` says how the vocabulary treats white space (see ``tokens``)."""
    slim = docs.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(capacity, open_sequences)
        first = TaskContext.get().partitionId() << 40
        for b in slices(batches, "t"):
            ids, bounds = encoder(vocabulary, spaces).encode(b.column(1))
            rows: list[tuple] = []
            pieces: list[np.ndarray] = []
            for i, (lo, hi) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                own = np.append(ids[lo:hi], np.uint32(end_id)).astype("<u4")
                for n, start in enumerate(range(0, own.size, capacity)):
                    piece = own[start : start + capacity]
                    number, offset = bins.place(piece.size)
                    rows.append((i, n, start, piece.size, zlib.crc32(piece), first + number, offset))
                    if with_ids:
                        pieces.append(piece)
            at, *rest = map(list, zip(*rows))
            columns = [b.column(0).take(pa.array(at)), pa.array(rest[0], pa.int32()), *(pa.array(c, pa.int64()) for c in rest[1:])]
            names = ["k", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
            if with_ids:
                columns.append(pa.array([p.astype(np.int32) for p in pieces], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"k {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long" + (", ids array<int>" if with_ids else "")
    return map_batches(slim, run, schema).withColumnRenamed("k", key)


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids array<int>, n_pieces) from the pieces of
    ``pack(..., with_ids=True)``: the training rows.  A group holds one
    sequence, so at most ``capacity`` ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"), F.count("*").alias("n_pieces"))
