"""A semi-join filter of fixed size: rows whose key may be among given keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the filter: 1 MB, in at most 256 pieces of 4 KB.
FILTER_BITS = 1 << 23


def may_be_among(rows: DataFrame, keys: DataFrame, column: str, bits: int = FILTER_BITS) -> DataFrame:
    """``rows`` without most of those whose ``column`` is not in ``keys``; none
    that is in there goes (null keys go).

    The keys' hashes set bits of a bitmap that does not grow with them, so it
    is broadcast whatever their number and rows are dropped where they are
    read; with far more keys than bits it lets everything pass.  A join must
    follow: this only keeps what cannot match out of its shuffle."""
    hashed = F.when(F.col(column).isNotNull(), F.pmod(F.xxhash64(F.col(column).cast("string")), F.lit(bits)) + 1)
    piece, place = F.bitmap_bucket_number("__at"), F.bitmap_bit_position("__at")
    bitmap = (
        keys.select(hashed.alias("__at"))
        .where(F.col("__at").isNotNull())
        .groupBy(piece.alias("__piece"))
        .agg(F.bitmap_construct_agg(place).alias("__bits"))
    )
    byte = F.conv(F.hex(F.substr(F.col("__bits"), (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    bit: Column = F.call_function("shiftright", byte, F.pmod(place, F.lit(8)).cast("int")).bitwiseAND(F.lit(1))
    return rows.withColumn("__at", hashed).join(F.broadcast(bitmap), (piece == F.col("__piece")) & (bit == 1), "left_semi").drop("__at")
