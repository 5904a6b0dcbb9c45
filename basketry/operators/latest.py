"""The latest values of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(rows: DataFrame, keys: Sequence[str], time: str, values: Sequence[str], tie_break: Sequence[str] = ()) -> DataFrame:
    """(*keys, time, *values): of each key the row with the greatest
    (time, *tie_break, *values).

    The order is total over what is returned, so the result depends neither on
    the order of the input nor on its partitions; equal rows are one.  A null
    time (or tie-break, or value) comes before any other.  Null keys are a key
    of their own.  One aggregation with map-side combine: a hot key reaches its
    reducer as one row per task."""
    place = F.struct(*[F.col(c) for c in (time, *tie_break, *values)])
    return rows.groupBy(*keys).agg(F.max(place).alias("__latest")).select(*keys, *[F.col("__latest").getField(c).alias(c) for c in (time, *values)])
