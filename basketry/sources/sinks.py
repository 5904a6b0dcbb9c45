"""Sinks: CSV directories, a JSON series export and ordered previews.

Results are written by the executors straight from the plan; nothing is
collected to the driver first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", header: bool = False) -> None:
    """CSV directory, no header by default; ``errorifexists`` refuses to overwrite."""
    df.write.mode(mode).option("header", header).csv(path)


def json_series(df: DataFrame, key: str, value: str, out: str = "json") -> DataFrame:
    """One row holding ``[[k,v],[k,v],...]`` ordered by ``key``; ``[]`` if empty.

    Numbers stay unquoted.  Meant for result series whose size is bounded by
    construction (the conversion curve has at most one row per hour of the
    log window), since the series becomes one value.
    """
    pair = F.concat(F.lit("["), F.col(key).cast("string"), F.lit(","), F.col(value).cast("string"), F.lit("]"))
    items = F.array_sort(F.collect_list(F.struct(F.col(key).alias("k"), pair.alias("p"))))
    body = F.array_join(F.transform(items, lambda s: s["p"]), ",")
    return df.agg(F.concat(F.lit("["), F.coalesce(body, F.lit("")), F.lit("]")).alias(out))


def preview(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """First ``n`` rows under an explicit order (top-k per partition, then merge)."""
    return df.orderBy(*order).limit(n)
