"""Hour-granularity time functions over the behaviour log.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen and anchors fold to constants.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from basketry.schema import TIME_FORMAT

_HOUR = dt.timedelta(hours=1)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_anchor(value: dt.datetime | dt.date | str) -> dt.datetime:
    """Normalise an anchor (date, datetime or 'yyyy-MM-dd[ HH]' text) to a datetime."""
    if isinstance(value, str):
        value = dt.datetime.strptime(value, "%Y-%m-%d %H" if " " in value else "%Y-%m-%d")
    elif isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
    return value


def _instant(value: dt.datetime) -> Column:
    """The anchor as a timestamp in the session's zone.  Built from text: a
    naive datetime literal would be read in the zone of the driver's Python."""
    return F.lit(f"{value:%Y-%m-%d %H:%M:%S.%f}").cast("timestamp")


def parse_hour(text: Column | str) -> Column:
    """Parse 'yyyy-MM-dd HH' (hour 0-23) strictly; malformed text gives null."""
    return F.try_to_timestamp(_col(text), F.lit(TIME_FORMAT))


def hours_between(big: Column | str, small: Column | str) -> Column:
    """Whole hours from ``small`` to ``big``, truncated towards zero (bigint)."""
    return F.timestamp_diff("HOUR", _col(small), _col(big))


def hours_before(time: Column | str, anchor) -> Column:
    """Whole hours from ``time`` up to ``anchor`` as int (positive before it)."""
    return hours_between(_instant(hour_anchor(anchor)), time).cast("int")


def _ceil_hour(anchor: dt.datetime) -> dt.datetime:
    floor = anchor.replace(minute=0, second=0, microsecond=0)
    return floor if floor == anchor else floor + _HOUR


def scan_hints(df) -> dict:
    """Which helper columns of a behaviour frame the time filters can use:
    ``raw`` (the untruncated instant of the events adapter) and ``day`` (the
    partition column of a behaviour table)."""
    cols = set(df.columns)
    return {"raw": "ts" if "ts" in cols else None, "day": "day" if "day" in cols else None}


def strictly_before(anchor, time: str = "time", raw: str | None = None, day: str | None = None) -> Column:
    """``time < anchor`` with ``time`` truncated to the hour.

    When ``raw`` names the untruncated instant the hour was taken from, an
    equivalent predicate on it is added: ``trunc_hour(ts) < A`` holds exactly
    when ``ts < ceil_hour(A)``.  That one is a plain comparison on a scan
    column, so Parquet receives it as a pushed filter (row-group skipping).
    When ``day`` names a date partition column, the implied ``day <= date(A)``
    is added, so whole day partitions are pruned.
    """
    a = hour_anchor(anchor)
    cond = F.col(time) < _instant(a)
    if raw:
        cond = (F.col(raw) < _instant(_ceil_hour(a))) & cond
    if day:
        cond = (F.col(day) <= F.lit(a.date())) & cond
    return cond


def strictly_after(anchor, time: str = "time", raw: str | None = None, day: str | None = None) -> Column:
    """``time > anchor`` with ``time`` truncated to the hour.

    Equivalent raw-instant form: ``trunc_hour(ts) > A`` iff
    ``ts >= floor_hour(A) + 1h``; added for Parquet pushdown when ``raw`` is
    set.  With a ``day`` partition column the implied ``day >= date(A)`` is
    added for partition pruning.
    """
    a = hour_anchor(anchor)
    cond = F.col(time) > _instant(a)
    if raw:
        floor = a.replace(minute=0, second=0, microsecond=0)
        cond = (F.col(raw) >= _instant(floor + _HOUR)) & cond
    if day:
        cond = (F.col(day) >= F.lit(a.date())) & cond
    return cond


def hhmm_to_hour(value: Column | str) -> Column:
    """Number text 'HHmm' to hour: the first two characters of the number
    left-padded to width 4 (so '930' -> 9, '2315' -> 23, '12345' -> 12).
    Negative numbers keep their sign the way a '%04d' format does."""
    n = _col(value).try_cast("bigint")
    digits = F.abs(n).cast("string")
    positive = F.substring(F.lpad(digits, 4, "0"), 1, 2)
    negative = F.concat(F.lit("-"), F.substring(F.lpad(digits, 3, "0"), 1, 1))
    return F.when(n.isNull(), F.lit(None)).when(n < 0, negative).otherwise(positive).try_cast("int")


def format_rate(rate: Column | str, places: int = 4) -> Column:
    """Fixed-point text of a ratio, rounded half-up first (so 3/800 -> '0.0038')."""
    return F.format_string(f"%.{places}f", F.round(_col(rate), places))
