"""Recent-cart candidate lists: distinct pairs carted strictly after an anchor.

With the ``events`` adapter the time bound becomes a pushed Parquet filter on
the raw instant, so only the row groups of the last day (or hour) are read;
the distinct is a partial + final hash aggregate on the pair key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from basketry.functions.timefn import scan_hints, strictly_after
from basketry.schema import ADD_TO_CART, DAY30, LAST_HOUR
from basketry.sources.behaviour import has_code

KEYS = ["user_id", "item_id"]


def carted_after(beh: DataFrame, anchor) -> DataFrame:
    hints = scan_hints(beh)
    return beh.where(has_code(beh, ADD_TO_CART) & strictly_after(anchor, **hints)).select(*KEYS).distinct()


def last_day_cart_pairs(beh: DataFrame, day_anchor=DAY30) -> DataFrame:
    return carted_after(beh, day_anchor)


def last_hour_cart_pairs(beh: DataFrame, hour_anchor=LAST_HOUR) -> DataFrame:
    return carted_after(beh, hour_anchor)
