"""Cart conversion curve.

For every (user, item) pair carted strictly before the anchor, take the hours
between its latest cart and the anchor; per hour, the share of those pairs
bought strictly after the anchor.  Hours where no pair converted are absent
(the curve only lists hours with at least one conversion).

Plan: one scan, one filter, one shuffle on the pair key with map-side
partial aggregation (a hot pair collapses to one row per map task before the
exchange), then a tiny hour-level aggregation (at most one key per hour of
the log window) and the final sort.  There is no join: whether a carted pair
was bought is a conditional aggregate of the same group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.timefn import scan_hints, format_rate, hours_before, strictly_after, strictly_before
from basketry.schema import ADD_TO_CART, BUY, DAY30
from basketry.sources.behaviour import has_code

KEYS = ["user_id", "item_id"]


def last_cart_hours(beh: DataFrame, anchor=DAY30) -> DataFrame:
    """(user_id, item_id, hour): hours from each pair's latest cart before the
    anchor up to the anchor.  "Latest" is by time, so the result does not
    depend on input order."""
    hints = scan_hints(beh)
    carts = beh.where(has_code(beh, ADD_TO_CART) & strictly_before(anchor, **hints))
    return carts.groupBy(*KEYS).agg(F.max("time").alias("last_cart")).select(*KEYS, hours_before("last_cart", anchor).alias("hour"))


def buyers_after(beh: DataFrame, anchor=DAY30) -> DataFrame:
    """Distinct pairs bought strictly after the anchor."""
    hints = scan_hints(beh)
    return beh.where(has_code(beh, BUY) & strictly_after(anchor, **hints)).select(*KEYS).distinct()


def conversion_curve(beh: DataFrame, anchor=DAY30, sort: bool = True) -> DataFrame:
    """(hour int, bought bigint, carted bigint, rate double, rate_text string)."""
    hints = scan_hints(beh)
    is_cart = has_code(beh, ADD_TO_CART) & strictly_before(anchor, **hints)
    is_buy = has_code(beh, BUY) & strictly_after(anchor, **hints)
    pairs = (
        beh.where(has_code(beh, ADD_TO_CART, BUY) & (is_cart | is_buy))
        .groupBy(*KEYS)
        .agg(F.max(F.when(is_cart, F.col("time"))).alias("last_cart"), F.bool_or(is_buy).alias("bought"))
        .where(F.col("last_cart").isNotNull())
    )
    curve = (
        pairs.groupBy(hours_before("last_cart", anchor).alias("hour"))
        .agg(F.count_if(F.col("bought")).alias("bought"), F.count(F.lit(1)).alias("carted"))
        .where(F.col("bought") > 0)
        .select(
            "hour",
            "bought",
            "carted",
            F.round(F.col("bought") / F.col("carted"), 4).alias("rate"),
            format_rate(F.col("bought") / F.col("carted")).alias("rate_text"),
        )
    )
    return curve.orderBy("hour") if sort else curve
