"""Data model: behaviour codes, anchors and schemas.

Behaviour log row: (user_id bigint, item_id bigint, behavior_type int,
time timestamp truncated to the hour).  Times are hour granularity and the
session zone is UTC.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

# Behaviour codes of the log format.
VIEW = 1
COLLECT = 2
ADD_TO_CART = 3
BUY = 4
BEHAVIOUR_NAMES = {VIEW: "view", COLLECT: "collect", ADD_TO_CART: "cart", BUY: "buy"}

# Fixed value: the text time format of the log, hour 0-23.
TIME_FORMAT = "yyyy-MM-dd HH"

# Stand-in mapping from the driver's `events` table to behaviour codes
# (view 1, click 2, signup 3, purchase 4; other event types are dropped).
EVENT_TYPE_CODES = {"view": VIEW, "click": COLLECT, "signup": ADD_TO_CART, "purchase": BUY}

# Anchors for the driver's 30-day log (2024-01-01 .. 2024-01-30).
DAY30 = dt.datetime(2024, 1, 30, 0, 0, 0)
DAY31 = dt.datetime(2024, 1, 31, 0, 0, 0)
LAST_HOUR = dt.datetime(2024, 1, 30, 22, 0, 0)

# Six text columns of the behaviour CSV; positions of behavior_type (2) and
# time (5) are fixed by the log format.
CSV_COLUMNS = ["user_id", "item_id", "behavior_type", "user_geohash", "item_category", "time"]
CSV_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in CSV_COLUMNS])

BEHAVIOUR_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType(), False),
        T.StructField("item_id", T.LongType(), False),
        T.StructField("behavior_type", T.IntegerType(), False),
        T.StructField("time", T.TimestampType(), False),
    ]
)

# Feature columns in model order.
FEATURE_COLUMNS = ["time1", "type_1count", "time2", "type_2count", "time3", "type_3count", "type_4count"]
