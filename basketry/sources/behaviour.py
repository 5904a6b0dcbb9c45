"""Behaviour log sources.

Two ways in, one typed shape out (``schema.BEHAVIOUR_SCHEMA``):

* the six-column text CSV of the log format (``read_behaviour_csv``), typed
  with ``try_cast`` / strict hour parsing; malformed rows are rejected and
  can be counted with ``rejected_rows``;
* the driver's ``events`` Parquet table (``behaviour_from_events``).  The
  adapter also keeps the raw instant as ``ts`` so hour-aligned time filters
  reach the Parquet scan as pushed filters (see ``functions.timefn``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from basketry.functions.timefn import parse_hour
from basketry.schema import CSV_COLUMNS, CSV_SCHEMA, EVENT_TYPE_CODES

KEYS = ["user_id", "item_id"]


def has_code(beh: DataFrame, *codes: int) -> Column:
    """``behavior_type`` is one of ``codes``.  On the events adapter the same
    condition on ``event_type`` is added: a plain comparison on a scan column,
    so Parquet receives it as a pushed filter."""
    is_one = lambda c, values: F.col(c) == values[0] if len(values) == 1 else F.col(c).isin(values)
    cond = is_one("behavior_type", list(codes))
    if "event_type" in beh.columns:
        cond = is_one("event_type", [name for name, code in EVENT_TYPE_CODES.items() if code in codes]) & cond
    return cond


def _event_code(event_type: Column) -> Column:
    code = None
    for name, value in EVENT_TYPE_CODES.items():
        code = (F.when if code is None else code.when)(event_type == name, F.lit(value))
    return code


# Fixed value: the canonical text of a props object holding only the item
# key, up to its integer value, as the event log writes it ('{"k": 69}').
_CANONICAL_PREFIX = '{"k": '


def item_from_props(props: Column) -> Column:
    """Integer ``$.k`` of a JSON props object, exactly as
    ``try_cast(get_json_object(props, '$.k') as bigint)``.

    JSON parsing costs about five times a plain scan of the column, so the
    canonical shape is read with string functions: text that starts with
    the prefix, ends with '}', and whose middle round-trips exactly through
    a bigint cast (no sign, space or leading zero) is that integer.  Every
    other text -- other keys, nesting, spacing, strings, decimals -- goes
    through the JSON parser, so the result is identical for any input.
    """
    start = len(_CANONICAL_PREFIX) + 1
    inner = F.substring(props, F.lit(start), F.length(props) - start)
    number = inner.try_cast("bigint")
    canonical = F.startswith(props, F.lit(_CANONICAL_PREFIX)) & F.endswith(props, F.lit("}")) & (number.cast("string") == inner)
    return F.when(canonical, number).otherwise(F.get_json_object(props, "$.k").try_cast("bigint"))


def behaviour_from_events(events: DataFrame) -> DataFrame:
    """``events`` -> (user_id, item_id, behavior_type, time, ts, event_type).

    item_id is the integer ``$.k`` of ``props``; event types outside the four
    behaviours are dropped; ``time`` is the instant truncated to the hour.
    """
    # The item id is produced by a one-element explode: a generator boundary,
    # so the null check below filters the computed column.  As a plain
    # projection, the optimiser would push the check under it and extract
    # the id twice per row (once to filter, once to project).
    return (
        events.where(F.col("event_type").isin(list(EVENT_TYPE_CODES)) & F.col("user_id").isNotNull() & F.col("ts").isNotNull())
        .select(
            F.col("user_id").cast("bigint").alias("user_id"),
            F.explode(F.array(item_from_props(F.col("props")))).alias("item_id"),
            _event_code(F.col("event_type")).cast("int").alias("behavior_type"),
            F.date_trunc("HOUR", F.col("ts")).alias("time"),
            F.col("ts"),
            F.col("event_type"),
        )
        .where(F.col("item_id").isNotNull())
    )


def load_behaviour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return behaviour_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))


def _typed_columns(trailing: bool) -> list[Column]:
    return [
        F.col("user_id").try_cast("bigint").alias("user_id"),
        F.col("item_id").try_cast("bigint").alias("item_id"),
        F.col("behavior_type").try_cast("int").alias("behavior_type"),
        parse_hour(F.substring("time", 1, 13) if trailing else "time").alias("time"),
    ]


def _valid(df: DataFrame) -> Column:
    return F.col("user_id").isNotNull() & F.col("item_id").isNotNull() & F.col("behavior_type").isNotNull() & F.col("time").isNotNull()


def typed_behaviour(raw: DataFrame, trailing: bool = False, counts: Observation | None = None) -> DataFrame:
    """Type the six text columns; rows with a bad key, code or time are dropped.
    ``trailing`` accepts text after the hour ('2014-12-18 22:15' is hour 22),
    as a lenient date parser does.  ``counts`` observes, in the pass that first
    reads the result, how many rows there are and how many are dropped:
    ``counts.get`` then holds ``read_rows`` and ``rejected_rows``."""
    typed = raw.select(*_typed_columns(trailing))
    if counts is not None:
        typed = typed.observe(counts, F.count(F.lit(1)).alias("read_rows"), F.count_if(~_valid(typed)).alias("rejected_rows"))
    return typed.where(_valid(typed))


def rejected_rows(raw: DataFrame, trailing: bool = False) -> DataFrame:
    """The raw rows ``typed_behaviour`` drops (count them to report data quality)."""
    typed = raw.select(*[F.col(c).alias(f"raw_{c}") for c in raw.columns], *_typed_columns(trailing))
    return typed.where(~_valid(typed)).select(*[F.col(f"raw_{c}").alias(c) for c in raw.columns])


def read_behaviour_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV, every column text (no inference), schema given up front."""
    return spark.read.schema(CSV_SCHEMA).option("header", True).csv(path)


def write_behaviour_csv(beh: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a typed log back in the six-column text layout (executors write)."""
    out = beh.select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("item_id").cast("string").alias("item_id"),
        F.col("behavior_type").cast("string").alias("behavior_type"),
        F.lit(None).cast("string").alias("user_geohash"),
        F.lit(None).cast("string").alias("item_category"),
        F.date_format("time", "yyyy-MM-dd HH").alias("time"),
    )
    assert out.columns == CSV_COLUMNS
    out.write.mode(mode).option("header", True).csv(path)


def write_behaviour_table(beh: DataFrame, path: str, mode: str = "errorifexists", files_per_day: int | None = None) -> None:
    """Typed log as Parquet partitioned by ``day`` (UTC date of the hour),
    rows sorted within each file by pair and time.

    Ingest once; every job reading the table then skips the text/JSON
    parsing, gets whole-day partition pruning from its time filters (see
    ``timefn.scan_hints``) and row-group min/max on the stored hour.  By
    default there is no shuffle: each task writes the days it holds, so a
    time-ordered source gives a few files per task.  For a source that is not
    in order, ``files_per_day`` deals the rows by day and a hash of the user
    first, so that no day has more files than that.
    """
    days = beh.select("user_id", "item_id", "behavior_type", "time", F.to_date("time").alias("day"))
    if files_per_day:
        days = days.repartition("day", F.pmod(F.xxhash64("user_id"), F.lit(files_per_day)))
    (
        days
        .sortWithinPartitions("day", "user_id", "item_id", "time")
        .write.mode(mode)
        .partitionBy("day")
        .parquet(path)
    )


def read_behaviour_table(spark: SparkSession, path: str) -> DataFrame:
    """(user_id, item_id, behavior_type, time, day) from ``write_behaviour_table``."""
    return spark.read.parquet(path).select("user_id", "item_id", "behavior_type", "time", "day")
