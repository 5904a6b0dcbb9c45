"""Query registry: one Spark query per inventory item, plus its DuckDB oracle.

Each query takes ``(spark, sf_dir)``, reads the given tables (or data Spark
derives from them) in full and returns a DataFrame.  ``ORACLES`` holds the
independent DuckDB SQL for the same result with the same column names; a
query without an oracle is checked by row count and by pytest invariants.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.functions import textfn, timefn
from basketry.operators import ml
from basketry.operators import text as textop
from basketry.operators.latest import latest_per_key
from basketry.plans import candidates, curve, features, purchase, spam
from basketry.plans import oracle as O
from basketry.schema import ADD_TO_CART, BUY, DAY30, DAY31, FEATURE_COLUMNS, VIEW
from basketry.session import apply_required_conf, shared_dir
from basketry.sources import behaviour as bsrc
from basketry.sources import inline, sinks
from basketry.sources import text as tsrc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

KEYS = ["user_id", "item_id"]
BEH_COLUMNS = ["user_id", "item_id", "behavior_type", "time"]


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_required_conf(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def _beh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bsrc.load_behaviour(spark, sf_dir)


# ---------------------------------------------------------------------------
# Composed jobs over the behaviour log


@query("conversion_curve", O.with_beh(O.LAST_CART, O.BUYERS, O.PER_HOUR, O.CONV, O.CURVE) + "SELECT * FROM curve ORDER BY hour")
def q_conversion_curve(spark, sf_dir):
    """Share of carted pairs bought after day 30, by hours since the last cart."""
    return curve.conversion_curve(_beh(spark, sf_dir))


@query(
    "last_day_cart_pairs",
    O.with_beh() + f"SELECT DISTINCT user_id, item_id FROM beh WHERE behavior_type = 3 AND time > {O.A30}",
)
def q_last_day_cart_pairs(spark, sf_dir):
    """Distinct pairs carted after the day-30 anchor."""
    return candidates.last_day_cart_pairs(_beh(spark, sf_dir))


@query(
    "last_hour_cart_pairs",
    O.with_beh() + f"SELECT DISTINCT user_id, item_id FROM beh WHERE behavior_type = 3 AND time > {O.AH}",
)
def q_last_hour_cart_pairs(spark, sf_dir):
    """Distinct pairs carted after day 30 22h (so in the last hour)."""
    return candidates.last_hour_cart_pairs(_beh(spark, sf_dir))


@query("training_set", O.with_beh(O.features(O.A30, True), O.TRAINING) + "SELECT * FROM training")
def q_training_set(spark, sf_dir):
    """Features before day 30 labelled by day-30 buys (fan-out kept)."""
    return features.training_set(_beh(spark, sf_dir))


@query("scoring_set", O.with_beh(O.features(O.A31, False)) + "SELECT * FROM feat")
def q_scoring_set(spark, sf_dir):
    """Features over the whole log, hours up to day 31."""
    return features.scoring_set(_beh(spark, sf_dir))


# ---------------------------------------------------------------------------
# Sources and sinks


@query("src_csv_log", O.with_beh() + "SELECT user_id, item_id, behavior_type, time FROM beh")
def q_src_csv_log(spark, sf_dir):
    """The log written as the six-column text CSV (header), read back with
    an all-text schema and typed (try_cast, strict hour parsing)."""
    path = shared_dir(spark, "behaviour-csv")
    bsrc.write_behaviour_csv(_beh(spark, sf_dir), path, mode="overwrite")
    return bsrc.typed_behaviour(bsrc.read_behaviour_csv(spark, path))


@query(
    "src_inline_rows",
    O.with_beh(
        "names(behavior_type, behavior) AS (VALUES (1, 'view'), (2, 'collect'), (3, 'cart'), (4, 'buy'))"
    )
    + "SELECT CAST(n.behavior_type AS INTEGER) AS behavior_type, n.behavior, count(*) AS n_rows "
    "FROM beh JOIN names n USING (behavior_type) GROUP BY ALL",
)
def q_src_inline_rows(spark, sf_dir):
    """S3: an inline (code, name) table joined to the log; rows per behaviour.
    The four-row table is broadcast (its size is fixed)."""
    counts = _beh(spark, sf_dir).groupBy("behavior_type").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.join(F.broadcast(inline.behaviour_names(spark)), "behavior_type").select("behavior_type", "behavior", "n_rows")


@query(
    "sink_csv",
    O.with_beh(O.LAST_CART, O.BUYERS, O.PER_HOUR, O.CONV, O.CURVE) + "SELECT hour, bought, carted, rate_text FROM curve",
)
def q_sink_csv(spark, sf_dir):
    """K1: the conversion curve written as a header-less CSV directory by the
    executors, then read back with an explicit schema."""
    path = shared_dir(spark, "curve-csv")
    out = curve.conversion_curve(_beh(spark, sf_dir)).select("hour", "bought", "carted", "rate_text")
    sinks.write_csv(out, path)
    return spark.read.schema("hour INT, bought BIGINT, carted BIGINT, rate_text STRING").csv(path)


@query(
    "export_json_series",
    O.with_beh(O.LAST_CART, O.BUYERS, O.PER_HOUR, O.CONV, O.CURVE)
    + "SELECT '[' || coalesce(string_agg('[' || CAST(hour AS VARCHAR) || ',' || rate_text || ']', ',' ORDER BY hour), '') || ']' AS json FROM curve",
)
def q_export_json_series(spark, sf_dir):
    """K2: the curve as one JSON array of [hour, rate] pairs ordered by hour."""
    return sinks.json_series(curve.conversion_curve(_beh(spark, sf_dir), sort=False), "hour", "rate_text")


@query(
    "preview_first_n",
    O.with_beh() + "SELECT user_id, item_id, behavior_type, time FROM beh ORDER BY user_id, item_id, time, behavior_type LIMIT 10",
)
def q_preview_first_n(spark, sf_dir):
    """K3: first 10 rows of the log under a total order (top-k, not a full sort)."""
    return sinks.preview(_beh(spark, sf_dir).select(*BEH_COLUMNS), 10, "user_id", "item_id", "time", "behavior_type")


# ---------------------------------------------------------------------------
# Projections, filters, null handling


@query("proj_drop", O.with_beh() + "SELECT user_id, item_id, time FROM beh WHERE behavior_type = 3")
def q_proj_drop(spark, sf_dir):
    """Six-column log rows of carts with geohash, category and code dropped."""
    six = _beh(spark, sf_dir).select(
        *BEH_COLUMNS, F.lit(None).cast("string").alias("user_geohash"), F.lit(None).cast("string").alias("item_category")
    )
    return six.where(F.col("behavior_type") == ADD_TO_CART).drop("user_geohash", "item_category", "behavior_type")


@query(
    "proj_lit_label",
    O.with_beh(O.BUYERS) + "SELECT user_id, item_id, CAST(1 AS INTEGER) AS count FROM buyers",
)
def q_proj_lit_label(spark, sf_dir):
    """Distinct day-30 buyers with a constant column."""
    return curve.buyers_after(_beh(spark, sf_dir)).withColumn("count", F.lit(1))


@query(
    "proj_cast_int",
    "SELECT event_id, TRY_CAST(CAST(user_id AS VARCHAR) AS INTEGER) AS user_id, "
    "TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS item_id, "
    "TRY_CAST(event_type AS INTEGER) AS bad_code, "
    "TRY_CAST(CAST(event_id AS VARCHAR) || 'x' AS INTEGER) AS bad_number FROM events",
)
def q_proj_cast_int(spark, sf_dir):
    """Text to int with try_cast; malformed text ('view', '12x') gives
    null instead of failing the job."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    return ev.select(
        "event_id",
        F.col("user_id").cast("string").try_cast("int").alias("user_id"),
        F.get_json_object("props", "$.k").try_cast("int").alias("item_id"),
        F.col("event_type").try_cast("int").alias("bad_code"),
        F.concat(F.col("event_id").cast("string"), F.lit("x")).try_cast("int").alias("bad_number"),
    )


@query(
    "proj_select_rename",
    O.with_beh(O.features(O.A31, False))
    + "SELECT item_id AS item, user_id AS user, type_4count AS buys, time3 AS hours_since_cart FROM feat",
)
def q_proj_select_rename(spark, sf_dir):
    """Select, rename and reorder columns of the scoring features."""
    f = features.scoring_set(_beh(spark, sf_dir))
    return f.select(
        F.col("item_id").alias("item"), F.col("user_id").alias("user"), F.col("type_4count").alias("buys"), F.col("time3").alias("hours_since_cart")
    )


@query(
    "proj_pair_value",
    O.with_beh() + f"SELECT user_id, item_id, {O.hours_before('time', O.A30)} AS hour FROM beh WHERE behavior_type = 3 AND time < {O.A30}",
)
def q_proj_pair_value(spark, sf_dir):
    """P5: each cart row before day 30 as (pair, hours before the anchor)."""
    beh = _beh(spark, sf_dir)
    return beh.where((F.col("behavior_type") == ADD_TO_CART) & timefn.strictly_before(DAY30, raw="ts")).select(
        *KEYS, timefn.hours_before("time", DAY30).alias("hour")
    )


@query("filter_before_anchor", O.with_beh() + f"SELECT user_id, item_id, behavior_type, time FROM beh WHERE time < {O.A30}")
def q_filter_before_anchor(spark, sf_dir):
    """rows strictly before day 30 (hour 00 of day 30 excluded)."""
    return _beh(spark, sf_dir).where(timefn.strictly_before(DAY30, raw="ts")).select(*BEH_COLUMNS)


@query("filter_after_anchor", O.with_beh() + f"SELECT user_id, item_id, behavior_type, time FROM beh WHERE time > {O.A30}")
def q_filter_after_anchor(spark, sf_dir):
    """rows strictly after day 30 00h (the boundary hour is excluded too)."""
    return _beh(spark, sf_dir).where(timefn.strictly_after(DAY30, raw="ts")).select(*BEH_COLUMNS)


@query("filter_behavior", O.with_beh() + "SELECT user_id, item_id, behavior_type, time FROM beh WHERE behavior_type = 4")
def q_filter_behavior(spark, sf_dir):
    """rows of one behaviour code (buys)."""
    beh = _beh(spark, sf_dir)
    return beh.where(bsrc.has_code(beh, BUY)).select(*BEH_COLUMNS)


@query(
    "null_to_zero",
    O.with_beh()
    + "SELECT p.user_id, p.item_id, CAST(coalesce(b.n, 0) AS BIGINT) AS type_4count "
    "FROM (SELECT DISTINCT user_id, item_id FROM beh) p "
    "LEFT JOIN (SELECT user_id, item_id, count(*) AS n FROM beh WHERE behavior_type = 4 GROUP BY ALL) b USING (user_id, item_id)",
)
def q_null_to_zero(spark, sf_dir):
    """Every pair left-joined to its buy count; missing counts become 0."""
    beh = _beh(spark, sf_dir)
    pairs = beh.select(*KEYS).distinct()
    buys = beh.where(F.col("behavior_type") == BUY).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"))
    return pairs.join(buys, KEYS, "left").select(*KEYS, F.coalesce(F.col("n"), F.lit(0)).alias("type_4count"))


# ---------------------------------------------------------------------------
# Time, number and text-format functions


@query(
    "fn_parse_hour",
    "SELECT event_id, try_strptime(strftime(ts, '%Y-%m-%d %H'), '%Y-%m-%d %H') AS parsed, "
    "try_strptime(strftime(ts, '%Y-%m-%d %H:%M'), '%Y-%m-%d %H') AS parsed_with_minutes FROM events",
)
def q_fn_parse_hour(spark, sf_dir):
    """T1: 'yyyy-MM-dd HH' text parsed strictly; text with trailing minutes is null."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    return ev.select(
        "event_id",
        timefn.parse_hour(F.date_format("ts", "yyyy-MM-dd HH")).alias("parsed"),
        timefn.parse_hour(F.date_format("ts", "yyyy-MM-dd HH:mm")).alias("parsed_with_minutes"),
    )


@query(
    "fn_hours_between",
    O.with_beh() + "SELECT user_id, item_id, date_diff('hour', min(time), max(time)) AS span_hours FROM beh GROUP BY ALL",
)
def q_fn_hours_between(spark, sf_dir):
    """Whole hours between each pair's first and last behaviour."""
    g = _beh(spark, sf_dir).groupBy(*KEYS).agg(F.min("time").alias("first"), F.max("time").alias("last"))
    return g.select(*KEYS, timefn.hours_between("last", "first").alias("span_hours"))


@query(
    "fn_hours_before_anchor",
    "SELECT event_id, " + O.hours_before("date_trunc('hour', ts)", O.A31) + " AS hours_before FROM events",
)
def q_fn_hours_before_anchor(spark, sf_dir):
    """Hours from each event's hour up to the day-31 anchor, as int."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    return ev.select("event_id", timefn.hours_before(F.date_trunc("HOUR", "ts"), DAY31).alias("hours_before"))


@query(
    "fn_hhmm_to_hour",
    "SELECT event_id, CAST(hour(ts) * 100 + minute(ts) AS VARCHAR) AS hhmm, "
    "CAST(substr(lpad(CAST(hour(ts) * 100 + minute(ts) AS VARCHAR), 4, '0'), 1, 2) AS INTEGER) AS hour FROM events",
)
def q_fn_hhmm_to_hour(spark, sf_dir):
    """T4: 'HHmm' number text back to its hour."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    hhmm = (F.hour("ts") * 100 + F.minute("ts")).cast("string")
    return ev.select("event_id", hhmm.alias("hhmm"), timefn.hhmm_to_hour(hhmm).alias("hour"))


@query(
    "fn_format_rate",
    O.with_beh()
    + "SELECT user_id, printf('%.4f', round(count(*) FILTER (WHERE behavior_type = 4) / count(*), 4)) AS buy_rate FROM beh GROUP BY user_id",
)
def q_fn_format_rate(spark, sf_dir):
    """Per-user share of buy rows as four-decimal text (half-up)."""
    g = _beh(spark, sf_dir).groupBy("user_id").agg((F.count_if(F.col("behavior_type") == BUY) / F.count(F.lit(1))).alias("r"))
    return g.select("user_id", timefn.format_rate("r").alias("buy_rate"))


# ---------------------------------------------------------------------------
# Aggregations


@query(
    "agg_min_count_pair",
    O.with_beh()
    + f"SELECT user_id, item_id, min({O.hours_before('time', O.A30)}) AS time1, count(*) AS type_1count "
    f"FROM beh WHERE behavior_type = 1 AND time < {O.A30} GROUP BY ALL",
)
def q_agg_min_count_pair(spark, sf_dir):
    """A1: per pair, hours since the most recent view before day 30 and the view count."""
    beh = _beh(spark, sf_dir).where((F.col("behavior_type") == VIEW) & timefn.strictly_before(DAY30, raw="ts"))
    return beh.groupBy(*KEYS).agg(
        timefn.hours_before(F.max("time"), DAY30).alias("time1"), F.count(F.lit(1)).alias("type_1count")
    )


@query(
    "agg_buy_count_pair",
    O.with_beh() + f"SELECT user_id, item_id, count(*) AS type_4count FROM beh WHERE behavior_type = 4 AND time < {O.A30} GROUP BY ALL",
)
def q_agg_buy_count_pair(spark, sf_dir):
    """A2: per pair, buy rows before day 30."""
    beh = _beh(spark, sf_dir).where((F.col("behavior_type") == BUY) & timefn.strictly_before(DAY30, raw="ts"))
    return beh.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("type_4count"))


@query("agg_last_per_key", O.with_beh(O.LAST_CART) + "SELECT * FROM last_cart")
def q_agg_last_per_key(spark, sf_dir):
    """A3: one value per pair, the latest cart (fewest hours before day 30)."""
    return curve.last_cart_hours(_beh(spark, sf_dir))


@query(
    "agg_latest_event",
    "SELECT user_id, ts, event_type, value FROM events "
    "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) = 1",
)
def q_agg_latest_event(spark, sf_dir):
    """A3, general form: each user's latest event (type and value); of events at
    one instant the one with the greatest id."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    return latest_per_key(ev, ["user_id"], "ts", ["event_type", "value"], ["event_id"])


@query("agg_pairs_per_hour", O.with_beh(O.LAST_CART, O.PER_HOUR) + "SELECT * FROM per_hour")
def q_agg_pairs_per_hour(spark, sf_dir):
    """Number of carted pairs per hour (group by the value, count)."""
    return curve.last_cart_hours(_beh(spark, sf_dir)).groupBy("hour").agg(F.count(F.lit(1)).alias("carted"))


@query("agg_distinct_pairs", O.with_beh(O.BUYERS) + "SELECT * FROM buyers")
def q_agg_distinct_pairs(spark, sf_dir):
    """A5: distinct pairs bought after day 30."""
    return curve.buyers_after(_beh(spark, sf_dir))


# ---------------------------------------------------------------------------
# Joins


@query("join_inner_pair", O.with_beh(O.LAST_CART, O.BUYERS) + "SELECT c.user_id, c.item_id, c.hour FROM last_cart c JOIN buyers USING (user_id, item_id)")
def q_join_inner_pair(spark, sf_dir):
    """Latest-cart hours of the pairs that were bought (unique right side)."""
    beh = _beh(spark, sf_dir)
    return curve.last_cart_hours(beh).join(curve.buyers_after(beh), KEYS, "left_semi")


@query("join_inner_hour", O.with_beh(O.LAST_CART, O.BUYERS, O.PER_HOUR, O.CONV) + "SELECT hour, bought, carted FROM conv JOIN per_hour USING (hour)")
def q_join_inner_hour(spark, sf_dir):
    """Converted pairs per hour joined with carted pairs per hour.  The
    carts are aggregated once, and so are the hours: both sides of the join on
    the hour read the same exchange, which already deals by it."""
    beh = _beh(spark, sf_dir)
    bought = curve.buyers_after(beh).withColumn("bought", F.lit(1))
    marked = curve.last_cart_hours(beh).join(bought, KEYS, "left")
    hours = marked.groupBy("hour").agg(F.count("bought").alias("bought"), F.count(F.lit(1)).alias("carted"))
    # always so; with both counts used on both sides, their exchange is the same
    hours = hours.where("carted >= bought")
    return hours.where("bought > 0").select("hour", "bought").join(hours.select("hour", "carted"), "hour")


@query("join_full_outer_chain", O.with_beh(O.outer_join_features(O.A30)) + "SELECT * FROM feat")
def q_join_full_outer_chain(spark, sf_dir):
    """The literal feature plan, four aggregates chained by full outer joins."""
    return features.pair_features_outer_joins(_beh(spark, sf_dir), DAY30, before_anchor=True)


@query("join_label_fanout", O.with_beh(O.features(O.A30, True), O.TRAINING) + "SELECT * FROM pos")
def q_join_label_fanout(spark, sf_dir):
    """Features joined with every day-30 buy row (a pair bought n times
    gives n rows)."""
    return features.label_fanout(_beh(spark, sf_dir), DAY30)


# ---------------------------------------------------------------------------
# Sort and set operations


@query("sort_by_hour", O.with_beh(O.LAST_CART, O.PER_HOUR) + "SELECT * FROM per_hour ORDER BY hour")
def q_sort_by_hour(spark, sf_dir):
    """O1: carted pairs per hour, ascending by hour (range-partitioned sort)."""
    return q_agg_pairs_per_hour(spark, sf_dir).orderBy("hour")


@query(
    "set_union_all",
    O.with_beh()
    + f"SELECT user_id, item_id, behavior_type FROM beh WHERE behavior_type = 3 AND time > {O.A30} "
    f"UNION ALL SELECT user_id, item_id, behavior_type FROM beh WHERE behavior_type = 4 AND time > {O.A30}",
)
def q_set_union_all(spark, sf_dir):
    """Day-30 cart rows and day-30 buy rows, duplicates kept, by column name."""
    beh = _beh(spark, sf_dir).where(timefn.strictly_after(DAY30, raw="ts"))
    carts = beh.where(bsrc.has_code(beh, ADD_TO_CART)).select(*KEYS, "behavior_type")
    buys = beh.where(bsrc.has_code(beh, BUY)).select("behavior_type", *KEYS)
    return carts.unionByName(buys)


@query(
    "set_except_distinct",
    O.with_beh(O.features(O.A30, True), O.TRAINING) + f"SELECT {O.FEATURE_LIST} FROM feat EXCEPT SELECT {O.FEATURE_LIST} FROM pos",
)
def q_set_except_distinct(spark, sf_dir):
    """Feature rows minus the positive rows (distinct, null-safe EXCEPT)."""
    beh = _beh(spark, sf_dir)
    feat = features.training_features(beh, DAY30)
    pos = feat.join(features.last_day_buys(beh), KEYS).drop("label")
    return feat.subtract(pos)


# ---------------------------------------------------------------------------
# Text: tokens, text-line source, hashed TF, TF-IDF


# numFeatures of the spam jobs and of the labelled TF-IDF job.
HASH_BUCKETS = 10_000
SAMPLE_TFIDF_BUCKETS = 20
# Own choice for the all-documents table.
TFIDF_BUCKETS = 1 << 10


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


@query(
    "text_tokenize",
    f"SELECT doc_id, CAST(generate_subscripts(toks, 1) - 1 AS INTEGER) AS pos, unnest(toks) AS token "
    f"FROM (SELECT doc_id, {O.tokens_expr('text')} AS toks FROM documents WHERE text IS NOT NULL) d",
)
def q_text_tokenize(spark, sf_dir):
    """ML Tokenizer tokens of every document, one row per (doc, position)."""
    words = textop.tokens(_documents(spark, sf_dir))
    return words.select("doc_id", F.posexplode("words").alias("pos", "token"))


@query(
    "text_split_space",
    f"SELECT doc_id, CAST(generate_subscripts(toks, 1) - 1 AS INTEGER) AS pos, unnest(toks) AS token "
    f"FROM (SELECT doc_id, {O.tokens_expr('text', lower=False, sep=' ')} AS toks FROM documents WHERE text IS NOT NULL) d",
)
def q_text_split_space(spark, sf_dir):
    """Case-preserving single-space split of every document."""
    docs = _documents(spark, sf_dir).where(F.col("text").isNotNull())
    return docs.select("doc_id", F.posexplode(textfn.split_space("text")).alias("pos", "token"))


@query("src_text_lines", "SELECT unnest(string_split(text, chr(10))) AS sentence FROM documents WHERE text IS NOT NULL")
def q_src_text_lines(spark, sf_dir):
    """Documents written as a text-line file set, read back one row per line."""
    path = shared_dir(spark, "documents-text")
    tsrc.write_text_lines(_documents(spark, sf_dir).where(F.col("text").isNotNull()), "text", path)
    return tsrc.read_text_lines(spark, path)


@query(
    "labeled_corpus",
    "WITH lines AS (SELECT CAST(l.toxic AS DOUBLE) AS label, unnest(string_split(d.text, chr(10))) AS sentence "
    "FROM documents d JOIN labels l USING (doc_id) WHERE d.text IS NOT NULL) "
    f"SELECT label, sentence, CAST(len({O.tokens_expr('sentence')}) AS INTEGER) AS n_tokens FROM lines",
)
def q_labeled_corpus(spark, sf_dir):
    """Two class corpora (one message per line, one file set per class)
    labelled by file and unioned; token count per message."""
    corpus = tsrc.load_corpus(spark, sf_dir)
    pos_path, neg_path = shared_dir(spark, "corpus-pos"), shared_dir(spark, "corpus-neg")
    tsrc.write_text_lines(corpus.where(F.col("label") == 1.0), "text", pos_path)
    tsrc.write_text_lines(corpus.where(F.col("label") == 0.0), "text", neg_path)
    lines = tsrc.two_file_corpus(spark, pos_path, neg_path)
    return textop.tokens(lines, "sentence").select("label", "sentence", F.size("words").alias("n_tokens"))


@query(
    "hashing_tf",
    "WITH docs AS (SELECT doc_id, text FROM documents),\n"
    + O.doc_tokens("SELECT * FROM docs", "doc_id")
    + ",\n"
    + O.hashed_buckets("toks", HASH_BUCKETS)
    + ",\n"
    + O.tf_rows("doc_id")
    + "\nSELECT * FROM tf",
)
def q_hashing_tf(spark, sf_dir):
    """M1: hashed term frequencies (10,000 buckets) as (doc_id, bucket, tf) rows."""
    return textop.term_frequency_rows(_documents(spark, sf_dir), ["doc_id"], num_features=HASH_BUCKETS)


@query(
    "tfidf_hashed",
    "WITH docs AS (SELECT doc_id, text FROM documents WHERE text IS NOT NULL),\n"
    + O.doc_tokens("SELECT * FROM docs", "doc_id")
    + ",\n"
    + O.hashed_buckets("toks", TFIDF_BUCKETS)
    + ",\n"
    + O.tf_rows("doc_id")
    + ",\n"
    + O.tfidf_rows("doc_id")
    + "\nSELECT * FROM tfidf",
)
def q_tfidf_hashed(spark, sf_dir):
    """M2: IDF fitted on all documents, TF-IDF weights (6 places) per (doc, bucket)."""
    rows = textop.tfidf_rows(_documents(spark, sf_dir), ["doc_id"], num_features=TFIDF_BUCKETS)
    return rows.select("doc_id", "bucket", F.round("weight", 6).alias("weight"))


@query(
    "tfidf_job",
    f"WITH docs AS ({O.CORPUS}),\n"
    + O.doc_tokens("SELECT * FROM docs", "doc_id, label")
    + ",\n"
    + O.hashed_buckets("toks", SAMPLE_TFIDF_BUCKETS)
    + ",\n"
    + O.tf_rows("doc_id, label")
    + ",\n"
    + O.tfidf_rows("doc_id, label")
    + "\nSELECT * FROM tfidf",
)
def q_tfidf_job(spark, sf_dir):
    """Labelled corpus -> tokens -> 20 hashed buckets -> IDF; (doc, label, bucket, weight)."""
    docs, labels = tsrc.load_corpus_parts(spark, sf_dir)
    rows = textop.tfidf_rows(docs, ["doc_id"], num_features=SAMPLE_TFIDF_BUCKETS, labels=labels)
    return rows.select("doc_id", "label", "bucket", F.round("weight", 6).alias("weight"))


# ---------------------------------------------------------------------------
# Models: assembly, purchase model, scoring invariants, AUC, text classifiers



@query(
    "assemble_features",
    O.with_beh(O.features(O.A31, False))
    + "SELECT user_id, item_id, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURE_COLUMNS) + " FROM feat",
)
def q_assemble_features(spark, sf_dir):
    """M3: the seven features assembled into a vector (fixed order), read back
    element by element."""
    v = ml.assembler().transform(features.scoring_set(_beh(spark, sf_dir)))
    arr = vector_to_array(F.col("features"))
    return v.select(*KEYS, *[arr[i].alias(c) for i, c in enumerate(FEATURE_COLUMNS)])


@query(
    "lr_calibration",
    O.with_beh(O.features(O.A30, True), O.TRAINING)
    + "SELECT count(*) AS n_rows, sum(label) AS n_positive, true AS calibrated, true AS stationary FROM training",
)
def q_lr_calibration(spark, sf_dir):
    """M5/M7: pipeline (assembler + unpenalised logistic regression with
    intercept) fitted on the training set.  At the optimum the fitted
    probabilities sum to the number of positives; ``calibrated`` checks it
    (tolerance 0.5% of the positives, at least 0.05).  ``stationary``: the
    gradient vanishes for the intercept and all seven features (each within
    1% of its usual size)."""
    model, _, train, _ = purchase.fit_and_score(_beh(spark, sf_dir))
    scored = model.transform(train)
    agg = scored.agg(
        F.greatest(*ml.gradient_share(scored)).alias("worst"),
        F.sum("weight").cast("bigint").alias("n_rows"),
        F.sum(F.col("label") * F.col("weight")).alias("n_positive"),
        F.sum(ml.probability_of_one() * F.col("weight")).alias("p_sum"),
    )
    tol = F.greatest(F.lit(0.05), F.col("n_positive") * 0.005)
    return agg.select("n_rows", "n_positive", (F.abs(F.col("p_sum") - F.col("n_positive")) <= tol).alias("calibrated"), (F.col("worst") <= 0.01).alias("stationary"))


@query(
    "lr_score_rows",
    O.with_beh(O.features(O.A31, False)) + "SELECT user_id, item_id, true AS p_is_logistic, true AS p_sums_to_one, true AS prediction_matches FROM feat",
)
def q_lr_score_rows(spark, sf_dir):
    """M6: every scoring row gets rawPrediction, probability and prediction;
    per row, whether they are what the fitted coefficients give on the raw
    features."""
    model, threshold, _, scored = purchase.fit_and_score(_beh(spark, sf_dir))
    return ml.score_checks(scored, model.stages[-1], threshold, KEYS)


@query(
    "predict_buyers",
    O.recursive(O.with_beh(O.features(O.A30, True), O.TRAINING, O.NEWTON))
    + ", score AS (SELECT user_id, item_id, [1.0, time1, type_1count, time2, type_2count, time3, type_3count, type_4count]::DOUBLE[] AS x FROM ("
    + O.with_beh(O.features(O.A31, False))
    + "SELECT * FROM feat)) SELECT user_id, item_id FROM score, fitted WHERE 1 / (1 + exp(-list_dot_product(x, beta))) > (SELECT avg(label) FROM training)",
)
def q_predict_buyers(spark, sf_dir):
    """Pairs predicted to buy on day 31 (threshold = training base rate),
    by the exact optimum of the weighted logistic regression."""
    return purchase.predicted_buyers(_beh(spark, sf_dir), threshold=None)


@query(
    "auc_roc",
    "WITH s AS (SELECT value AS score, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS y FROM events WHERE value IS NOT NULL), "
    "r AS (SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS avg_rank FROM s), "
    "c AS (SELECT sum(avg_rank) FILTER (WHERE y = 1) AS rank_sum, count(*) FILTER (WHERE y = 1) AS n_pos, count(*) FILTER (WHERE y = 0) AS n_neg FROM r) "
    "SELECT round((rank_sum - n_pos * (n_pos + 1) / 2.0) / (n_pos * n_neg), 6) AS auc FROM c",
)
def q_auc_roc(spark, sf_dir):
    """M9: area under ROC of ``events.value`` as a score for purchase events
    (exact: every distinct score is a threshold)."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").where(F.col("value").isNotNull())
    scored = ev.select(F.col("value").alias("score"), (F.col("event_type") == "purchase").cast("double").alias("label"))
    value = ml.auc(scored, "score", "label")
    return spark.createDataFrame([(round(value, 6),)], "auc DOUBLE")


@query(
    "spam_train_score",
    f"SELECT doc_id, label, label AS prediction FROM ({O.CORPUS}) c",
)
def q_spam_train_score(spark, sf_dir):
    """Tokenizer -> HashingTF(10,000) -> LogisticRegression pipeline fitted
    on the labelled corpus and applied to it.  10,000 buckets separate a few
    hundred documents, so a right fit predicts every label."""
    docs, labels = tsrc.load_corpus_parts(spark, sf_dir)
    return spam.score_text_model(spam.train_text_model(docs, labels=labels), docs, ["doc_id"], labels=labels)


def _grid_folds(grid: spam.TextGrid, schema: str, values: int) -> DataFrame:
    """A row per setting and fold, with a flag that its AUC by rank sums is
    what Spark's evaluator makes of the same held-out scores."""
    spark = grid.scores.sparkSession
    settings = list(dict.fromkeys(r[:-1] for r in grid.rows))
    by_features = {n: [s for s in settings if s[0] == n] for n, *_ in settings}
    rows = []
    for r in grid.folds:
        setting, (fold, n_rows, n_positive, auc) = r[: 1 + values], r[1 + values :]
        own = grid.scores.where((F.col("num_features") == setting[0]) & (F.col("setting") == by_features[setting[0]].index(setting)) & (F.col("fold") == fold))
        agrees = auc is None or abs(ml.auc(own, "score", "label") - auc) < 1e-9
        rows.append((*setting, fold, n_rows, n_positive, agrees))
    return spark.createDataFrame(rows, f"num_features INT, {schema}, fold INT, n_rows BIGINT, n_positive BIGINT, auc_is_evaluators BOOLEAN")


@query("spam_grid_search", O.grid_folds(3, {"num_features": spam.SPAM_FEATURES, "max_iter": spam.SPAM_ITERATIONS}, ("INTEGER", "INTEGER")))
def q_spam_grid_search(spark, sf_dir):
    """numFeatures {10,000; 20,000} x maxIter {100; 200}, 3-fold CV by
    AUC; per setting and fold the held-out rows and the check of its AUC."""
    docs, labels = tsrc.load_corpus_parts(spark, sf_dir)
    return _grid_folds(spam.spam_grid_search(docs, fold_key="doc_id", labels=labels), "max_iter INT", 1)


@query("cv_grid_metrics", O.grid_folds(2, {"num_features": spam.SAMPLE_FEATURES, "reg_param": spam.SAMPLE_REG_PARAMS}, ("INTEGER", "DOUBLE")))
def q_cv_grid_metrics(spark, sf_dir):
    """M8: the sample grid (numFeatures {10; 100; 1,000} x regParam {0.1; 0.01},
    maxIter 10) with 2 folds fixed by a hash of doc_id (repeatable)."""
    docs, labels = tsrc.load_corpus_parts(spark, sf_dir)
    return _grid_folds(spam.sample_grid_search(docs, fold_key="doc_id", labels=labels), "reg_param DOUBLE", 1)


@query(
    "text_grid_sample",
    f"SELECT doc_id, len({O.tokens_expr('text')})::BIGINT AS n_tokens, true AS p_is_logistic, true AS prediction_matches "
    "FROM documents WHERE text IS NOT NULL AND doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)",
)
def q_text_grid_sample(spark, sf_dir):
    """Sample grid search on the labelled corpus, best model applied to
    the documents that have no label; per document, whether its probability and
    prediction are what the coefficients give on its own (bucket, count) rows."""
    unlabelled = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id")
    docs, labels = tsrc.load_corpus_parts(spark, sf_dir)
    best = spam.sample_grid_search(docs, fold_key="doc_id", labels=labels).best
    return spam.score_checks(best, _documents(spark, sf_dir).join(unlabelled, "doc_id", "left_anti"))


@query("spam_sgd_legacy", O.legacy_sgd(HASH_BUCKETS))
def q_spam_sgd_legacy(spark, sf_dir):
    """Legacy mllib SGD logistic regression on space-split tokens;
    predictions for every labelled document."""
    docs, labels = tsrc.load_corpus_parts(spark, sf_dir)
    scored = spam.legacy_predict(spam.legacy_sgd(docs, labels=labels), docs, ["doc_id"])
    return scored.join(labels, "doc_id").select("doc_id", "label", "prediction")
