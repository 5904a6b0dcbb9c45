"""Command-line entry points for the batch jobs.

Package the library once (`zip -r basketry.zip basketry`), then submit
(`python -m basketry.jobs ...` also works with a local master):

    spark-submit --py-files basketry.zip basketry/jobs.py ingest    --log LOG --out TABLE [--files-per-day N]
    spark-submit --py-files basketry.zip basketry/jobs.py curve     --log LOG --out DIR [--json DIR]
    spark-submit --py-files basketry.zip basketry/jobs.py last-day  --log LOG --out DIR
    spark-submit --py-files basketry.zip basketry/jobs.py last-hour --log LOG --out DIR
    spark-submit --py-files basketry.zip basketry/jobs.py training  --log LOG --out DIR
    spark-submit --py-files basketry.zip basketry/jobs.py scoring   --log LOG --out DIR
    spark-submit --py-files basketry.zip basketry/jobs.py predict   --log LOG --out DIR [--threshold T|base-rate]
    spark-submit --py-files basketry.zip basketry/jobs.py json      --curve DIR --out DIR
    spark-submit --py-files basketry.zip basketry/jobs.py tfidf     --positive P --negative N --out DIR [--num-features 20]
    spark-submit --py-files basketry.zip basketry/jobs.py spam      --positive P --negative N --score S --out DIR [--grid]
    spark-submit --py-files basketry.zip basketry/jobs.py sample-grid --positive P --negative N --score S --out DIR
    spark-submit --py-files basketry.zip basketry/jobs.py legacy    --positive P --negative N --score S --out DIR

``--log`` is the six-column behaviour CSV (header, text columns), an
``events`` Parquet table (``--log-format events``) or a day-partitioned
behaviour table written by ``ingest`` (``--log-format table``).  CSV rows with a
bad key, code or time are dropped and their number, counted in the same pass, is printed;
``--trailing-time`` accepts text after the hour ('2014-12-18 22:15').  ``json``
turns a curve written earlier as CSV into one JSON array.  Text inputs are
one message per line, one file set per class.  Results are written by the
executors; ``--mode`` is the save mode (default: fail if the path exists).
Anchors default to the day-30 / day-31 / last-hour anchors of the log and
can be set with ``--day30``, ``--day31`` and ``--last-hour``.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from basketry.functions.timefn import hour_anchor
from basketry.plans import candidates, curve, features, purchase, spam
from basketry.schema import DAY30, DAY31, LAST_HOUR
from basketry.session import REQUIRED_CONF, apply_required_conf
from basketry.sources import behaviour as bsrc
from basketry.sources import sinks
from basketry.sources import text as tsrc
from basketry.operators import ml
from basketry.operators import text as textop


def _behaviour(spark: SparkSession, args) -> tuple[DataFrame, Observation | None]:
    """The log, and what counts the rows of a CSV as the job reads it."""
    if args.log_format == "events":
        return bsrc.behaviour_from_events(spark.read.parquet(args.log)), None
    if args.log_format == "table":
        return bsrc.read_behaviour_table(spark, args.log), None
    counts = Observation("csv")
    # a session that has observed something cannot be shipped any more, which
    # models fitted in it try to: so it is one of its own
    own = spark.newSession()
    apply_required_conf(own)
    return bsrc.typed_behaviour(bsrc.read_behaviour_csv(own, args.log), args.trailing_time, counts), counts


def _corpus(spark: SparkSession, args) -> DataFrame:
    return tsrc.two_file_corpus(spark, args.positive, args.negative, column="text")


def _to_score(spark: SparkSession, args) -> DataFrame:
    return tsrc.read_text_lines(spark, args.score, column="text")


def _scores(scored: DataFrame) -> DataFrame:
    return scored.select("text", vector_to_array("probability")[1].alias("p1"), "prediction")


def run(args, spark: SparkSession) -> None:
    apply_required_conf(spark)
    job = args.job
    if job == "json":
        series = spark.read.schema("hour INT, rate STRING").csv(args.curve)
        sinks.json_series(series, "hour", "rate").write.mode(args.mode).text(args.out)
        return
    if job in ("ingest", "curve", "last-day", "last-hour", "training", "scoring", "predict"):
        beh, counts = _behaviour(spark, args)
        if job == "ingest":
            bsrc.write_behaviour_table(beh, args.out, args.mode, args.files_per_day)
        elif job == "curve":
            # At most one row per hour of the window: cache it so the CSV and
            # the JSON export share one scan and shuffle of the log.
            out = curve.conversion_curve(beh, args.day30).persist()
            try:
                sinks.write_csv(out.select("hour", "rate_text"), args.out, args.mode)
                if args.json:
                    sinks.json_series(out, "hour", "rate_text").write.mode(args.mode).text(args.json)
            finally:
                out.unpersist()
        elif job == "last-day":
            sinks.write_csv(candidates.last_day_cart_pairs(beh, args.day30), args.out, args.mode)
        elif job == "last-hour":
            sinks.write_csv(candidates.last_hour_cart_pairs(beh, args.last_hour), args.out, args.mode)
        elif job == "training":
            features.training_set(beh, args.day30).write.mode(args.mode).parquet(args.out)
        elif job == "scoring":
            features.scoring_set(beh, args.day31).write.mode(args.mode).parquet(args.out)
        else:
            buyers = purchase.predicted_buyers(beh, args.threshold, args.day30, args.day31)
            sinks.write_csv(buyers, args.out, args.mode)
        if counts is not None:
            print(f"rejected rows: {counts.get['rejected_rows']} of {counts.get['read_rows']}", file=sys.stderr)
        return

    corpus = _corpus(spark, args)
    if job == "tfidf":
        rows = textop.tfidf_rows(corpus.withColumn("line_id", F.monotonically_increasing_id()), ["line_id", "label"], num_features=args.num_features)
        rows.write.mode(args.mode).parquet(args.out)
    elif job == "spam":
        if args.grid:
            model = spam.spam_grid_search(corpus, parallelism=args.parallel_fits).best
        else:
            model = spam.train_text_model(corpus)
        sinks.write_csv(_scores(model.transform(_to_score(spark, args))), args.out, args.mode)
    elif job == "sample-grid":
        model = spam.sample_grid_search(corpus, parallelism=args.parallel_fits).best
        sinks.write_csv(_scores(model.transform(_to_score(spark, args))), args.out, args.mode)
    elif job == "legacy":
        scored = spam.legacy_predict(spam.legacy_sgd(corpus), _to_score(spark, args), ["text"])
        sinks.write_csv(scored, args.out, args.mode)


def _threshold(text: str) -> float | None:
    return None if text == "base-rate" else float(text)


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="basketry.jobs", description="Behaviour and text analytics jobs")
    p.add_argument("job", choices=["ingest", "curve", "last-day", "last-hour", "training", "scoring", "predict", "json", "tfidf", "spam", "sample-grid", "legacy"])
    p.add_argument("--log", help="behaviour log: six-column CSV, or events Parquet with --log-format events")
    p.add_argument("--log-format", choices=["csv", "events", "table"], default="csv", help="table = written by the ingest job")
    p.add_argument("--positive", help="text lines of the positive (spam) class")
    p.add_argument("--negative", help="text lines of the negative (normal) class")
    p.add_argument("--score", help="text lines to score")
    p.add_argument("--out", required=True)
    p.add_argument("--json", help="also write the curve as one JSON array (curve job)")
    p.add_argument("--mode", default="errorifexists")
    p.add_argument("--threshold", type=_threshold, default=0.5, help="prediction threshold, or base-rate for that of the training set (default 0.5)")
    p.add_argument("--curve", help="curve written earlier as CSV (json job)")
    p.add_argument("--trailing-time", action="store_true", help="accept text after the hour in CSV times")
    p.add_argument("--files-per-day", type=int, default=None, help="ingest: deal rows by day first, with at most so many files a day")
    p.add_argument("--parallel-fits", type=int, default=ml.PARALLEL_FITS, help="grid searches: settings fitted at the same time")
    p.add_argument("--num-features", type=int, default=20)
    p.add_argument("--grid", action="store_true", help="spam job: cross-validated grid search")
    p.add_argument("--day30", type=hour_anchor, default=DAY30)
    p.add_argument("--day31", type=hour_anchor, default=DAY31)
    p.add_argument("--last-hour", type=hour_anchor, default=LAST_HOUR)
    return p


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    builder = SparkSession.builder.appName(f"basketry-{args.job}")
    spark = builder.config(map={**REQUIRED_CONF, "spark.cleaner.referenceTracking.cleanCheckpoints": "true"}).getOrCreate()
    run(args, spark)


if __name__ == "__main__":
    main(sys.argv[1:])
