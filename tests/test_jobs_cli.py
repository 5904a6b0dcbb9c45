"""The spark-submit entry points write the reference jobs' result files."""

import pytest
from pyspark.sql import functions as F

from basketry import jobs
from basketry.sources import behaviour as bsrc
from basketry.sources import text as tsrc

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("jobs")
    log = str(d / "log")
    bsrc.write_behaviour_csv(bsrc.load_behaviour(spark, SF), log)
    corpus = tsrc.load_corpus(spark, SF)
    pos, neg, score = str(d / "spam"), str(d / "normal"), str(d / "score")
    tsrc.write_text_lines(corpus.where(F.col("label") == 1.0), "text", pos)
    tsrc.write_text_lines(corpus.where(F.col("label") == 0.0), "text", neg)
    msgs = spark.createDataFrame([("win a prize now, just answer this letter",), ("the meeting starts at ten in the large room",)], "text string")
    tsrc.write_text_lines(msgs, "text", score)
    return {"dir": d, "log": log, "pos": pos, "neg": neg, "score": score}


def _run(spark, argv):
    jobs.run(jobs.parser().parse_args(argv), spark)


def test_curve_job_csv_and_json(spark, inputs):
    out, js = str(inputs["dir"] / "curve"), str(inputs["dir"] / "curve.json")
    _run(spark, ["curve", "--log", inputs["log"], "--out", out, "--json", js])
    rows = spark.read.schema("hour INT, rate STRING").csv(out).orderBy("hour").collect()
    assert len(rows) == 6
    text = "".join(r.value for r in spark.read.text(js).collect())
    assert text.startswith("[[") and text.count("],[") == 5
    with pytest.raises(Exception):
        _run(spark, ["curve", "--log", inputs["log"], "--out", out])


def test_candidate_and_training_jobs(spark, inputs):
    d = inputs["dir"]
    _run(spark, ["last-day", "--log", inputs["log"], "--out", str(d / "day")])
    _run(spark, ["last-hour", "--log", inputs["log"], "--out", str(d / "hour")])
    _run(spark, ["training", "--log", inputs["log"], "--out", str(d / "train")])
    assert spark.read.csv(str(d / "day")).count() == 67
    assert spark.read.csv(str(d / "hour")).count() == 3
    assert spark.read.parquet(str(d / "train")).count() == 6037


def test_predict_job_from_events(spark, inputs):
    log = ["--log", f"{SF}/events.parquet", "--log-format", "events"]
    for more, n in (([], 0), (["--threshold", "base-rate"], 2262)):
        out = str(inputs["dir"] / f"pred{n}")
        _run(spark, ["predict", *log, "--out", out, *more])
        assert spark.read.schema("user_id LONG, item_id LONG").csv(out).count() == n


def test_predict_job_from_csv_counts_rejects(spark, inputs, capfd):
    out = str(inputs["dir"] / "pred-csv")
    _run(spark, ["predict", "--log", inputs["log"], "--out", out, "--threshold", "base-rate"])
    assert spark.read.schema("user_id LONG, item_id LONG").csv(out).count() == 2262
    assert "rejected rows: 0 of 7986" in capfd.readouterr().err


def test_scoring_and_json_jobs(spark, inputs):
    d = inputs["dir"]
    _run(spark, ["scoring", "--log", inputs["log"], "--out", str(d / "scoring")])
    assert spark.read.parquet(str(d / "scoring")).count() == 6200
    _run(spark, ["curve", "--log", inputs["log"], "--out", str(d / "c2"), "--json", str(d / "j2")])
    _run(spark, ["json", "--curve", str(d / "c2"), "--out", str(d / "j3")])
    read = lambda p: "".join(r.value for r in spark.read.text(str(d / p)).collect())
    assert read("j3") == read("j2")


def test_rejects_are_counted_and_trailing_time_is_accepted(spark, inputs, capfd):
    d = inputs["dir"]
    rows = [("1", "2", "3", None, None, "2024-01-30 05"), ("1", "3", "3", None, None, "2024-01-30 05:15"), ("x", "3", "3", None, None, "2024-01-30 05")]
    spark.createDataFrame(rows, "user_id string, item_id string, behavior_type string, user_geohash string, item_category string, time string").write.option("header", True).csv(str(d / "bad"))
    for more, rejected, n in (([], 2, 1), (["--trailing-time"], 1, 2)):
        _run(spark, ["last-day", "--log", str(d / "bad"), "--out", str(d / f"bad{n}"), *more])
        assert f"rejected rows: {rejected}" in capfd.readouterr().err
        assert spark.read.csv(str(d / f"bad{n}")).count() == n


def test_ingest_bounds_files_per_day(spark, inputs):
    table = str(inputs["dir"] / "table2")
    _run(spark, ["ingest", "--log", inputs["log"], "--out", table, "--files-per-day", "2"])
    files = spark.read.parquet(table).select("day", F.input_file_name().alias("f")).distinct().groupBy("day").count()
    assert files.agg(F.max("count")).first()[0] <= 2


def test_text_jobs(spark, inputs):
    d = inputs["dir"]
    common = ["--positive", inputs["pos"], "--negative", inputs["neg"]]
    _run(spark, ["tfidf", *common, "--out", str(d / "tfidf")])
    assert spark.read.parquet(str(d / "tfidf")).where(F.col("bucket") >= 20).count() == 0
    for job in (["spam"], ["spam", "--grid"], ["sample-grid"], ["legacy"]):
        out = str(d / ("out-" + "".join(job)))
        _run(spark, [*job, *common, "--score", inputs["score"], "--out", out])
        assert spark.read.csv(out).count() == 2


def test_ingest_then_jobs_on_table(spark, inputs):
    d = inputs["dir"]
    table = str(d / "table")
    _run(spark, ["ingest", "--log", f"{SF}/events.parquet", "--log-format", "events", "--out", table])
    _run(spark, ["last-day", "--log", table, "--log-format", "table", "--out", str(d / "day-from-table")])
    assert spark.read.csv(str(d / "day-from-table")).count() == 67
    assert {r.day.isoformat() for r in spark.read.parquet(table).select("day").distinct().collect()} >= {"2024-01-01", "2024-01-30"}
