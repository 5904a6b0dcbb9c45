import datetime as dt

from pyspark.sql import functions as F

from basketry.functions import timefn


def test_hours_between_case_from_reference_test(spark):
    # 2014-11-19 13 minus 2014-11-18 12 is 25 whole hours.
    df = spark.createDataFrame([("2014-11-19 13", "2014-11-18 12")], "big string, small string")
    row = df.select(timefn.hours_between(timefn.parse_hour("big"), timefn.parse_hour("small")).alias("d")).first()
    assert row.d == 25


def test_hours_between_truncates_towards_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2014, 1, 1, 10, 59), dt.datetime(2014, 1, 1, 10, 0))], "a timestamp, b timestamp")
    r = df.select(timefn.hours_between("a", "b").alias("pos"), timefn.hours_between("b", "a").alias("neg")).first()
    assert (r.pos, r.neg) == (0, 0)


def test_parse_hour_is_strict(spark):
    rows = [("2014-12-18 22",), ("2014-12-18 22:15",), ("2014-12-18 24",), (None,), ("garbage",), ("2014-12-18 07",)]
    out = [r.t for r in spark.createDataFrame(rows, "s string").select(timefn.parse_hour("s").alias("t")).collect()]
    assert out == [dt.datetime(2014, 12, 18, 22), None, None, None, None, dt.datetime(2014, 12, 18, 7)]


def test_hours_before_anchor_int(spark):
    df = spark.createDataFrame([(dt.datetime(2014, 12, 17, 23),), (dt.datetime(2014, 11, 18, 0),)], "t timestamp")
    out = [r.h for r in df.select(timefn.hours_before("t", "2014-12-18").alias("h")).collect()]
    assert out == [1, 720]
    assert dict(df.select(timefn.hours_before("t", "2014-12-18").alias("h")).dtypes)["h"] == "int"


def test_hhmm_to_hour(spark):
    rows = [("930",), ("2315",), ("0",), ("5",), ("12345",), ("-5",), ("-123",), ("abc",), (None,)]
    out = [r.h for r in spark.createDataFrame(rows, "s string").select(timefn.hhmm_to_hour("s").alias("h")).collect()]
    # '%04d' then the first two characters: 0930, 2315, 0000, 0005, 12345, -005, -123
    assert out == [9, 23, 0, 0, 12, 0, -1, None, None]


def test_format_rate_rounds_half_up(spark):
    df = spark.createDataFrame([(3.0, 800.0), (1.0, 3.0), (0.0, 5.0)], "a double, b double")
    out = [r.t for r in df.select(timefn.format_rate(F.col("a") / F.col("b")).alias("t")).collect()]
    assert out == ["0.0038", "0.3333", "0.0000"]


def test_strict_anchor_filters_exclude_boundary_hour(spark):
    rows = [(dt.datetime(2014, 12, 17, 23, 59),), (dt.datetime(2014, 12, 18, 0, 15),), (dt.datetime(2014, 12, 18, 1, 0),)]
    df = spark.createDataFrame(rows, "ts timestamp").withColumn("time", F.date_trunc("HOUR", "ts"))
    before = df.where(timefn.strictly_before("2014-12-18", raw="ts")).count()
    after = df.where(timefn.strictly_after("2014-12-18", raw="ts")).count()
    assert (before, after) == (1, 1)


def test_raw_instant_predicate_reaches_parquet_scan(spark, tmp_path):
    from basketry.sources.behaviour import load_behaviour
    from basketry.plans.candidates import last_hour_cart_pairs

    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = last_hour_cart_pairs(load_behaviour(spark, "/root/testdata/sf0.001"))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in plan
