import os

import pytest
from pyspark.sql import functions as F

from basketry.session import shared_dir
from basketry.sources import behaviour as bsrc
from basketry.sources import sinks, text


def test_csv_round_trip_and_rejects(spark, tmp_path):
    path = str(tmp_path / "log.csv")
    with open(path, "w") as f:
        f.write("user_id,item_id,behavior_type,user_geohash,item_category,time\n")
        f.write("1,10,3,,,2014-12-17 23\n")
        f.write("abc,10,3,,,2014-12-17 23\n")  # bad user id
        f.write("2,20,x,,,2014-12-17 23\n")  # bad code
        f.write("3,30,4,,,2014-12-18 22:15\n")  # trailing minutes
        f.write("4,40,4,,,2014-12-18 24\n")  # hour 24
        f.write("5,50,4,,,\n")  # missing time
    raw = bsrc.read_behaviour_csv(spark, path)
    assert [f.dataType.simpleString() for f in raw.schema] == ["string"] * 6
    typed = bsrc.typed_behaviour(raw)
    assert [(r.user_id, r.item_id, r.behavior_type) for r in typed.collect()] == [(1, 10, 3)]
    assert bsrc.rejected_rows(raw).count() == 5


def test_write_behaviour_csv_layout(spark, make_beh, tmp_path):
    beh = make_beh([(1, 10, 3, "2014-12-17 23")])
    path = str(tmp_path / "out")
    bsrc.write_behaviour_csv(beh, path)
    back = bsrc.read_behaviour_csv(spark, path).collect()
    assert [tuple(r) for r in back] == [("1", "10", "3", None, None, "2014-12-17 23")]
    assert bsrc.typed_behaviour(bsrc.read_behaviour_csv(spark, path)).count() == 1


def test_csv_sink_refuses_to_overwrite(spark, tmp_path):
    df = spark.createDataFrame([(1, "0.0634")], "hour int, rate string")
    path = str(tmp_path / "curve")
    sinks.write_csv(df, path)
    with pytest.raises(Exception):
        sinks.write_csv(df, path)
    sinks.write_csv(df, path, mode="overwrite")
    assert spark.read.schema("hour int, rate string").csv(path).collect() == [(1, "0.0634")]


def test_json_series(spark):
    df = spark.createDataFrame([(2, "0.0494"), (1, "0.0634"), (10, "0.0100")], "hour int, rate string")
    assert sinks.json_series(df, "hour", "rate").first().json == "[[1,0.0634],[2,0.0494],[10,0.0100]]"
    assert sinks.json_series(df.limit(0), "hour", "rate").first().json == "[]"


def test_preview_is_ordered(spark):
    df = spark.range(100).withColumn("k", (F.col("id") * 37) % 100)
    assert [r.k for r in sinks.preview(df, 3, "k").collect()] == [0, 1, 2]


def test_text_lines_and_two_file_corpus(spark, tmp_path):
    pos, neg = tmp_path / "spam.txt", tmp_path / "normal.txt"
    pos.write_text("buy now\ncheap stuff\n")
    neg.write_text("hi dad\n")
    lines = text.read_text_lines(spark, str(pos))
    assert lines.columns == ["sentence"] and lines.count() == 2
    corpus = text.two_file_corpus(spark, str(pos), str(neg))
    assert sorted((r.sentence, r.label) for r in corpus.collect()) == [("buy now", 1.0), ("cheap stuff", 1.0), ("hi dad", 0.0)]


def test_shared_dir_fresh(spark):
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert a != b and not os.path.exists(a.replace("file:", ""))


def test_events_adapter(spark):
    beh = bsrc.load_behaviour(spark, "/root/testdata/sf0.001")
    assert beh.count() == 799
    assert beh.select("user_id", "item_id").distinct().count() == 626
    assert beh.where(F.col("time") != F.date_trunc("HOUR", "ts")).count() == 0


def test_item_from_props_equals_json_path(spark):
    from basketry.sources.behaviour import item_from_props

    shapes = ['{"k": 69}', '{"k":0}', '{ "k" : -5 }', '{"k": 007}', '{"k": "5"}', '{"kk": 1, "k": 2}', '{"a": {"k": 1}, "k": 2}',
              '{"k": 1.5}', '{"k": 1}x', '', None, '{"k": 99999999999999999999}', '{"k":\t3}', '{"k": -0}', '{"k": +5}',
              '{"k":  5}', '{"k": 5 }', '{"k": }', '{"k": 0}', '{"k": -7}', '{"k": 5}}', 'null', '{}', '{"k": null}']
    df = spark.createDataFrame([(s,) for s in shapes], "props string")
    out = df.select(item_from_props(F.col("props")).alias("a"), F.get_json_object("props", "$.k").try_cast("bigint").alias("b")).collect()
    assert all(r.a == r.b for r in out)
    ev = spark.read.parquet("/root/testdata/sf0.1/events.parquet")
    diff = ev.select(item_from_props(F.col("props")).alias("a"), F.get_json_object("props", "$.k").try_cast("bigint").alias("b"))
    assert diff.where(~F.col("a").eqNullSafe(F.col("b"))).count() == 0


def test_behaviour_table_round_trip_and_pruning(spark, tmp_path):
    from basketry.plans import candidates, curve, features

    beh = bsrc.load_behaviour(spark, "/root/testdata/sf0.01")
    path = str(tmp_path / "beh")
    bsrc.write_behaviour_table(beh, path)
    table = bsrc.read_behaviour_table(spark, path)
    assert table.count() == beh.count()
    for job in (curve.conversion_curve, candidates.last_day_cart_pairs, features.training_set):
        a, b = job(beh), job(table)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = candidates.last_day_cart_pairs(table)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and ">= 2024-01-30" in plan
