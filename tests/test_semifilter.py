from pyspark.sql import functions as F

from basketry.operators.semifilter import may_be_among


def test_keeps_all_that_match_and_drops_most_others(spark):
    rows = spark.range(20_000).withColumn("__x", F.lit(1))
    keys = spark.range(0, 20_000, 7).select(F.col("id").cast("int").alias("id"))
    kept = may_be_among(rows, keys, "id")
    assert kept.columns == rows.columns
    ids = {r["id"] for r in kept.collect()}
    assert ids >= set(range(0, 20_000, 7)) and len(ids) < 2900 + 100


def test_full_and_empty_filters(spark):
    rows = spark.createDataFrame([(None,), ("a",), ("b",), ("",)], "k string")
    assert may_be_among(rows, rows.limit(0), "k").count() == 0
    keys = spark.range(1000).select(F.col("id").cast("string").alias("k")).union(rows)
    assert {r["k"] for r in may_be_among(rows, keys, "k", bits=8).collect()} == {"a", "b", ""}
