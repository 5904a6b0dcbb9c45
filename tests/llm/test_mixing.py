import pytest
from pyspark.sql import functions as F

from basketry.llm import mixing as M
from basketry.llm import registry
from tools.check_oracle import compare

SF = "/root/testdata/sf0.001"


def brute_targets(sizes, weights=M.WEIGHTS, most=M.MAX_REPEATS):
    """Share, cap, reshare the excess among the rest, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total = sum(sizes.values())
    target, free = {}, set(order)
    left = total
    while free:
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        above = {s for s in free if share[s] >= most * sizes[s]}
        if not above:
            return target | share
        for s in above:
            target[s] = most * sizes[s]
            left -= most * sizes[s]
        free -= above
    return target


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 500, "c": 3, None: 7}, {"a": 1000}, {"a": 0, "b": 5}, {"a": 1, "b": 1, "c": 1, "d": 10_000, "e": 40}, {"a": 0}])
def test_targets(spark, sizes):
    got = {r["source"]: r["target"] for r in M.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def test_oracle_and_targets_hold(spark, duck):
    got = registry.op7_mixing(spark, SF).toPandas()
    assert compare(got, duck.sql(registry.OP7_SQL).df()) == "OK"
    assert (got["taken"] <= 3 * got["size"]).all()
    by = got.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"), size=("source_size", "first"), biggest=("size", "max"))
    assert ((by["taken"] - by["target"]).abs() <= 2 * by["biggest"]).all()


def test_reruns_agree_on_other_partitions(spark, documents):
    run = lambda d: sorted((r["row"]["doc_id"], r["copies"]) for r in M.mix_counts(d).collect())
    assert run(documents) == run(documents.repartition(7, "text"))


def test_edge_rows(make_docs):
    rows = [(1, None), (2, ""), (None, "a b c"), (None, "a b c"), (3, "a b c", "en", None), (3, "x " * 50_000, "en", None), (4, "w " * 10, "en", "z"), (4, "w " * 10, "en", "z")]
    docs = make_docs(rows)
    got = M.mix_counts(docs).select("row.doc_id", "size", "copies", "source_size", "row.source").collect()
    assert len(got) == len(rows)
    assert {r["size"] for r in got} == {0, 3, 10, 50_000}
    assert all(0 <= r["copies"] <= 3 for r in got)
    assert {r["source"]: r["source_size"] for r in got} == {"src": 6, None: 50_003, "z": 20}
    mixed = M.mix(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["copies"] for r in got)


def test_empty_table(make_docs):
    assert M.mix(make_docs([])).count() == 0


def test_hot_source_of_equal_rows_is_spread(spark):
    """A source with all rows of one size still has many blocks."""
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.lit("hot").alias("source"))
    docs = docs.union(spark.createDataFrame([(-1, "c " * 9000, "other")], docs.schema))
    got = M.mix_counts(docs)
    taken = {r["source"]: r["n"] for r in got.groupBy("row.source").agg(F.sum(F.col("size") * F.col("copies")).alias("n")).collect()}
    target = {r["source"]: r["target"] for r in got.select("row.source", "target").distinct().collect()}
    assert abs(taken["hot"] - target["hot"]) <= 2
    blocks = docs.select(F.substring(F.md5(F.col("doc_id").cast("string")), 1, M.BLOCK_DIGITS).alias("p")).distinct().count()
    assert blocks == 256


def test_native(spark, documents):
    plan = M.mix(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
