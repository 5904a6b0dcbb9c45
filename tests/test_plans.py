"""Physical-plan shape of the composed jobs (AQE off: exchanges as planned)."""

import re

import pytest

import __spark_entry__ as entry
from basketry.plans import registry
from tools.plan_report import summarize

SF = "/root/testdata/sf0.001"

SHUFFLES = {
    "conversion_curve": 3,  # pair aggregate, hour aggregate, sort
    "last_day_cart_pairs": 1,
    "last_hour_cart_pairs": 1,
    "training_set": 1,  # pair aggregate; copies are made in place
    "join_label_fanout": 2,  # features and buys per pair
    "join_inner_hour": 3,  # carts and buyers per pair, hours once
    "scoring_set": 1,
}

# Per-document text transforms: no shuffle, however few splits the scan has.
TEXT = ["hashing_tf", "text_tokenize", "text_split_space"]


@pytest.fixture(scope="module")
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        yield lambda name: summarize(entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("name,n", sorted(SHUFFLES.items()))
def test_shuffle_count(static_plans, name, n):
    assert len(static_plans(name)["shuffles"]) == n


@pytest.mark.parametrize("name", TEXT)
def test_text_transforms_do_not_shuffle(static_plans, name):
    assert static_plans(name)["shuffles"] == []


@pytest.mark.parametrize("name, codes", [("last_day_cart_pairs", ["signup"]), ("last_hour_cart_pairs", ["signup"]), ("conversion_curve", ["signup", "purchase"])])
def test_behaviour_code_reaches_the_scan(spark, static_plans, name, codes):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :].split("ReadSchema")[0]
    assert all(f"EqualTo(event_type,{c})" in pushed for c in codes) or f"In(event_type, [{','.join(sorted(codes))}])" in pushed


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - {"predict_buyers", "lr_calibration", "lr_score_rows", "spam_grid_search", "cv_grid_metrics", "text_grid_sample", "spam_sgd_legacy", "spam_train_score"}))
def test_no_python_evaluation(static_plans, name):
    assert static_plans(name)["python"] == 0


def test_events_scan_is_pruned(static_plans):
    s = static_plans("scoring_set")
    assert s["schemas"] == ["ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>"]


def _exchanged(df):
    """Columns that go through each exchange that is no broadcast, as planned without broadcast joins."""
    text = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    parts = re.findall(r"^\(\d+\) (Exchange|BroadcastExchange)\nInput \[\d+\]: \[(.*?)\]", text, re.M)
    return [re.findall(r"([\w.]+)#", columns) for kind, columns in parts if kind == "Exchange"]


def test_labels_join_vectors_not_text(spark):
    """Vectors are shuffled, and only of documents that may have a label."""
    from pyspark.ml.feature import HashingTF, Tokenizer

    from basketry.plans import spam
    from basketry.sources import text as tsrc

    was = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    for c, v in zip(was, ("-1", "false")):
        spark.conf.set(c, v)
    try:
        docs, labels = tsrc.load_corpus_parts(spark, SF)
        stages = [Tokenizer(inputCol="text", outputCol="words"), HashingTF(inputCol="words", outputCol="features", numFeatures=100)]
        moved = _exchanged(spam.hashed_corpus(docs, stages, ["doc_id"], labels=labels))
        assert any("features" in c for c in moved) and not any({"text", "words"} & set(c) for c in moved)
        assert "text" in sum(_exchanged(tsrc.load_corpus(spark, SF)), [])  # what the test would see
    finally:
        for c, v in was.items():
            spark.conf.set(c, v)
    assert docs.count() < spark.read.parquet(f"{SF}/documents.parquet").count()
