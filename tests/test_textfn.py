from pyspark.sql import functions as F

from basketry.functions import textfn
from basketry.operators import text as textop


def test_tokenizer_java_split_edges(spark):
    rows = [(0, "  Hello  World "), (1, ""), (2, "   "), (3, "a\tb\nc"), (4, "ÉTÉ Été")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    ml = {r.doc_id: r.words for r in textop.tokens(df).collect()}
    native = {r.doc_id: r.words for r in df.where("text is not null").withColumn("words", textfn.tokenize("text")).collect()}
    assert ml == native
    assert ml[0] == ["", "", "hello", "", "world"]
    assert ml[1] == [""]
    assert ml[2] == []
    assert ml[3] == ["a", "b", "c"]
    assert ml[4] == ["été", "été"]


def test_null_text_is_dropped_before_tokenizing(spark):
    df = spark.createDataFrame([(0, None), (1, "x")], "doc_id long, text string")
    assert [r.doc_id for r in textop.tokens(df).collect()] == [1]


def test_native_tokenizer_matches_ml_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    a = textop.tokens(docs).select("doc_id", "words")
    b = docs.where("text is not null").withColumn("words", textfn.tokenize("text")).select("doc_id", "words")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_split_space_keeps_case(spark):
    df = spark.createDataFrame([("Hi Dad,  I ",), ("",), ("  ",)], "t string")
    out = [r.w for r in df.select(textfn.split_space("t").alias("w")).collect()]
    assert out == [["Hi", "Dad,", "", "I"], [""], []]


def test_hashing_buckets_known_values(spark):
    df = spark.createDataFrame([(0, "spark hadoop abcd a ab abc été logistic x")], "doc_id long, text string")
    rows = textop.term_frequency_rows(df, ["doc_id"], num_features=1 << 18).collect()
    assert sorted(r.bucket for r in rows) == sorted([173558, 198017, 58828, 107107, 69191, 204392, 207973, 190884, 130154])


def test_tf_counts_repeats(spark):
    df = spark.createDataFrame([(0, "a a a b")], "doc_id long, text string")
    rows = {r.bucket: r.tf for r in textop.term_frequency_rows(df, ["doc_id"], num_features=1 << 18).collect()}
    # bucket of "a" is 107107 (2^18 buckets); "b" lands elsewhere once
    assert rows[107107] == 3.0
    assert sorted(rows.values()) == [1.0, 3.0]


def test_tfidf_formula(spark):
    import math

    df = spark.createDataFrame([(0, "a b"), (1, "a"), (2, "c")], "doc_id long, text string")
    rows = textop.tfidf_rows(df, ["doc_id"], num_features=1 << 18).collect()
    a_weight = [r.weight for r in rows if r.doc_id == 1][0]
    c_weight = [r.weight for r in rows if r.doc_id == 2][0]
    assert abs(a_weight - math.log(4 / 3)) < 1e-12
    assert abs(c_weight - math.log(4 / 2)) < 1e-12


def test_sample_tfidf_twenty_buckets(spark):
    # The three labelled sentences of the TF-IDF sample, 20 buckets.
    rows = [(0, 0.0, "hi I heard about Spark"), (1, 0.0, "I wish Java could use case classes"), (2, 1.0, "Logistic regression models are neat")]
    df = spark.createDataFrame(rows, "doc_id long, label double, text string")
    out = textop.tfidf_rows(df, ["doc_id", "label"], num_features=20)
    assert out.where(F.col("bucket") >= 20).count() == 0
    assert out.groupBy("doc_id").count().count() == 3
