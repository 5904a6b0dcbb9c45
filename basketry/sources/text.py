"""Text corpora: one-message-per-line files and the documents/labels tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.operators.semifilter import may_be_among


def read_text_lines(spark: SparkSession, path: str, column: str = "sentence") -> DataFrame:
    """One row per line of every file under ``path``."""
    return spark.read.text(path).withColumnRenamed("value", column)


def write_text_lines(df: DataFrame, column: str, path: str, mode: str = "errorifexists") -> None:
    df.select(F.col(column).cast("string").alias("value")).write.mode(mode).text(path)


def two_file_corpus(spark: SparkSession, positive_path: str, negative_path: str, column: str = "sentence") -> DataFrame:
    """Label by file: lines of ``positive_path`` get 1.0, the others 0.0."""
    pos = read_text_lines(spark, positive_path, column).withColumn("label", F.lit(1.0))
    neg = read_text_lines(spark, negative_path, column).withColumn("label", F.lit(0.0))
    return pos.unionByName(neg)


def class_labels(labels: DataFrame, label_column: str = "toxic") -> DataFrame:
    """(doc_id, label double)."""
    return labels.select("doc_id", F.col(label_column).cast("double").alias("label"))


def labelled_corpus(documents: DataFrame, labels: DataFrame, label_column: str = "toxic") -> DataFrame:
    """(doc_id, text, label double) for the labelled documents (inner join).
    Documents without a label are dropped where they are read, before the join
    (see ``may_be_among``)."""
    lab = class_labels(labels, label_column)
    return may_be_among(documents.select("doc_id", "text"), lab, "doc_id").join(lab, "doc_id").where(F.col("text").isNotNull())


def load_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled_corpus(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def load_corpus_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text) of the documents that may have a label, and (doc_id,
    label): for jobs that make something small of each text first and join the
    label to that, so that no text is shuffled."""
    lab = class_labels(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return may_be_among(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), lab, "doc_id"), lab
