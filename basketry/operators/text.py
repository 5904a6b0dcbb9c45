"""Text features: tokens, hashed term frequencies and TF-IDF.

The vector stages are Spark ML's own (``Tokenizer``, ``HashingTF``, ``IDF``).
To expose a sparse ML vector as rows without a Python UDF, the vector is read
as its SQL form (``unwrap_udt``: a struct of type/size/indices/values) and the
(index, value) pairs are exploded.  Everything stays on the executors; no
dense numFeatures-sized array is ever built.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import IDF, HashingTF, Tokenizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.session import materialize

# Spark ML's default number of hashing buckets (2^18).
DEFAULT_NUM_FEATURES = 1 << 18


def sparse_parts(vector: Column | str) -> Column:
    """struct<type, size, indices, values> of an ML vector column."""
    return F.unwrap_udt(vector)


def explode_sparse(df: DataFrame, vector: str, keep: list[str], index: str = "bucket", value: str = "value") -> DataFrame:
    """One row per stored entry of a sparse vector: (*keep, index, value)."""
    parts = sparse_parts(vector)
    return df.select(*keep, F.explode(F.arrays_zip(parts["indices"].alias("i"), parts["values"].alias("x"))).alias("e")).select(
        *keep, F.col("e.i").alias(index), F.col("e.x").alias(value)
    )


def tokens(df: DataFrame, text: str = "text", out: str = "words") -> DataFrame:
    """ML Tokenizer (lower case, split on single whitespace characters).
    Null text is dropped first: the tokenizer cannot take it."""
    return Tokenizer(inputCol=text, outputCol=out).transform(df.where(F.col(text).isNotNull()))


def hashed_tf(df: DataFrame, words: str = "words", out: str = "tf", num_features: int = DEFAULT_NUM_FEATURES) -> DataFrame:
    return HashingTF(inputCol=words, outputCol=out, numFeatures=num_features).transform(df)


def term_frequency_rows(df: DataFrame, id_cols: list[str], text: str = "text", num_features: int = DEFAULT_NUM_FEATURES) -> DataFrame:
    """(*id_cols, bucket int, tf double): occurrences of each hashed bucket per row."""
    tf = hashed_tf(tokens(df, text), num_features=num_features)
    return explode_sparse(tf, "tf", id_cols, "bucket", "tf")


def tfidf_rows(
    df: DataFrame, id_cols: list[str], text: str = "text", num_features: int = DEFAULT_NUM_FEATURES, model: PipelineModel | None = None, labels: DataFrame | None = None
) -> DataFrame:
    """(*id_cols, bucket int, weight double) of TF-IDF, fitted on ``df``
    unless a fitted ``model`` is given.

    When fitting here, the text is tokenised and hashed once: the sparse TF
    vectors (far smaller than the text) are written to the shared folder, IDF is fitted on them and the same vectors are rescaled, instead
    of a fit pass and a second tokenise/hash pass for the transform.  ``labels``
    (first id column, label) restricts it to the labelled rows; it is joined to
    the vectors, so no text is shuffled, and adds the label to the ids."""
    clean = df.where(F.col(text).isNotNull())
    if model is not None:
        return explode_sparse(model.transform(clean), "tfidf", id_cols, "bucket", "weight")
    tf = hashed_tf(tokens(clean, text), num_features=num_features).select(*id_cols, "tf")
    if labels is not None:
        tf, id_cols = tf.join(labels, id_cols[0]), [*id_cols, "label"]
    tf = materialize(tf)
    idf = IDF(inputCol="tf", outputCol="tfidf").fit(tf)
    return explode_sparse(idf.transform(tf), "tfidf", id_cols, "bucket", "weight")
