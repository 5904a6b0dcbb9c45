"""Text classification jobs over a labelled corpus (doc_id, text, label).

* ``train_text_model``: Tokenizer -> HashingTF (10,000) -> LogisticRegression.
* ``spam_grid_search``: the same pipeline under a cross-validated grid
  numFeatures {10,000; 20,000} x maxIter {100; 200}, 3 folds.
* ``sample_grid_search``: numFeatures {10; 100; 1,000} x regParam {0.1; 0.01},
  maxIter 10, 2 folds; then scores unlabelled documents.
* ``legacy_sgd``: mllib's SGD logistic regression on hashed case-preserving
  single-space tokens (deprecated API; it takes an RDD of LabeledPoint).

Hashed training data is persisted for the iterative fits, in at most one
partition a core, and released afterwards.  Folds are fixed by the data, so grid results repeat anywhere.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import product
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.textfn import split_space
from basketry.operators import ml
from basketry.operators.text import explode_sparse, sparse_parts
from basketry.session import materialize


# Grid settings of the two searches.
SPAM_FEATURES, SPAM_ITERATIONS = (10_000, 20_000), (100, 200)
SAMPLE_FEATURES, SAMPLE_REG_PARAMS = (10, 100, 1000), (0.1, 0.01)
#: Partitions a core of training data that fills the memory.
SPLITS = 3


def with_folds(corpus: DataFrame, num_folds: int, key: str = "doc_id", column: str = "fold") -> DataFrame:
    """Deterministic fold per row: the first 32 bits of the MD5 of its key as
    text (null: empty), modulo the number of folds."""
    digest = F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))
    return corpus.withColumn(column, F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(num_folds)).cast("int"))


def hashed_corpus(corpus: DataFrame, stages: Sequence, keep: Sequence[str] = (), text: str = "text", labels: DataFrame | None = None) -> DataFrame:
    """(*keep, label, features) of the rows with text, features by the
    tokenizer and hashing ``stages``.  With ``labels`` (doc_id, label) the label
    is joined to the sparse vectors, so that no text is shuffled; otherwise
    ``corpus`` has it."""
    rows = corpus.where(F.col(text).isNotNull())
    for stage in stages:
        rows = stage.transform(rows)
    if labels is None:
        return rows.select(*keep, "label", "features")
    return rows.select(*dict.fromkeys(["doc_id", *keep]), "features").join(labels, "doc_id").select(*keep, "label", "features")


def for_fits(data: DataFrame, per_core: int = 1) -> DataFrame:
    """``data`` in at most ``per_core`` partitions a core, all its rows.  Every
    evaluation of an optimiser is a job over all partitions, and each task
    reports to the driver: with partitions by input size these reports, times
    hundreds of evaluations, come to outweigh the gradients (one each)."""
    return data.coalesce(per_core * data.sparkSession.sparkContext.defaultParallelism)


def train_text_model(corpus: DataFrame, text: str = "text", num_features: int = 10_000, max_iter: int = 100, labels: DataFrame | None = None) -> PipelineModel:
    """Fit Tokenizer -> HashingTF -> LogisticRegression.  The hashed vectors
    are computed once and persisted for the optimiser's passes (instead of
    re-tokenising the text for the statistics pass and the iterations); the
    returned model is the full three-stage pipeline.  ``labels``: see
    ``hashed_corpus``."""
    pipe, tf, lr = ml.text_classifier(text, num_features, max_iter)
    tok = pipe.getStages()[0]
    hashed = for_fits(hashed_corpus(corpus, [tok, tf], text=text, labels=labels)).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return PipelineModel(stages=[tok, tf, lr.fit(hashed)])
    finally:
        hashed.unpersist()


def score_text_model(model: PipelineModel, corpus: DataFrame, keep: Sequence[str], text: str = "text", labels: DataFrame | None = None) -> DataFrame:
    """(*keep, label, prediction) of the labelled rows with text."""
    *stages, classifier = model.stages
    return classifier.transform(hashed_corpus(corpus, stages, keep, text, labels)).select(*keep, "label", "prediction")


class TextGrid(NamedTuple):
    """A finished text grid search."""

    #: (num_features, value of each other parameter ..., mean held-out AUC) per setting
    rows: list[tuple]
    #: Tokenizer -> HashingTF -> LogisticRegression with the best setting, fitted on all data
    best: PipelineModel
    #: (num_features, value of each other parameter ..., fold, n_rows, n_positive, AUC or None) per setting and fold
    folds: list[tuple]
    #: (num_features, setting, fold, label, score): all held-out scores, written to the shared folder
    scores: DataFrame


def text_grid(
    corpus: DataFrame,
    num_features: Sequence[int],
    lr_grid: dict[str, Sequence[float]],
    num_folds: int,
    text: str = "text",
    fold_key: str | None = None,
    parallelism: int = ml.PARALLEL_FITS,
    max_iter: int = 100,
    labels: DataFrame | None = None,
) -> TextGrid:
    """Cross-validate hashed text -> logistic regression over ``num_features``
    x ``lr_grid``.

    The text is tokenised and hashed once per number of features; label,
    sparse vector and fold are persisted for the folds x settings fits and
    released before the next: on disk, since a fit reads them a few times, and
    its own copy, for which it needs the memory, in every evaluation.  All held-out scores go to one table, from which
    the AUC of every setting and fold comes at once (``ml.grouped_auc``)
    instead of by a job each.  Folds are fixed by the data (a hash of
    ``fold_key``, or of the text), so a result does not depend on partitions or
    cluster.  A fold with one class only has no AUC and no part in the mean.
    Of equal settings the first is the best."""
    values = list(product(*lr_grid.values()))
    folded = with_folds(corpus.where(F.col(text).isNotNull()), num_folds, fold_key or text)
    tables = []

    def hashed(n: int) -> tuple[list, LogisticRegression, list[dict], DataFrame, DataFrame]:
        pipe, tf, lr = ml.text_classifier(text, n, max_iter)
        stages = [pipe.getStages()[0], tf]
        grid = [{lr.getParam(name): v for name, v in zip(lr_grid, setting)} for setting in values]
        kept = for_fits(hashed_corpus(folded, stages, ["fold"], text, labels), SPLITS).persist(StorageLevel.DISK_ONLY)
        # a partition is in memory as a whole or not at all
        tight = ml.fits_at_a_time(kept.sparkSession, ml.training_bytes(kept, num_folds), 2) < 2
        return stages, lr, grid, kept, kept if tight else for_fits(kept)

    for n in num_features:
        _, lr, grid, kept, data = hashed(n)
        try:
            tables.append(materialize(ml.out_of_fold(data, lr, grid, "fold", num_folds, parallelism).select(F.lit(n).alias("num_features"), "*"), "out-of-fold"))
        finally:
            kept.unpersist()
    scores = reduce(DataFrame.union, tables)
    found = {(r["num_features"], r["setting"], r["fold"]): r for r in ml.grouped_auc(scores, ["num_features", "setting", "fold"]).collect()}
    rows, folds = [], []
    for n, (i, setting) in product(num_features, enumerate(values)):
        own = [(k, found[n, i, k]) for k in range(num_folds) if (n, i, k) in found]
        folds += [(n, *setting, k, r["n_rows"], r["n_positive"], r["auc"]) for k, r in own]
        known = [r["auc"] for _, r in own if r["auc"] is not None]
        rows.append((n, *setting, sum(known) / len(known) if known else 0.0))
    top = max(range(len(rows)), key=lambda i: (rows[i][-1], -i))
    stages, lr, grid, kept, data = hashed(rows[top][0])
    try:
        best = PipelineModel(stages=[*stages, lr.copy(grid[top % len(values)]).fit(data)])
    finally:
        kept.unpersist()
    return TextGrid(rows, best, folds, scores)


def spam_grid_search(corpus: DataFrame, text: str = "text", num_features=SPAM_FEATURES, max_iters=SPAM_ITERATIONS, num_folds: int = 3, fold_key: str | None = None, parallelism: int = ml.PARALLEL_FITS, labels: DataFrame | None = None) -> TextGrid:
    return text_grid(corpus, num_features, {"maxIter": max_iters}, num_folds, text, fold_key, parallelism, labels=labels)


def sample_grid_search(corpus: DataFrame, text: str = "text", num_features=SAMPLE_FEATURES, reg_params=SAMPLE_REG_PARAMS, max_iter: int = 10, num_folds: int = 2, fold_key: str | None = None, parallelism: int = ml.PARALLEL_FITS, labels: DataFrame | None = None) -> TextGrid:
    return text_grid(corpus, num_features, {"regParam": reg_params}, num_folds, text, fold_key, parallelism, max_iter, labels)


def score_checks(model: PipelineModel, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, p_is_logistic, prediction_matches): what ``model`` gives
    for every document with text against the same score made relationally, from
    (document, bucket, count) rows joined with the coefficients."""
    *stages, classifier = model.stages
    spark = docs.sparkSession
    rows = docs.where(F.col(text).isNotNull())
    for stage in stages:
        rows = stage.transform(rows)
    scored = classifier.transform(rows.select(key, "features")).select(key, "features", ml.probability_of_one().alias("p"), "prediction")
    weights = spark.createDataFrame([(i, float(w)) for i, w in enumerate(classifier.coefficients.toArray()) if w], "bucket int, w double")
    terms = explode_sparse(scored, "features", [key], "bucket", "tf").join(weights, "bucket", "left")
    own = terms.groupBy(key).agg(F.sum("tf").cast("bigint").alias("n_tokens"), F.sum(F.col("tf") * F.coalesce("w", F.lit(0.0))).alias("dot"))
    p = 1.0 / (1.0 + F.exp(-(F.coalesce("dot", F.lit(0.0)) + F.lit(float(classifier.intercept)))))
    matches = (F.col("prediction") == F.when(p > classifier.getThreshold(), 1.0).otherwise(0.0)) | (F.abs(p - classifier.getThreshold()) < 1e-9)
    return scored.join(own, key, "left").select(key, F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"), (F.abs(F.col("p") - p) < 1e-9).alias("p_is_logistic"), matches.alias("prediction_matches"))


# ---------------------------------------------------------------------------
# Legacy mllib job


def legacy_sgd(corpus: DataFrame, text: str = "text", num_features: int = 10_000, iterations: int = 100, step: float = 1.0, reg_param: float = 0.01, labels: DataFrame | None = None):
    """mllib ``LogisticRegressionWithSGD`` (no intercept, L2 0.01, step 1.0,
    100 iterations) on HashingTF vectors of case-preserving space tokens.
    Returns the mllib model (weights vector of ``num_features`` entries).
    ``labels``: see ``hashed_corpus``."""
    from pyspark.mllib.classification import LogisticRegressionWithSGD
    from pyspark.mllib.regression import LabeledPoint
    from pyspark.mllib.util import MLUtils

    tokens = corpus.where(F.col(text).isNotNull()).withColumn("tokens", split_space(text))
    hashed = hashed_corpus(tokens, [HashingTF(inputCol="tokens", outputCol="features", numFeatures=num_features)], text=text, labels=labels)
    old = MLUtils.convertVectorColumnsFromML(for_fits(hashed.select("label", "features")), "features")
    # the trainer caches the converted points on the JVM side itself
    points = old.rdd.map(lambda r: LabeledPoint(r[0], r[1]))
    return LogisticRegressionWithSGD.train(points, iterations=iterations, step=step, regParam=reg_param, regType="l2", intercept=False)


def legacy_predict(model, docs: DataFrame, keep: list[str], text: str = "text", num_features: int = 10_000) -> DataFrame:
    """(*keep, prediction): the legacy model's decision for every document with
    text.  A document's margin is a fold over its own sparse entries and the
    weights, one constant array of ``num_features`` doubles: no join and no
    shuffle."""
    weights = F.lit([float(w) for w in model.weights.toArray()])
    hashed = HashingTF(inputCol="tokens", outputCol="tf", numFeatures=num_features).transform(
        docs.where(F.col(text).isNotNull()).withColumn("tokens", split_space(text))
    )
    parts = sparse_parts("tf")
    terms = F.zip_with(parts["indices"], parts["values"], lambda i, x: F.get(weights, i) * x)
    margin = F.aggregate(terms, F.lit(0.0), lambda total, term: total + term) + F.lit(float(model.intercept))
    threshold = model.threshold if model.threshold is not None else 0.5
    return hashed.select(*keep, F.when(1.0 / (1.0 + F.exp(-margin)) > threshold, 1.0).otherwise(0.0).alias("prediction"))
