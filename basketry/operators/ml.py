"""Spark ML building blocks: assembly, logistic regression, scoring columns,
cross-validated grid search and AUC.

All fitting is Spark ML's distributed optimisation (one tree-aggregate per
iteration); only coefficients and metrics come back to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import HashingTF, Tokenizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from basketry.operators.text import sparse_parts
from basketry.schema import FEATURE_COLUMNS


#: Settings of a grid search that are fitted at the same time, unless given.
PARALLEL_FITS = 8
#: Percentage of the memory for persisted data that fits running together may fill.
STORAGE_PERCENT = 90


def assembler(input_cols: Sequence[str] = FEATURE_COLUMNS, out: str = "features") -> VectorAssembler:
    """Feature vector in fixed column order."""
    return VectorAssembler(inputCols=list(input_cols), outputCol=out)


def logistic_regression(max_iter: int = 100, reg_param: float = 0.0, weight_col: str | None = None, threshold: float = 0.5) -> LogisticRegression:
    """Binary logistic regression; Spark ML defaults unless given."""
    lr = LogisticRegression(maxIter=max_iter, regParam=reg_param, threshold=threshold)
    if weight_col:
        lr.setWeightCol(weight_col)
    return lr


def exact_logistic(max_iter: int = 50, tol: float = 1e-10, weight_col: str | None = None) -> GeneralizedLinearRegression:
    """The same model fitted to the optimum by iteratively reweighted least
    squares (Newton steps): for few features, one small aggregate per step and
    some ten steps, and a result that does not depend on where an optimiser
    stops.  Its prediction is the probability of one."""
    glr = GeneralizedLinearRegression(family="binomial", link="logit", maxIter=max_iter, tol=tol)
    if weight_col:
        glr.setWeightCol(weight_col)
    return glr


def probability_of_one(prob: str = "probability") -> Column:
    """P(label = 1) from the probability vector."""
    return vector_to_array(F.col(prob))[1]


def logit(model, columns: Sequence[str] = FEATURE_COLUMNS) -> Column:
    """The fitted model's linear score, recomputed from its coefficients and
    the raw columns."""
    terms = [F.lit(float(w)) * F.col(c) for w, c in zip(model.coefficients.toArray(), columns)]
    return sum(terms, F.lit(float(model.intercept)))


def score_checks(scored: DataFrame, model, threshold: float, keep: Sequence[str]) -> DataFrame:
    """Per-row checks of a scored frame against the fitted ``model``: the
    probability is the logistic function of the recomputed linear score, the
    two class probabilities sum to 1, and the prediction is 1 exactly if the
    recomputed probability is above the threshold (rows within rounding of it
    may fall on either side)."""
    p = vector_to_array(F.col("probability"))
    p0, p1 = p[0], p[1]
    own = 1.0 / (1.0 + F.exp(-logit(model)))
    return scored.select(
        *keep,
        (F.abs(p1 - own) < 1e-9).alias("p_is_logistic"),
        (F.abs(p0 + p1 - 1) < 1e-9).alias("p_sums_to_one"),
        ((F.col("prediction") == F.when(own > threshold, 1.0).otherwise(0.0)) | (F.abs(own - threshold) < 1e-9)).alias("prediction_matches"),
    )


def gradient_share(scored: DataFrame, columns: Sequence[str] = FEATURE_COLUMNS, weight: str = "weight") -> list[Column]:
    """Aggregates: per feature, and first for the intercept, the gradient of
    the unpenalised weighted log loss, as a share of the base rate times the
    sum of the feature (what a model without that feature is off by, about).
    At the optimum each is near 0."""
    w = F.col(weight)
    residual = (probability_of_one() - F.col("label")) * w
    rate = F.sum(F.col("label") * w) / F.sum(w)
    shares = []
    for x in (F.lit(1.0), *(F.col(c).cast("double") for c in columns)):
        size = rate * F.sum(F.abs(x) * w)
        shares.append(F.when(size > 0, F.abs(F.sum(residual * x)) / size).otherwise(0.0))
    return shares


def auc(df: DataFrame, score: str, label: str, num_bins: int = 0) -> float:
    """Area under ROC.  ``num_bins=0`` keeps every distinct score (exact;
    ties count half), the evaluator's sort and cumulative counts are
    distributed."""
    ev = BinaryClassificationEvaluator(rawPredictionCol=score, labelCol=label, metricName="areaUnderROC", numBins=num_bins)
    return ev.evaluate(df.select(F.col(score).cast("double").alias(score), F.col(label).cast("double").alias(label)))


def grouped_auc(scored: DataFrame, groups: Sequence[str], score: str = "score", label: str = "label") -> DataFrame:
    """(*groups, n_rows, n_positive, auc): exact area under ROC of every group
    at once, by rank sums (ties count half); null where a group has one class.

    Rows are first counted per distinct score.  Ranks are summed on two levels,
    so that a large group is not sorted by one task: scores fall into bands (64
    to each factor e, by sign; the order of bands is the order of scores),
    negatives below are counted within a band, and the bands of a group, of
    which there are a few thousand at most, carry their totals on."""
    groups = list(groups)
    x = F.col(score).cast("double")
    positive = F.col(label) == 1
    counts = scored.groupBy(*groups, x.alias("__x")).agg(F.count_if(positive).alias("__p"), F.count_if(~positive).alias("__n"))
    band = F.when(F.col("__x") == 0, F.lit(0)).otherwise(F.signum("__x") * F.floor((F.ln(F.abs("__x")) + 750) * 64)).cast("long")
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    within = before(Window.partitionBy(*groups, "__band").orderBy("__x"))
    below = F.coalesce(F.sum("__n").over(within), F.lit(0))
    ranked = counts.withColumn("__band", band).withColumn("__wins", F.col("__p").cast("double") * (2 * below + F.col("__n")))
    bands = ranked.groupBy(*groups, "__band").agg(F.sum("__p").alias("__p"), F.sum("__n").alias("__n"), F.sum("__wins").alias("__wins"))
    lower = F.coalesce(F.sum("__n").over(before(Window.partitionBy(*groups).orderBy("__band"))), F.lit(0))
    total = bands.withColumn("__wins", F.col("__wins") + 2.0 * F.col("__p") * lower).groupBy(*groups).agg(*[F.sum(c).alias(c) for c in ("__p", "__n", "__wins")])
    auc_ = F.when((F.col("__p") > 0) & (F.col("__n") > 0), F.col("__wins") / (2.0 * F.col("__p") * F.col("__n")))
    return total.select(*groups, (F.col("__p") + F.col("__n")).alias("n_rows"), F.col("__p").alias("n_positive"), auc_.alias("auc"))


def text_classifier(text: str = "text", num_features: int = 10_000, max_iter: int = 100, reg_param: float = 0.0) -> tuple[Pipeline, HashingTF, LogisticRegression]:
    """Tokenizer -> HashingTF -> LogisticRegression, returning the stages a
    grid can address."""
    tok = Tokenizer(inputCol=text, outputCol="words")
    tf = HashingTF(inputCol="words", outputCol="features", numFeatures=num_features)
    lr = LogisticRegression(maxIter=max_iter, regParam=reg_param)
    return Pipeline(stages=[tok, tf, lr]), tf, lr


def training_bytes(data: DataFrame, num_folds: int, features: str = "features") -> int:
    """Bytes that a fit on all folds but one keeps, about: an int and a double
    for each value of the sparse ``features``, a pointer and a label per row."""
    size = F.size(sparse_parts(features)["values"])
    total = data.agg(F.sum(12 * size.cast("bigint") + 12).alias("n")).first()["n"] or 0
    return total * (num_folds - 1) // num_folds


def storage_bytes(spark: SparkSession) -> int:
    """Memory that the executors have for persisted data."""
    context = spark.sparkContext._jsc.sc()
    status = context.getExecutorMemoryStatus()
    most, it = {}, status.iterator()
    while it.hasNext():
        entry = it.next()
        most[entry._1()] = entry._2()._1()
    if len(most) > 1:  # the driver has an entry, but runs tasks only where it is alone
        most.pop(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().blockManagerId().hostPort(), None)
    return sum(most.values())


def fits_at_a_time(spark: SparkSession, training: int, most: int) -> int:
    """How many of ``most`` fits on ``training`` bytes run together.  Each
    persists its own rows for its hundreds of evaluations; rows beyond the
    memory would be read from disk in every one of these.  At least one."""
    return max(1, min(most, STORAGE_PERCENT * storage_bytes(spark) // 100 // max(1, training)))


def out_of_fold(data: DataFrame, lr: LogisticRegression, grid: Sequence[dict], fold: str, num_folds: int, parallelism: int = PARALLEL_FITS) -> DataFrame:
    """(setting, fold, label, score): every row of ``data`` (label, features,
    fold) scored, for every setting of ``grid``, by the model that was fitted on
    the other folds.  ``score`` is the margin.  ``parallelism`` models are
    fitted at a time, or as many as there is memory for (``fits_at_a_time``),
    each by a distributed job; the scoring of all is one."""
    spark = data.sparkSession
    tasks = [(k, i) for k in range(num_folds) for i in range(len(grid))]
    parallelism = fits_at_a_time(spark, training_bytes(data, num_folds), parallelism)

    def fit(task: tuple[int, int]) -> LogisticRegressionModel:
        return lr.copy(grid[task[1]]).fit(data.where(F.col(fold) != task[0]))

    with ThreadPool(max(1, min(parallelism, len(tasks)))) as pool:
        models = pool.map(inheritable_thread_target(spark)(fit), tasks)
    parts = [
        model.transform(data.where(F.col(fold) == k)).select(F.lit(i).alias("setting"), F.col(fold).cast("int").alias("fold"), "label", vector_to_array("rawPrediction")[1].alias("score"))
        for (k, i), model in zip(tasks, models)
    ]
    return reduce(DataFrame.union, parts)


def build_grid(pairs: list[tuple]) -> list:
    g = ParamGridBuilder()
    for param, values in pairs:
        g = g.addGrid(param, list(values))
    return g.build()
