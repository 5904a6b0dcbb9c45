"""Purchase prediction: fit on the labelled features before day 30, score
the features of the whole log against day 31, keep predicted buyers.

The fit uses ``weighted_training_set``: one row per pair with the number of
label copies as ``weight``.  Logistic regression's weighted objective on it
equals the objective on the expanded rows, so the model is the same while
the fitted data never grows with repeated buys of one pair.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators import ml
from basketry.plans import features
from basketry.schema import DAY30, DAY31
from basketry.session import materialize

KEYS = ["user_id", "item_id"]


def purchase_pipeline(max_iter: int = 100, reg_param: float = 0.0, threshold: float = 0.5) -> Pipeline:
    """VectorAssembler (fixed feature order) -> weighted LogisticRegression."""
    return Pipeline(stages=[ml.assembler(), ml.logistic_regression(max_iter, reg_param, weight_col="weight", threshold=threshold)])


def weighted_base_rate(train: DataFrame) -> float:
    row = train.agg((F.sum(F.col("label") * F.col("weight")) / F.sum("weight")).alias("r")).first()
    return float(row["r"] or 0.0)


def model_inputs(beh: DataFrame, train_anchor=DAY30, score_anchor=DAY31) -> tuple[DataFrame, DataFrame]:
    """(weighted training set, scoring set) from one aggregation of the log
    (``features.pair_table``), written once to the shared folder
    so the base rate, every optimiser pass and the scoring read that table."""
    table = materialize(features.pair_table(beh, train_anchor, score_anchor), "pairs")
    return features.weighted_training_from_table(table), features.scoring_from_table(table)


def fit_and_score(beh: DataFrame, threshold: float | None = None, train_anchor=DAY30, score_anchor=DAY31):
    """Fit on the training set, return (model, threshold, training set,
    scored scoring set).  Threshold None: the training base rate."""
    train, scoring = model_inputs(beh, train_anchor, score_anchor)
    t = weighted_base_rate(train) if threshold is None else threshold
    model = purchase_pipeline(threshold=t).fit(train)
    return model, t, train, model.transform(scoring)


def exact_pipeline() -> Pipeline:
    """VectorAssembler -> the same weighted model, fitted to its optimum."""
    return Pipeline(stages=[ml.assembler(), ml.exact_logistic(weight_col="weight")])


def predicted_buyers(beh: DataFrame, threshold: float | None = 0.5, train_anchor=DAY30, score_anchor=DAY31) -> DataFrame:
    """End-to-end job: pairs whose probability to buy is above ``threshold``.
    At 0.5 a log with rare buys may predict nobody; None takes the training
    base rate instead.  The model is fitted to the exact optimum, so who is
    predicted does not depend on where an optimiser stops."""
    train, scoring = model_inputs(beh, train_anchor, score_anchor)
    t = weighted_base_rate(train) if threshold is None else threshold
    scored = exact_pipeline().fit(train).transform(scoring)
    return scored.where(F.col("prediction") > t).select(*KEYS)
