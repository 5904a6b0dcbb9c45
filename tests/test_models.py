"""Model invariants: calibration, probability bounds, AUC by rank sum,
repeatable grids with fixed folds, the legacy SGD job."""

from pyspark.sql import functions as F

from basketry.operators import ml
from basketry.plans import features, purchase, spam
from basketry.sources.behaviour import load_behaviour
from basketry.sources.text import load_corpus

SF01 = "/root/testdata/sf0.01"


def test_calibration_sum_equals_positives(spark):
    beh = load_behaviour(spark, SF01)
    model, _, train, _ = purchase.fit_and_score(beh)
    r = model.transform(train).agg(
        F.sum(ml.probability_of_one() * F.col("weight")).alias("p"), F.sum(F.col("label") * F.col("weight")).alias("y")
    ).first()
    assert r.y == 20
    assert abs(r.p - r.y) < 0.05


def test_default_threshold_predicts_nobody_base_rate_predicts_some(spark):
    beh = load_behaviour(spark, SF01)
    assert purchase.predicted_buyers(beh).count() == 0
    assert purchase.predicted_buyers(beh, threshold=None).count() == 2262


def test_score_checks_all_true(spark):
    beh = load_behaviour(spark, "/root/testdata/sf0.001")
    t = 0.01
    model, _, _, scored = purchase.fit_and_score(beh, t)
    good = F.col("p_is_logistic") & F.col("p_sums_to_one") & F.col("prediction_matches")
    checks = ml.score_checks(scored, model.stages[-1], t, ["user_id", "item_id"])
    assert checks.count() == 626 and checks.where(~good).count() == 0
    # the checks depend on the fit: they fail for other coefficients
    other, *_ = purchase.fit_and_score(load_behaviour(spark, SF01), t)
    assert ml.score_checks(scored, other.stages[-1], t, ["user_id", "item_id"]).where(~good).count() > 0


def test_gradient_vanishes_only_at_the_optimum(spark):
    model, _, train, _ = purchase.fit_and_score(load_behaviour(spark, SF01))
    worst = lambda m: max(m.transform(train).agg(*ml.gradient_share(m.transform(train))).first())
    assert worst(model) < 0.01
    assert worst(purchase.purchase_pipeline(reg_param=1.0).fit(train)) > 0.05


def test_auc_equals_rank_sum(spark):
    ev = spark.read.parquet(f"{SF01}/events.parquet")
    scored = ev.select(F.col("value").alias("score"), (F.col("event_type") == "purchase").cast("double").alias("label"))
    value = ml.auc(scored, "score", "label")
    pdf = scored.toPandas()
    ranks = pdf["score"].rank(method="average")
    n_pos = int((pdf["label"] == 1).sum())
    n_neg = len(pdf) - n_pos
    expected = (ranks[pdf["label"] == 1].sum() - n_pos * (n_pos + 1) / 2) / (n_pos * n_neg)
    assert abs(value - expected) < 1e-9


def test_auc_ties_count_half(spark):
    df = spark.createDataFrame([(0.5, 1.0), (0.5, 0.0), (0.9, 1.0), (0.1, 0.0)], "score double, label double")
    assert abs(ml.auc(df, "score", "label") - 0.875) < 1e-12


def test_text_model_pipeline_and_new_messages(spark):
    corpus = load_corpus(spark, SF01)
    model = spam.train_text_model(corpus)
    assert [type(s).__name__ for s in model.stages] == ["Tokenizer", "HashingTF", "LogisticRegressionModel"]
    test = spark.createDataFrame(
        [("win a prize now, just answer this letter",), ("the meeting starts at ten in the large room",)], "text string"
    )
    out = model.transform(test).select("probability", "prediction").collect()
    assert len(out) == 2 and all(r.prediction in (0.0, 1.0) for r in out)


def test_grid_with_a_fold_key_is_repeatable(spark):
    corpus = load_corpus(spark, "/root/testdata/sf0.001")
    a = spam.sample_grid_search(corpus.repartition(1), fold_key="doc_id", parallelism=2).rows
    b = spam.sample_grid_search(corpus.repartition(6), fold_key="doc_id").rows
    assert [r[:2] for r in a] == [(10, 0.1), (10, 0.01), (100, 0.1), (100, 0.01), (1000, 0.1), (1000, 0.01)]
    assert all(abs(x[2] - y[2]) < 1e-6 for x, y in zip(a, b))


def test_spam_grid_folds_come_from_the_text(spark):
    """Without a fold key the folds are a hash of the text: partitions do not matter."""
    corpus = load_corpus(spark, "/root/testdata/sf0.001")
    run = lambda n: spam.spam_grid_search(corpus.repartition(n), num_features=(100, 200), max_iters=(5, 10))
    a, b = run(1), run(6)
    assert [r[:2] for r in a.rows] == [(100, 5), (100, 10), (200, 5), (200, 10)]
    assert all(abs(x[2] - y[2]) < 1e-6 for x, y in zip(a.rows, b.rows))
    assert a.best.stages[1].getNumFeatures() == max(a.rows, key=lambda r: r[2])[0]


def test_fits_run_on_at_most_a_partition_a_core(spark, monkeypatch):
    """However many partitions the input has: each of their tasks reports to
    the driver in every evaluation.  No row is lost by that."""
    corpus = load_corpus(spark, "/root/testdata/sf0.001")
    most = spark.sparkContext.defaultParallelism
    seen = []

    def out_of_fold(data, *rest, own=ml.out_of_fold):
        seen.append((data.rdd.getNumPartitions(), data.count()))
        return own(data, *rest)

    monkeypatch.setattr(ml, "out_of_fold", out_of_fold)
    spam.spam_grid_search(corpus.repartition(3 * most), num_features=(100,), max_iters=(3,))
    assert [n for _, n in seen] == [corpus.count()]
    assert seen[0][0] <= most


def test_grid_equals_spark_cross_validation(spark):
    """Mean held-out AUC and best setting against Spark's CrossValidator on the same folds."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.tuning import CrossValidator

    corpus = load_corpus(spark, "/root/testdata/sf0.001")
    grid = spam.text_grid(corpus, (100,), {"regParam": (0.1, 0.001), "maxIter": (3, 10)}, 3, fold_key="doc_id")
    pipe, _, lr = ml.text_classifier(num_features=100)
    params = ml.build_grid([(lr.regParam, (0.1, 0.001)), (lr.maxIter, (3, 10))])
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=params, evaluator=BinaryClassificationEvaluator(numBins=0), numFolds=3, foldCol="fold")
    theirs = cv.fit(spam.with_folds(corpus, 3)).avgMetrics
    by_setting = {(m[lr.regParam], m[lr.maxIter]): a for m, a in zip(params, theirs)}
    assert all(abs(by_setting[r[1:3]] - r[3]) < 1e-9 for r in grid.rows) and len(grid.rows) == 4
    best = max(grid.rows, key=lambda r: r[3])
    assert (grid.best.stages[-1].getRegParam(), grid.best.stages[-1].getMaxIter()) == best[1:3]
    assert [r[:4] for r in grid.folds] == [(100, *r[1:3], k) for r in grid.rows for k in range(3)]


def test_grouped_auc_against_pairs(spark):
    import random

    rng = random.Random(2)
    rows = [(g, rng.choice([-1e300, -3.5, -1e-9, 0.0, -0.0, 1e-300, 0.5, 0.5000001, rng.gauss(0, 5)]), float(rng.random() < 0.3)) for g in range(5) for _ in range(g * 60)]
    rows += [(9, 1.0, 1.0), (9, 2.0, 1.0), (8, 1.0, 0.0)]
    got = {r["g"]: r for r in ml.grouped_auc(spark.createDataFrame(rows, "g int, score double, label double").repartition(5), ["g"]).collect()}
    for g in (1, 2, 3, 4):
        p, n = ([x for h, x, y in rows if h == g and y == v] for v in (1.0, 0.0))
        wins = sum((a > b) + (a == b) / 2 for a in p for b in n)
        assert abs(got[g]["auc"] - wins / len(p) / len(n)) < 1e-12 and (got[g]["n_rows"], got[g]["n_positive"]) == (60 * g, len(p))
    assert got[9]["auc"] is None and got[8]["auc"] is None and set(got) == {1, 2, 3, 4, 8, 9}


def test_exact_fit_has_no_gradient_left(spark):
    """The reweighted least squares fit is the optimum that the optimiser nears."""
    train, _ = purchase.model_inputs(load_behaviour(spark, SF01))
    exact, near = purchase.exact_pipeline().fit(train).stages[-1], purchase.purchase_pipeline().fit(train).stages[-1]
    assert abs(exact.intercept - near.intercept) < 1e-3
    p = purchase.exact_pipeline().fit(train).transform(train)
    r = p.agg(*[F.abs(F.sum((F.col("prediction") - F.col("label")) * F.col("weight") * x)) for x in (F.lit(1.0), F.col("time1"), F.col("type_3count"))]).first()
    assert max(r) < 1e-5


def test_score_checks_of_a_text_model_depend_on_the_fit(spark):
    docs = load_corpus(spark, "/root/testdata/sf0.001")
    model = spam.train_text_model(docs, num_features=50, max_iter=3)
    other = spam.train_text_model(docs, num_features=50, max_iter=1)
    good = F.col("p_is_logistic") & F.col("prediction_matches")
    assert spam.score_checks(model, docs).where(~good).count() == 0
    mixed = type(model)(stages=[*model.stages[:-1], other.stages[-1]])
    assert spam.score_checks(mixed, docs).where(~good).count() == 0
    checks = spam.score_checks(model, docs).join(model.transform(docs).select("doc_id", "words"), "doc_id")
    assert checks.where(F.col("n_tokens") != F.size("words")).count() == 0


def test_legacy_sgd_scores_every_document(spark):
    corpus = load_corpus(spark, "/root/testdata/sf0.001")
    model = spam.legacy_sgd(corpus)
    assert len(model.weights) == 10_000 and model.intercept == 0.0
    pred = spam.legacy_predict(model, corpus, ["doc_id", "label"])
    assert pred.count() == corpus.count()
    assert set(r.prediction for r in pred.collect()) <= {0.0, 1.0}


def test_legacy_predict_matches_mllib_predict(spark):
    from pyspark.ml.feature import HashingTF
    from pyspark.mllib.util import MLUtils

    from basketry.functions.textfn import split_space

    corpus = load_corpus(spark, "/root/testdata/sf0.001")
    model = spam.legacy_sgd(corpus)
    ours = {r.doc_id: r.prediction for r in spam.legacy_predict(model, corpus, ["doc_id"]).collect()}
    hashed = HashingTF(inputCol="t", outputCol="f", numFeatures=10_000).transform(corpus.withColumn("t", split_space("text")))
    old = MLUtils.convertVectorColumnsFromML(hashed.select("doc_id", "f"), "f").collect()
    theirs = {r.doc_id: float(model.predict(r.f)) for r in old}
    assert ours == theirs


# The sample grid job's inline training texts (id, text, label)
# and the unlabelled texts it scores (id, text).
SAMPLE_TRAINING = [
    (0, "a b c d e spark", 1.0),
    (1, "b d", 0.0),
    (2, "spark f g h", 1.0),
    (3, "hadoop mapreduce", 0.0),
    (4, "b spark who", 1.0),
    (5, "g d a y", 0.0),
    (6, "spark fly", 1.0),
    (7, "was mapreduce", 0.0),
    (8, "e spark program", 1.0),
    (9, "a e c l", 0.0),
    (10, "spark compile", 1.0),
    (11, "hadoop software", 0.0),
]
SAMPLE_TEST = [(4, "spark i j k"), (5, "l m n"), (6, "mapreduce spark"), (7, "apache hadoop")]


def test_sample_grid_on_inline_texts(spark):
    training = spark.createDataFrame(SAMPLE_TRAINING, "id long, text string, label double")
    test = spark.createDataFrame(SAMPLE_TEST, "id long, text string")
    grid = spam.sample_grid_search(training, parallelism=2)
    assert len(grid.rows) == 6
    pred = {r.id: r.prediction for r in grid.best.transform(test).collect()}
    assert pred == {4: 1.0, 5: 0.0, 6: 1.0, 7: 0.0}


def test_fits_at_a_time_by_memory(spark):
    """No more fits together than the memory holds the training data of, one at least."""
    room = ml.storage_bytes(spark)
    assert room > 1 << 20
    assert [ml.fits_at_a_time(spark, n, 8) for n in (0, 1, room // 4, room // 2, room, 20 * room)] == [8, 8, 3, 1, 1, 1]
    assert ml.fits_at_a_time(spark, 1, 2) == 2


def test_grid_with_little_memory_fits_one_at_a_time(spark, monkeypatch):
    """Each fit keeps its own rows in memory: with room for those of one, fits
    run one after the other, on smaller partitions, with the same results."""
    import threading

    from pyspark.ml.classification import LogisticRegression

    corpus = load_corpus(spark, "/root/testdata/sf0.001").repartition(4 * spark.sparkContext.defaultParallelism)
    grid = lambda: spam.spam_grid_search(corpus, num_features=(100,), max_iters=(2, 4), fold_key="doc_id")
    before = grid()
    lock, running, together, parts = threading.Lock(), [], [], set()

    def fit(self, data, *rest, own=LogisticRegression.fit):
        with lock:
            running.append(1)
            together.append(len(running))
            parts.add(data.rdd.getNumPartitions())
        try:
            return own(self, data, *rest)
        finally:
            with lock:
                running.pop()

    monkeypatch.setattr(LogisticRegression, "fit", fit)
    monkeypatch.setattr(ml, "storage_bytes", lambda _: 1000, raising=False)
    after = grid()
    assert max(together) == 1 and len(together) == 7
    assert max(parts) > spark.sparkContext.defaultParallelism
    assert [r[:2] for r in after.rows] == [r[:2] for r in before.rows]
    assert all(abs(x[2] - y[2]) < 1e-9 for x, y in zip(before.rows, after.rows))
    assert not spark.sparkContext._jsc.sc().getPersistentRDDs().size()
