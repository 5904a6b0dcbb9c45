"""Behaviour jobs on hand-made rows: boundary hours, fan-out, order, nulls."""

import datetime as dt
import random

from pyspark.sql import functions as F

from basketry.plans import candidates, curve, features
from basketry.schema import FEATURE_COLUMNS

A = "2014-12-18"
A31 = "2014-12-19"


def rows_of(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_curve_boundary_hour_excluded_both_sides(make_beh):
    beh = make_beh(
        [
            (1, 10, 3, "2014-12-17 23"),  # carted 1 h before the anchor
            (1, 10, 4, "2014-12-18 05"),  # bought on day 30
            (2, 20, 3, "2014-12-18 00"),  # cart in the boundary hour: not "before"
            (2, 20, 4, "2014-12-18 03"),
            (3, 30, 3, "2014-12-17 22"),
            (3, 30, 4, "2014-12-18 00"),  # buy in the boundary hour: not "after"
        ]
    )
    out = curve.conversion_curve(beh, A).collect()
    assert [(r.hour, r.bought, r.carted, r.rate_text) for r in out] == [(1, 1, 1, "1.0000")]


def test_curve_latest_cart_wins_regardless_of_order(make_beh):
    events = [(1, 10, 3, "2014-12-10 05"), (1, 10, 3, "2014-12-17 20"), (1, 10, 3, "2014-12-01 00"), (1, 10, 4, "2014-12-18 10"), (2, 20, 3, "2014-12-17 20")]
    expected = None
    for seed in range(3):
        random.Random(seed).shuffle(events)
        got = [(r.hour, r.bought, r.carted) for r in curve.conversion_curve(make_beh(events), A).collect()]
        expected = expected or got
        assert got == expected == [(4, 1, 2)]


def test_curve_only_hours_with_conversions_sorted(make_beh):
    beh = make_beh(
        [
            (1, 1, 3, "2014-12-17 23"),
            (2, 2, 3, "2014-12-17 21"),
            (3, 3, 3, "2014-12-17 21"),
            (3, 3, 4, "2014-12-18 01"),
            (4, 4, 3, "2014-12-17 10"),
            (4, 4, 4, "2014-12-18 02"),
            (4, 4, 4, "2014-12-18 03"),  # bought twice: counts once
        ]
    )
    out = curve.conversion_curve(beh, A).collect()
    assert [(r.hour, r.bought, r.carted, r.rate) for r in out] == [(3, 1, 2, 0.5), (14, 1, 1, 1.0)]


def test_curve_shape_like_published(spark):
    from basketry.sources.behaviour import load_behaviour
    from basketry.schema import DAY30

    out = curve.conversion_curve(load_behaviour(spark, "/root/testdata/sf0.1"), DAY30).collect()
    hours = [r.hour for r in out]
    assert hours == sorted(set(hours)) and hours[0] >= 1 and hours[-1] <= 720
    assert all(0 < r.rate <= 1 for r in out)


def test_candidate_lists(make_beh):
    beh = make_beh(
        [
            (1, 1, 3, "2014-12-18 23"),
            (1, 1, 3, "2014-12-18 23"),  # duplicate
            (2, 2, 3, "2014-12-18 22"),  # hour 22 is not after 22
            (3, 3, 3, "2014-12-18 00"),  # boundary hour of the day anchor
            (4, 4, 4, "2014-12-18 23"),  # a buy, not a cart
        ]
    )
    assert rows_of(candidates.last_day_cart_pairs(beh, A), "user_id", "item_id") == [(1, 1), (2, 2)]
    assert rows_of(candidates.last_hour_cart_pairs(beh, "2014-12-18 22"), "user_id", "item_id") == [(1, 1)]


def _fixture(make_beh):
    return make_beh(
        [
            (1, 1, 1, "2014-12-17 20"),
            (1, 1, 1, "2014-12-10 00"),
            (1, 1, 3, "2014-12-17 23"),
            (1, 1, 4, "2014-12-18 05"),  # pair (1,1) bought twice on day 30
            (1, 1, 4, "2014-12-18 07"),
            (2, 2, 2, "2014-12-16 00"),
            (2, 2, 4, "2014-12-15 00"),
            (3, 3, 4, "2014-12-18 09"),  # buyer without history: dropped from training
            (4, 4, 1, "2014-12-18 00"),  # boundary hour only: not in training, in scoring
        ]
    )


def test_training_set_fanout_and_labels(make_beh):
    beh = _fixture(make_beh)
    t = features.training_set(beh, A)
    got = rows_of(t, "user_id", "item_id", "time1", "type_1count", "time2", "type_2count", "time3", "type_3count", "type_4count", "label")
    assert got == [
        (1, 1, 4, 2, 0, 0, 1, 1, 0, 1.0),
        (1, 1, 4, 2, 0, 0, 1, 1, 0, 1.0),
        (2, 2, 0, 0, 48, 1, 0, 0, 1, 0.0),
    ]
    assert dict(t.dtypes)["time1"] == "int" and dict(t.dtypes)["label"] == "double"


def test_large_fanout_is_chunked(make_beh):
    n = (1 << 16) + 5
    rows = [(1, 1, 1, "2014-12-17 20")] + [(1, 1, 4, "2014-12-18 05")] * n
    t = features.training_set(make_beh(rows), A)
    assert t.count() == n and t.where(F.col("label") == 1.0).count() == n


def test_hot_pair_is_spread_over_tasks(make_beh, spark):
    """A pair bought 200,000 times: no task makes more than a few chunks of it."""
    from pyspark.sql import functions as F

    n, chunk = 200_000, features._FANOUT_CHUNK
    beh = make_beh([(1, 1, 1, "2014-12-17 20"), (2, 2, 1, "2014-12-17 20"), (2, 2, 4, "2014-12-18 05")])
    one = make_beh([(1, 1, 4, "2014-12-18 05")])
    beh = beh.union(one.crossJoin(spark.range(n)).drop("id"))
    for made, rows in ((features.training_set(beh, A), n + 1), (features.label_fanout(beh, A), n + 1)):
        per_task = [r.n for r in made.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert sum(per_task) == rows
        assert len(per_task) >= 4 and max(per_task) <= 6 * chunk


def test_only_hot_pairs_are_spread(make_beh):
    """With a chunk of 3 every hot pair takes the other way; rows are the same."""
    rows = [(u, u % 2, 1, "2014-12-17 20") for u in range(9)] + [(u, u % 2, 4, "2014-12-18 05") for u in range(9) for _ in range(u)]
    beh = make_beh(rows)
    for job in (features.training_set, features.label_fanout):
        columns = job(beh, A).columns
        assert job(beh, A, chunk=3).columns == columns
        assert rows_of(job(beh, A, chunk=3), *columns) == rows_of(job(beh, A), *columns)
    shuffles = lambda df: df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("Exchange hashpartitioning")
    assert shuffles(features.training_set(beh, A)) == 1 < shuffles(features.training_set(beh, A, chunk=3))


def test_counts_do_not_overflow(make_beh):
    assert dict(features.training_set(make_beh([(1, 1, 1, "2014-12-17 20")]), A).dtypes)["type_1count"] == "bigint"


def test_scoring_set_has_no_time_filter(make_beh):
    beh = _fixture(make_beh)
    s = {(r.user_id, r.item_id): r for r in features.scoring_set(beh, A31).collect()}
    assert set(s) == {(1, 1), (2, 2), (3, 3), (4, 4)}
    assert s[(4, 4)].time1 == 24 and s[(4, 4)].type_1count == 1
    assert s[(1, 1)].type_4count == 2 and s[(1, 1)].time1 == 28


def test_scoring_one_pass_equals_outer_joins(spark):
    from basketry.sources.behaviour import load_behaviour
    from basketry.schema import DAY31

    beh = load_behaviour(spark, "/root/testdata/sf0.01")
    a = features.scoring_set(beh, DAY31)
    b = features.pair_features_outer_joins(beh, DAY31, before_anchor=False)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_pair_table_matches_separate_sets(spark):
    from basketry.sources.behaviour import load_behaviour

    beh = load_behaviour(spark, "/root/testdata/sf0.01")
    table = features.pair_table(beh)
    a, b = features.weighted_training_from_table(table), features.weighted_training_set(beh)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    c, d = features.scoring_from_table(table), features.scoring_set(beh)
    assert c.exceptAll(d).count() == 0 and d.exceptAll(c).count() == 0


def test_except_is_distinct_and_null_safe(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, 3)], "x int, y int")
    b = spark.createDataFrame([(2, 3)], "x int, y int")
    assert a.subtract(b).collect() == [(1, None)]


def test_weighted_fit_equals_expanded_fit(make_beh):
    from basketry.operators import ml

    rows = []
    for u in range(40):
        rows.append((u, 1, 1, f"2014-12-{10 + u % 7:02d} {u % 24:02d}"))
        if u % 3 == 0:
            rows.append((u, 1, 3, "2014-12-17 05"))
        if u % 4 == 0:
            rows += [(u, 1, 4, "2014-12-18 05")] * (1 + u % 3)
    beh = make_beh(rows)
    expanded = features.training_set(beh, A).withColumn("weight", F.lit(1.0))
    compact = features.weighted_training_set(beh, A)
    fit = lambda df: __import__("basketry.plans.purchase", fromlist=["x"]).purchase_pipeline().fit(df).stages[-1]
    m1, m2 = fit(expanded), fit(compact)
    assert max(abs(a - b) for a, b in zip(m1.coefficients, m2.coefficients)) < 1e-4
    assert abs(m1.intercept - m2.intercept) < 1e-4
