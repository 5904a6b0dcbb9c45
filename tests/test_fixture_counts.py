"""Row counts FIXTURES.md records for the driver's tables (probe figures)."""

import pytest
from pyspark.sql import functions as F

from basketry.plans import candidates, curve, features
from basketry.sources.behaviour import load_behaviour
from basketry.sources.text import load_corpus

EXPECTED = {
    # sf: (beh rows, pairs, curve hours, last-day pairs, last-hour pairs, training rows, positives, scoring rows)
    "0.001": (799, 626, 2, 8, 0, 610, 4, 626),
    "0.01": (7986, 6200, 6, 67, 3, 6037, 20, 6200),
    "0.1": (80190, 62129, 68, 631, 18, 60528, 275, 62129),
}


@pytest.mark.parametrize("sf", sorted(EXPECTED))
def test_behaviour_counts(spark, sf):
    beh = load_behaviour(spark, f"/root/testdata/sf{sf}")
    rows, pairs, hours, day, hour, train, pos, score = EXPECTED[sf]
    assert beh.count() == rows
    assert beh.select("user_id", "item_id").distinct().count() == pairs
    assert curve.conversion_curve(beh).count() == hours
    assert candidates.last_day_cart_pairs(beh).count() == day
    assert candidates.last_hour_cart_pairs(beh).count() == hour
    t = features.training_set(beh)
    assert t.count() == train and t.where(F.col("label") == 1.0).count() == pos
    assert features.scoring_set(beh).count() == score


@pytest.mark.parametrize("sf,labelled,positive", [("0.001", 87, 11), ("0.01", 399, 51), ("0.1", 3980, 449)])
def test_corpus_counts(spark, sf, labelled, positive):
    c = load_corpus(spark, f"/root/testdata/sf{sf}")
    assert c.count() == labelled and c.where(F.col("label") == 1.0).count() == positive
