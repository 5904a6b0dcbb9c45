"""Property tests: on random small logs the Spark jobs equal a brute-force
Python computation of the same definitions."""

import datetime as dt
from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from basketry.plans import curve, features

ANCHOR = dt.datetime(2014, 12, 18)
START = dt.datetime(2014, 12, 15)

rows_strategy = st.lists(
    st.tuples(
        st.integers(0, 3),  # user
        st.integers(0, 3),  # item
        st.integers(1, 4),  # behaviour code
        st.integers(0, 24 * 5 - 1),  # hour offset from START (spans the anchor)
    ),
    min_size=0,
    max_size=40,
)

SETTINGS = settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _frame(spark, rows):
    from basketry.schema import BEHAVIOUR_SCHEMA

    data = [(u, i, c, START + dt.timedelta(hours=o)) for u, i, c, o in rows]
    return spark.createDataFrame(data, BEHAVIOUR_SCHEMA)


def hours(t):
    return int((ANCHOR - t).total_seconds() // 3600)


def brute_curve(rows):
    last_cart, bought = {}, set()
    for u, i, c, o in rows:
        t = START + dt.timedelta(hours=o)
        if c == 3 and t < ANCHOR:
            last_cart[(u, i)] = min(last_cart.get((u, i), 10**9), hours(t))
        if c == 4 and t > ANCHOR:
            bought.add((u, i))
    carted, conv = Counter(), Counter()
    for k, h in last_cart.items():
        carted[h] += 1
        conv[h] += k in bought
    return sorted((h, conv[h], carted[h]) for h in carted if conv[h] > 0)


def brute_training(rows):
    feats = defaultdict(lambda: {"t": {1: None, 2: None, 3: None}, "n": Counter()})
    buys = Counter()
    for u, i, c, o in rows:
        t = START + dt.timedelta(hours=o)
        if t < ANCHOR:
            f = feats[(u, i)]
            f["n"][c] += 1
            if c in (1, 2, 3):
                h = hours(t)
                f["t"][c] = h if f["t"][c] is None else min(f["t"][c], h)
        elif t > ANCHOR and c == 4:
            buys[(u, i)] += 1
    out = []
    for (u, i), f in feats.items():
        row = (u, i, f["t"][1] or 0, f["n"][1], f["t"][2] or 0, f["n"][2], f["t"][3] or 0, f["n"][3], f["n"][4])
        out += [row + (1.0,)] * buys[(u, i)] if buys[(u, i)] else [row + (0.0,)]
    return sorted(out)


@SETTINGS
@given(rows=rows_strategy)
def test_curve_equals_brute_force(spark, rows):
    got = [(r.hour, r.bought, r.carted) for r in curve.conversion_curve(_frame(spark, rows), ANCHOR).collect()]
    assert got == brute_curve(rows)


@SETTINGS
@given(rows=rows_strategy)
def test_training_set_equals_brute_force(spark, rows):
    t = features.training_set(_frame(spark, rows), ANCHOR)
    got = sorted(tuple(r) for r in t.select("user_id", "item_id", "time1", "type_1count", "time2", "type_2count", "time3", "type_3count", "type_4count", "label").collect())
    assert got == brute_training(rows)
