import random

from basketry.operators.latest import latest_per_key


def test_latest_does_not_depend_on_order(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(5), rng.choice([None, *range(6)]), rng.choice([None, 1, 2]), rng.choice("abc"), rng.choice([None, 1.5, 2.5])) for _ in range(300)]
    low = lambda r: tuple((x is not None, x or 0) for x in r)  # noqa: E731  nulls first
    want = {}
    for k, t, tie, a, b in rows:
        want[k] = max(want.get(k, (None, None, "", None)), (t, tie, a, b), key=lambda r: (*low(r[:2]), r[2], *low(r[3:])))
    for n in (1, 7):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, "k int, t int, tie int, a string, b double").repartition(n)
        got = {r["k"]: (r["t"], r["a"], r["b"]) for r in latest_per_key(df, ["k"], "t", ["a", "b"], ["tie"]).collect()}
        assert got == {k: (t, a, b) for k, (t, _, a, b) in want.items()}


def test_edge_rows(spark):
    df = spark.createDataFrame([(None, 1, "x"), (None, 2, "y"), (1, None, "z"), (2, 3, None), (2, 3, "w"), (2, 3, "w")], "k int, t int, v string")
    assert sorted(map(tuple, latest_per_key(df, ["k"], "t", ["v"]).collect()), key=str) == [(1, None, "z"), (2, 3, "w"), (None, 2, "y")]
    assert latest_per_key(df.limit(0), ["k"], "t", ["v"]).count() == 0
