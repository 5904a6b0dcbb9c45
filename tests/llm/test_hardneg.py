import math

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basketry.llm import hardneg as H
from basketry.llm import vectors as V


def brute(rows, positives=5, negatives=3, window=(50, 95)):
    """rows: (id, integer vector, label), distinct; ids divisible by 50 are anchors."""
    out = []
    for a, v, label in rows:
        if a % 50:
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), i, m == label) for i, w, m in rows if i != a and len(w) == len(v)]
        others = sorted((s, i) for s, i, same in scored if not same)
        for ps, p in sorted((s, i) for s, i, same in scored if same)[:positives]:
            fit = [(n, s) for s, n in others if window[0] * -ps <= 100 * -s <= window[1] * -ps]
            out += [(a, p, k + 1, n, -ps, -s) for k, (n, s) in enumerate(fit[:negatives])]
    return sorted(out)


def scaled(vector):
    return [math.floor(256 * float(np.float32(x))) for x in vector]


def mine(df, **m):
    return sorted(map(tuple, H.mine(df, F.col("vec_id") % 50 == 0, F.col("label"), **m).collect()))


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 30), st.integers(1, 6), st.integers(0, 4), st.sampled_from([0, 1, 3, 400, 10**6]), st.integers(0, 10**6))
def test_bounds_hold_every_score(n, dims, refs, spread, seed):
    rng = np.random.default_rng(seed)
    vectors = rng.integers(-spread, spread + 1, (n, dims)).astype(float)
    vectors[n // 2 :] = vectors[: n - n // 2] * rng.integers(-2, 3)  # parallel, opposite and zero ones
    lengths = V.norms(vectors)
    references = rng.normal(size=(refs, dims))
    references /= np.linalg.norm(references, axis=1)[:, None]
    angles = H.angles(vectors, lengths, references)
    for i in range(n):
        low, high = H.score_bounds(angles[i], lengths[i], angles, lengths)
        scores = vectors @ vectors[i]
        assert (low <= scores).all() and (scores <= high).all()


def test_few_rows_are_scored_where_angles_tell():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(8, 32)) * 300
    rows = np.floor(np.concatenate([c + rng.normal(size=(200, 32)) * 8 for c in centres]))
    labels = np.repeat(np.arange(8) // 2, 200)
    lengths = V.norms(rows)
    angles = H.angles(rows, lengths, centres / np.linalg.norm(centres, axis=1)[:, None])
    block = H.Block(pa.table({"id": np.arange(1600), "label": labels, "v": pa.array((rows / 256).tolist(), pa.list_(pa.float64())), "length": lengths, "angles": pa.array(angles.tolist(), pa.list_(pa.float64()))}), 256)
    found = block.positives(block, 0, 5)
    assert [i for i, _ in found] == [i for _, i in sorted((-float(rows[0] @ rows[i]), i) for i in range(1, 400))[:5]]
    assert block.scored < 250


@pytest.mark.parametrize("setting", [{}, {"block_rows": 31, "anchor_rows": 2}, {"references": 0}, {"references": 1, "positives": 2, "negatives": 7}])
def test_against_all_pairs(spark, setting):
    rng = np.random.default_rng(4)
    rows = [(int(i) - 100, [float(np.float32(x)) for x in rng.integers(-2, 3, 6) / 4], int(rng.integers(0, 3))) for i in range(400)]  # many ties
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)
    want = brute([(i, scaled(v), m) for i, v, m in rows], setting.get("positives", 5), setting.get("negatives", 3))
    assert mine(df, **setting) == want and want


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [(0, [1.0, 0.0], 1), (1, [0.5, 0.5], 1), (2, [0.25, 9.0], 2), (50, [0.0, 0.0], 1), (3, [-1.0, 0.0], 2), (4, [1.0], 2), (100, [], 2), (101, [], 2), (102, [], 3), (150, [-1.0, -1.0], 7), (7, [0.4, 0.1], 2), (7, [0.45, 0.1], 2)]
    bad = [(5, None, 1), (6, [1.0, None], 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [1.0, 1.0], None), (None, [1.0, 1.0], 1)]
    schema = "vec_id long, embedding array<float>, label int, id string, anchor string, h string, score string, `a.b` string"
    df = spark.createDataFrame([(*r, *"xxxxx") for r in [*good, *good[:2], *bad]], schema)
    assert mine(df) == brute([(i, scaled(v), m) for i, v, m in good])
    assert mine(df.limit(0)) == [] and mine(df.where("vec_id = 1")) == [] and mine(df.where("vec_id = 0")) == []


def test_large_components_are_exact(spark):
    rows = [(0, [3e6, 1.0, 1.0], 1), (1, [3e6, 2.0, 1.0], 1), (2, [2e6, 3.0, 1.0], 2), (3, [2e6, 2.0, 5.0], 2), (4, [1.0, 1.0, 1.0], 2), (5, [2e6, 2.0, 4.0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    want = brute([(i, scaled(v), m) for i, v, m in rows])
    assert mine(df) == want and want[0][4] > 2**53
    with pytest.raises(Exception, match="does not fit in a long"):
        mine(spark.createDataFrame([(0, [3e38], 1), (1, [3e38], 1)], "vec_id long, embedding array<float>, label int"))
