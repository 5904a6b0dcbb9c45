import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basketry.llm import topk as K
from basketry.session import materialize as real


def brute(vectors, ids, query, own, k=5):
    scored = sorted((-int(np.dot(v, query)), int(i)) for v, i in zip(vectors.tolist(), ids.tolist()) if i != own)
    return [(-s, i) for s, i in scored[:k]]


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 40), st.integers(0, 5), st.integers(0, 10**6), st.sampled_from([1, 3, 300]), st.integers(1, 8))
def test_search_against_brute_force(n, dims, seed, spread, depth):
    """Few distinct values give many ties; a small first depth, many rounds."""
    rng = np.random.default_rng(seed)
    vectors = rng.integers(-spread, spread + 1, (n, dims))
    ids = rng.permutation(n * 2)[:n].astype(np.int64)
    lists = K.SortedLists(vectors, ids)
    for query in [*vectors[:3], rng.integers(-spread, spread + 1, dims)]:
        own = int(ids[0]) if n else -1
        assert lists.search(query, own, 5, depth)[0] == brute(vectors, ids, query, own)


@pytest.mark.parametrize("size", [1 << 24, 1 << 29])
def test_large_values_stay_exact(size):
    """Sums beyond 2^53 among rows whose sums are small."""
    rng = np.random.default_rng(1)
    vectors = rng.integers(-size + 1, size, (50, 8))
    vectors[::3] >>= 20
    lists = K.SortedLists(vectors, np.arange(50))
    for q in (6, 7):
        assert lists.search(vectors[q], q, 5, 2)[0] == brute(vectors, np.arange(50), vectors[q], q)


def test_reading_stops_early_when_the_bound_allows():
    rng = np.random.default_rng(0)
    vectors = rng.integers(-20, 20, (20_000, 4))
    vectors[:10] = 500
    lists = K.SortedLists(vectors, np.arange(20_000))
    best, depth = lists.search(np.array([9, 8, 7, 6]), -1)
    assert [i for _, i in best] == [0, 1, 2, 3, 4] and depth < 200


def test_blocks_do_not_matter(spark):
    rng = np.random.default_rng(2)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.2, 8)]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    run = lambda **m: sorted(map(tuple, K.top_k(df, F.col("vec_id") % 50 == 0, **m).collect()))
    whole = run()
    assert whole == run(block_rows=37, query_rows=2) == run(block_rows=5, cells=3) == run(cells=0)
    vectors = np.array([[math.floor(256 * x) for x in np.array(v, np.float32).astype(float)] for _, v in rows])
    want = [(q, r + 1, i, s) for q in range(0, 300, 50) for r, (s, i) in enumerate(brute(vectors, np.arange(300), vectors[q], q))]
    assert whole == sorted(want)


def test_clustered_vectors_are_searched_in_few_blocks(spark, monkeypatch):
    """The same results, and most blocks are never joined with a query."""
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 1, (8, 16))
    rows = [(int(i), [float(np.float32(x)) for x in centres[i % 8] + rng.normal(0, 0.02, 16)]) for i in range(1600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    vectors = np.array([[math.floor(256 * x) for x in v] for _, v in rows])
    tables = []
    monkeypatch.setattr(K, "materialize", lambda df, name: tables.append((name, real(df, name))) or tables[-1][1])
    got = sorted(map(tuple, K.top_k(df, F.col("vec_id") % 50 == 0, block_rows=100).collect()))
    assert got == sorted((q, r + 1, i, s) for q in range(0, 1600, 50) for r, (s, i) in enumerate(brute(vectors, np.arange(1600), vectors[q], q)))
    count = {name: t.count() for name, t in tables}
    assert count["blocks"] >= 16 and count["first"] == 32 and count["rest"] <= 32 * 4 < 32 * (count["blocks"] - 1)


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 20), st.integers(0, 6), st.sampled_from([1, 300, 10**12]), st.integers(0, 10**6))
def test_block_bounds_hold_every_score(n, dims, spread, seed):
    rng = np.random.default_rng(seed)
    block, queries = (rng.integers(-spread, spread + 1, (m, dims)) for m in (n, 5))
    bounds = K.block_bounds(queries.astype(float), block.max(axis=0, keepdims=True).astype(float), block.min(axis=0, keepdims=True).astype(float))
    assert all(bounds[q, 0] >= int(np.dot(v.astype(object), queries[q].astype(object))) for v in block for q in range(5))


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, 0.5]), (3, None), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0]), (None, [9.0, 9.0]), (50, []), (100, []), (150, None)]
    schema = "vec_id long, embedding array<float>, query_id string, score string, `a.b` string"
    df = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], schema)
    got = sorted(map(tuple, K.top_k(df, F.col("vec_id") % 50 == 0).collect()))
    assert got == [(0, 1, 1, 128 * 256), (0, 2, 2, 128 * 256), (50, 1, 100, 0), (100, 1, 50, 0)]
    assert K.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert K.top_k(df.where("vec_id = 1"), F.col("vec_id") % 50 == 0).count() == 0


def test_large_components_take_part(spark):
    rows = [(i, [i / 64, 1.0]) for i in range(60)] + [(100, [70000.0, 1.0]), (150, [3e38, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    ints = {i: [math.floor(256 * float(np.float32(x))) for x in v] for i, v in rows}
    with pytest.raises(Exception, match="does not fit in a long"):
        K.top_k(df, F.col("vec_id") == 100).collect()
    some = df.where("vec_id <> 150")
    want = [(q, r + 1, i, s) for q in (0, 50, 100) for r, (s, i) in enumerate(sorted(((sum(a * b for a, b in zip(ints[q], v)), i) for i, v in ints.items() if i not in (q, 150)), key=lambda x: (-x[0], x[1]))[:5])]
    assert sorted(map(tuple, K.top_k(some, F.col("vec_id") % 50 == 0).collect())) == want and want[5][2] == 100
