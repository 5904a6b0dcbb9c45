import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from basketry.llm import jaccard as J
from basketry.llm.shingles import shingle_sets


def gram_set(text, size=3):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset([tuple(words)] if len(words) < size else zip(*(words[i:] for i in range(size))))


def brute(rows, percent=90):
    """[(id, size, component)] of (id, text) rows by comparing all pairs."""
    sets = [gram_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[top(i)] = top(j)
    group = {}
    for i, (k, _) in enumerate(rows):
        group.setdefault(top(i), []).append(k)
    least = {g: min((k for k in ks if k is not None), default=None) for g, ks in group.items()}
    return sorted(((k, len(sets[i]), least[top(i)]) for i, (k, _) in enumerate(rows)), key=str)


def run(docs, **settings_):
    return sorted(map(tuple, J.jaccard_components(docs, **settings_).collect()), key=str)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("abAB é\x1c \n\t ", max_size=30)), max_size=8), st.integers(1, 4), st.integers(0, 3))
def test_shingle_sets_against_sets_of_tuples(texts, size, skip):
    column = pa.array(texts, pa.string()).slice(min(skip, len(texts)))
    hashes, bounds = shingle_sets(column, size)
    seen = {}
    for i, text in enumerate(column.to_pylist()):
        got, want = hashes[bounds[i] : bounds[i + 1]], gram_set(text, size)
        assert got.size == len(want) and (got[1:] > got[:-1]).all()
        assert seen.setdefault(want, tuple(got.tolist())) == tuple(got.tolist())
    assert len(set(seen.values())) == len(seen)


def test_a_word_longer_than_the_table_of_places():
    a, b = "x" * 70_000, "x" * 69_999 + "y"
    hashes, bounds = shingle_sets(pa.array([a, b, a + " " + b]), 1)
    assert np.diff(bounds).tolist() == [1, 1, 2] and set(hashes[2:].tolist()) == set(hashes[:2].tolist())


def test_linked_sets_share_a_prefix_token_under_every_order():
    rng = np.random.default_rng(0)
    level = rng.integers(0, 3, 1 << J.TABLE_BITS).astype(np.uint8)
    for _ in range(300):
        n = int(rng.integers(1, 120))
        a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64) << np.uint64(1))
        b = np.unique(np.concatenate((a[rng.random(a.size) > 0.06], rng.integers(0, 1 << 63, int(rng.integers(0, 4))).astype(np.uint64))))
        common = np.intersect1d(a, b).size
        if not b.size or 100 * common < 90 * (a.size + b.size - common):
            continue
        bounds = np.array([0, a.size, a.size + b.size])
        for tokens, ends in J.ordered_prefixes(np.concatenate((a, b)), bounds, level, 4, 90):
            assert np.intersect1d(tokens[: ends[1]], tokens[ends[1] :]).size


@pytest.fixture(scope="module")
def near_copies():
    """Clusters of near copies around bases, chains of them, and passages that
    many documents share."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 6)))
    passage = [word() for _ in range(60)]
    rows = []
    for base in range(12):
        words = [word() for _ in range(rng.choice([1, 2, 3, 12, 40, 90, 200]))]
        for _ in range(rng.choice([1, 3, 30])):
            if rng.random() < 0.4:
                words = list(words)  # a chain goes on from here
            copy = list(words)
            for _ in range(rng.randint(0, 2)):
                copy[rng.randrange(len(copy))] = word()
            if base % 3 == 0:
                copy += passage
            rows.append((len(rows) * 7 % 1000, " ".join(copy)))
            if rng.random() < 0.3:
                words = copy
    return rows


@pytest.mark.parametrize("setting", [{}, {"limit": 2}, {"limit": 2, "class_tokens": 600}, {"orders": 1}, {"orders": 5, "class_tokens": 300}])
def test_against_all_pairs(make_docs, near_copies, setting):
    assert run(make_docs(near_copies, extra=False).repartition(3), **setting) == brute(near_copies)


def test_common_tokens_are_chained(make_docs, near_copies, monkeypatch):
    """Every token common: the candidates come from salted chains alone."""
    rows = near_copies[:40]
    monkeypatch.setattr(J, "FIRST_CLASS", 0)
    assert run(make_docs(rows, extra=False)) == brute(rows)


def test_edge_rows(make_docs):
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a"), (5, "A"), (6, "a b"), (7, text), (7, text), (None, text.upper()), (None, "lone row"), (9, text + " x"), (8, "a b c"), (8, "other words here")]
    assert run(make_docs(rows)) == brute(rows)
    assert run(make_docs([])) == []
    assert run(make_docs([(5, None)])) == [(5, 0, 5)]


def test_candidates_over_batch_borders():
    """Groups cut by batches anywhere give the same classes."""
    rng = np.random.default_rng(5)
    group = np.sort(rng.integers(0, 6, 60))
    common = np.where(group == 3, 1 << 56, 0) | (group << 3)
    rows = np.stack((np.ones(60, np.int64), common, np.zeros(60, np.int64), rng.integers(0, 40, 60), np.full(60, 10)))
    rows = rows[:, np.lexsort(rows[3::-1])]

    def classes(cuts):
        parts = [rows[:, a:b] for a, b in zip([0, *cuts], [*cuts, 60])]
        batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in p], ["ord", "token", "salt", "node", "n"]) for p in parts if p.shape[1]]
        edges = {(a, b) for out in J._candidates(90, 4)(iter(batches)) for a, b in zip(out.column(1).to_pylist(), out.column(2).to_pylist())}
        parent = {x: x for x in rows[3].tolist()}

        def top(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in edges:
            parent[max(top(a), top(b))] = min(top(a), top(b))
        return {x: top(x) for x in parent}

    whole = classes([])
    for _ in range(50):
        assert classes(sorted(rng.integers(0, 60, int(rng.integers(1, 12))).tolist())) == whole


def test_join_hot(spark):
    from basketry.llm.common import join_hot

    rows = spark.createDataFrame([(i, 0 if i % 3 else i) for i in range(4000)], "i long, k long")
    facts = rows.groupBy("k").count().selectExpr("k", "count AS n", "k * 10 AS v")
    got = join_hot(rows, facts, "k", "n").orderBy("i").collect()
    assert [(r["i"], r["v"]) for r in got] == [(i, 0 if i % 3 else i * 10) for i in range(4000)]


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(1)
    linked = 0
    for _ in range(1500):
        percent = int(rng.choice([60, 90, 90, 97]))
        n = int(rng.integers(1, rng.choice([30, 300, 3000])))
        a = rng.integers(0, 1 << 63, n).astype(np.uint64)
        keep, more = rng.random(n) > rng.choice([0, 0.03, 0.08]), rng.integers(0, 1 << 63, int(rng.integers(0, 2 + n // 12)))
        b = np.concatenate((a[keep], more.astype(np.uint64)))
        common = int(keep.sum())
        if not b.size or 100 * common < percent * (n + b.size - common):
            continue
        linked += 1
        found, of = J.signatures(np.concatenate((a, b)), np.array([0, n, n + b.size]), percent)
        assert (found >> np.uint64(56) == 1).all() and np.intersect1d(found[of == 0], found[of == 1]).size
        alone = J.signatures(b, np.array([0, b.size]), percent)[0]
        assert sorted(alone.tolist()) == sorted(found[of == 1].tolist())
        assert found.size < 60 + 0.3 * 100 / percent * (n + b.size) * (100 - percent) / 10
    assert linked > 500


def test_common_tokens_make_no_class_of_all(spark, make_docs):
    """Texts of common passages alone, put together anew in each: no giant class."""
    import zlib

    rng = random.Random(4)
    passages = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(12)) for _ in range(40)]
    rows = [(i, " ".join(rng.sample(passages, 6))) for i in range(600)]
    rows += [(1000 + i, text.replace(text.split()[0], "other", 1)) for i, text in rows[:5]]
    classes = spark.sparkContext.broadcast(zlib.compress(np.ones(1 << J.TABLE_BITS, np.uint8).tobytes(), 1))
    docs = make_docs(rows, extra=False)
    edges = J.candidate_edges(J.prefixes(docs, "text", 3, classes, 3, 90), 3, 90, 64).distinct().collect()
    reached = {x for e in edges for x in (e["a"], e["b"])}
    assert 10 <= len(reached) < 300
    assert run(docs) == brute(rows)


def test_first_class_of_full_buckets():
    """A token with a hundred occurrences is not among the rare ones, however many tokens there are."""
    assert J._first_class(0) == J.FIRST_CLASS
    assert 176 < J._first_class(176 << J.TABLE_BITS) <= 176 + 60


def test_pairs_need_enough_tokens_after_the_first_common_one():
    def pairs(rows):
        columns = np.array(rows, np.int64).T
        batch = pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["ord", "token", "salt", "node", "n"])
        return {(a, b) for out in J._candidates(90, 4)(iter([batch])) for a, b in zip(out.column(1).to_pylist(), out.column(2).to_pylist())}

    # two sets of 100 link with 95 common tokens or more, so five others may come before
    assert pairs([(1, 7, 0, 1, 100 | 5 << 32), (1, 7, 0, 2, 100 | 5 << 32)]) == {(1, 2)}
    assert pairs([(1, 7, 0, 1, 100 | 6 << 32), (1, 7, 0, 2, 100)]) == set()
    assert pairs([(1, 7, 0, 1, 100 | 10 << 32), (1, 7, 0, 2, 90)]) == {(1, 2)}
