import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from basketry.llm import spelling as S


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows, least=7, noise=31):
    """{word: (form, root, n, n_near, form_n)} by comparing all pairs."""
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= least
    n = {w: c for w, c in counts.items() if c >= 2}
    near = {w: [v for v in n if abs(len(v) - len(w)) <= 1 and one_edit(v, w)] for w in n}
    form = {}
    for w in n:
        top = min(((-n[v], v) for v in near[w]), default=(0, None))
        form[w] = top[1] if near[w] and -top[0] >= 10 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n.get(form[w]))
    return out


def run(docs, **m):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in S.variants(docs, **m).collect()}


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(st.text("abé\U0001f600", min_size=1, max_size=7), st.text("abé", max_size=7), st.integers(0, 7)), min_size=1, max_size=20))
def test_prefix_and_suffix_tell_single_edits(cases):
    pairs = [(a, a[:i] + b[:1] + a[i + len(b) % 2 :]) for a, b, i in cases] + [(a, b) for a, b, _ in cases]
    pairs = [(a, b) for a, b in pairs if a and b and abs(len(a) - len(b)) <= 1]
    words = [w for p in pairs for w in p]
    matrix, size = S.code_points(words)
    near, prefix = S.single_edits(matrix[::2], size[::2], matrix[1::2], size[1::2])
    for (a, b), yes, p in zip(pairs, near.tolist(), prefix.tolist()):
        assert yes == one_edit(a, b)
        if a != b:
            assert a[:p] == b[:p] and a[: p + 1] != b[: p + 1]


def test_each_pair_meets_in_one_tile(spark):
    rng = np.random.default_rng(0)
    words = sorted({"".join(rng.choice(list("abc"), rng.integers(7, 11))) for _ in range(700)})
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    got = [(r["word"], r["other"]) for r in S.near_words(df).collect()]
    want = {(a, b) for a in words for b in words if a != b and abs(len(a) - len(b)) <= 1 and one_edit(a, b)}
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 400


def test_large_tiles_are_cut_into_blocks(monkeypatch):
    words = sorted(f"abc{x}{y}efg" for x in "pqrstuvwxyz" for y in "pqrstuvwxyz ")
    one = np.zeros(len(words), np.int64)
    args = words, one, one + 8, one + 3
    pairs = lambda **m: {frozenset((int(i), int(j))) for a, b in S.edit_pairs(*args, **m) for i, j in zip(a, b)}
    want = {frozenset((i, j)) for i in range(len(words)) for j in range(i) if one_edit(words[i], words[j])}
    assert pairs() == want
    monkeypatch.setattr(S, "_SIDE_BY_SIDE", 4)
    monkeypatch.setattr(S, "_PAIRS", 37)
    assert pairs(block=7) == want


def test_whole_table_against_all_pairs(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()][:60]
    want = brute(rows)
    some = documents.where(f"doc_id IN ({','.join(str(k) for k, _ in rows)})")
    assert run(some) == want and any(v[0] for v in want.values())


def test_chains_of_forms(make_docs):
    """reference <- referense <- referensse, at ten times the count each."""
    rows = [(i, "reference " * 12) for i in range(20)] + [(100 + i, "referense " * 4) for i in range(5)] + [(200, "referensse REFERENSSE"), (201, "réference Reference")]
    got = run(make_docs(rows), noise=0)
    assert got["referensse"] == ("referense", "reference", 2, 1, 20)
    assert got["referense"] == ("reference", "reference", 20, 2, 241)
    assert got["reference"][:2] == (None, "reference")


def test_edge_rows(make_docs):
    rows = [(1, None), (2, ""), (3, "short words only"), (None, "alphabet alphabets"), (None, "alphabet alphabets"), (4, "ÀÉÎÕÜßÿ àéîõüßÿ ÀÉÎÕÜßÿ"), (5, "alphabet" * 3000 + " " + "alphabet" * 3000), (6, "ab-cdefghi jklmno1pqrstuv")]
    want = brute(rows)
    got = run(make_docs(rows))
    assert got == want and "ÀÉÎÕÜßÿ" in got and "alphabet" * 3000 in got
    assert run(make_docs([])) == {} == run(make_docs([(1, None)]))
