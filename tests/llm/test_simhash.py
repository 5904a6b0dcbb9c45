import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from basketry.llm import simhash as S

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_fingerprint(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    """{row index: smallest id reachable} by comparing all pairs."""
    fps = [brute_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 2:
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(i)
    out = {}
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        for i in members:
            out[i] = min(ids) if ids else None
    return fps, out


def check(docs, rows, **more):
    fps, comps = brute_components(rows)
    want = sorted((r[0] if r[0] is not None else -1, f"{fps[i]:016x}", comps[i] if comps[i] is not None else -1) for i, r in enumerate(rows))
    got = S.near_duplicates(docs, **more).collect()
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["fingerprint"], r["component_id"] if r["component_id"] is not None else -1) for r in got) == want


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("abAB \n\t\x0b\x1c\xa0éÉ日#"), max_size=60))
def test_fingerprint_is_the_contract(text):
    assert S.fingerprint(text.encode()) == brute_fingerprint(text)


def test_long_text_is_hashed_whole(monkeypatch):
    text = " ".join(f"w{i % 701}" for i in range(5000))
    want = S.fingerprint(text.encode())
    monkeypatch.setattr(S, "_CHUNK", 1000)
    assert S.fingerprint(text.encode()) == want == brute_fingerprint(text)


def test_whole_table_against_all_pairs(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    check(documents, rows)


def test_edge_rows(make_docs):
    rows = [(5, None), (3, ""), (9, " \n"), (7, "one two"), (7, "one two"), (None, "a b c d e f"), (None, "a b c d e f"), (4, "A B C D E F"), (8, "x " * 30_000), (2, "one two")]
    check(make_docs(rows), rows)
    kept = S.deduplicate(make_docs(rows))
    assert kept.columns == make_docs(rows).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 3, 4, 8]


def test_empty_table(make_docs):
    assert S.near_duplicates(make_docs([])).count() == 0
    assert S.deduplicate(make_docs([])).count() == 0


def near_fingerprints(seed, n, flips):
    rng = np.random.default_rng(seed)
    base = int(rng.integers(0, 1 << 63))
    out = {base}
    while len(out) < n:
        x = base
        for b in rng.choice(64, rng.integers(0, flips + 1), replace=False):
            x ^= 1 << int(b)
        out.add(x)
    return sorted(out | {int(x) for x in rng.integers(0, 1 << 63, n)})


def brute_roots(fps, distance):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if bin(a ^ b).count("1") <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


signed = lambda x: x - (1 << 64) if x >> 63 else x


@pytest.mark.parametrize("distance", [1, 2, 3])
@pytest.mark.parametrize("limit", [S.BUCKET_LIMIT, 4])
def test_links_connect_what_the_distance_connects(spark, distance, limit):
    """Also when buckets are over the limit and meet at shared points."""
    fps = near_fingerprints(distance, 120, 4)
    groups = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    links = [(r["a"], r["b"]) for r in S.linked(groups, distance, limit=limit).collect()]
    assert all(bin((a ^ b) & (1 << 64) - 1).count("1") <= 64 for a, b in links)
    want = brute_roots(fps, distance)
    root = {signed(f): signed(f) for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    classes = lambda r: {frozenset(k for k in r if r[k] == v) for v in r.values()}
    assert classes({f: find(f) for f in root}) == {frozenset(map(signed, c)) for c in classes(want)}


@pytest.mark.parametrize("plan", [[(range(0, 32), 1), (range(32, 64), 0)], [(range(0, 20), -1), (range(20, 40), 1), (range(40, 64), 0)], [(range(64), 2)]])
def test_any_allocation_finds_every_pair(plan):
    """Sum of thresholds = distance - partitions + 1 loses no pair."""
    masks = S.masks([p for p in plan if p[1] >= 0])
    rng = np.random.default_rng(1)
    for _ in range(300):
        a = int(rng.integers(0, 1 << 63))
        b = a
        for bit in rng.choice(64, rng.integers(0, 3), replace=False):
            b ^= 1 << int(bit)
        hit = any((a & m) == (b & m) for m in (x & (1 << 64) - 1 for x in masks))
        if len([p for p in plan if p[1] < 0]) == 0:
            assert hit


def test_allocation_sums_and_correlated_bits():
    rng = np.random.default_rng(0)
    bits = rng.random((4000, 64)) < 0.5
    bits[:, 40:52] = bits[:, [3]]  # thirteen bits that go together
    together = bits.T.astype(float) @ bits
    groups = S.group_bits(len(bits), together, 3)
    assert sorted(sum(groups, [])) == list(range(64))
    assert any({3, *range(40, 52)} <= set(g) for g in groups)
    for distance in (1, 2, 3):
        plan = S.allocate(10**6, together, distance)
        # skipped partitions have threshold -1
        assert any(sum(t for _, t in plan) - (m - len(plan)) == distance - m + 1 for m in range(len(plan), distance + 2))
        assert all(t >= 0 for _, t in plan)
    # the partition of correlated bits brings the most candidates
    shares = [S.within(len(bits), together, g, 2)[0] for g in groups]
    assert max(range(3), key=shares.__getitem__) == next(i for i, g in enumerate(groups) if 3 in g)


def test_estimate_matches_independent_bits():
    rng = np.random.default_rng(3)
    bits = rng.random((3000, 64)) < 0.5
    got = S.within(len(bits), bits.T.astype(float) @ bits, list(range(10)), 2)
    assert got == pytest.approx([1 / 1024, 11 / 1024, 56 / 1024], rel=0.1)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 600)], "a long, b long")
    got = {r["node"]: r["root"] for r in S.components(links).collect()}
    assert got == {**dict.fromkeys(range(201), 0), 500: 500, 600: 500}
