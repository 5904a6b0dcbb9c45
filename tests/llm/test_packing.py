import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from basketry.llm import packing as P
from basketry.llm import registry
from basketry.llm.registry import WORD_VOCABULARY

SF = "/root/testdata/sf0.001"
TOK = Tokenizer.from_file(WORD_VOCABULARY)
TOK.encode_special_tokens = True


def ids_of(text):
    return np.array(TOK.encode(text or "", add_special_tokens=False).ids + [0], "<u4")


def pieces_of(text, capacity=2048):
    ids = ids_of(text)
    return [(n, s, len(ids[s : s + capacity]), zlib.crc32(ids[s : s + capacity].tobytes())) for n, s in enumerate(range(0, len(ids), capacity))]


def gapless(rows, capacity=2048):
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_whole_table(spark, documents):
    rows = registry.op4_packing(spark, SF).collect()
    want = sorted((r["doc_id"], *p) for r in documents.collect() for p in pieces_of(r["text"]))
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    used = gapless(rows)
    assert used <= 1.05 * sum(r["length"] for r in rows) / 2048 + 2


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=60), st.integers(1, 5))
def test_bins_against_a_plain_search(sizes, most):
    """The open bin with the least room that is enough; else a new one, the
    fullest closing first when all places are taken."""
    bins = P.OpenBins(20, most)
    open_ = {}
    for size in sizes:
        fits = [f for f in open_.values() if f >= size]
        number, offset = bins.place(size)
        if fits:
            assert 20 - offset == min(fits) == open_[number]
        else:
            assert offset == 0
            if len(open_) == most:
                fullest = min(open_.values())
                gone = [b for b in open_ if open_[b] == fullest and b not in sum(bins.bins.values(), [])]
                assert len(gone) == 1
                del open_[gone[0]]
        left = 20 - offset - size
        open_.pop(number, None)
        if left:
            open_[number] = left
        assert len(open_) <= most


def test_edge_rows(make_docs):
    rows = [(1, None), (2, ""), (2, ""), (None, "a b"), (3, "hello world " * 3000), (4, "日本 " * 10)]
    got = P.pack(make_docs(rows), WORD_VOCABULARY).collect()
    want = sorted((r[0] or 0, *p) for r in rows for p in pieces_of(r[1]))
    assert sorted((r["doc_id"] or 0, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    gapless(got)
    assert P.pack(make_docs([]), WORD_VOCABULARY).count() == 0


def test_sequences_hold_the_ids(documents):
    pieces = P.pack(documents, WORD_VOCABULARY, with_ids=True, capacity=512)
    rows = {(r["sequence_id"], r["offset"]): r["ids"] for r in pieces.collect()}
    for r in P.sequences(pieces).collect():
        own = sorted((o, ids) for (s, o), ids in rows.items() if s == r["sequence_id"])
        assert r["ids"] == [i for _, ids in own for i in ids]
        assert len(r["ids"]) <= 512 and r["n_pieces"] == len(own)


@pytest.mark.parametrize("parts", [1, 5])
def test_rerun_is_the_same(documents, parts):
    once = P.pack(documents.repartition(parts, "doc_id").sortWithinPartitions("doc_id"), WORD_VOCABULARY)
    total = lambda: once.agg(F.sum(F.xxhash64(*once.columns).cast("decimal(38,0)"))).first()[0]
    assert total() == total()
