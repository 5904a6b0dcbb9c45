import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from basketry.llm import idcoder as C
from basketry.llm import registry
from basketry.llm import tokenfile as F
from basketry.llm.registry import BYTE_VOCABULARY
from basketry.session import shared_dir

SF = "/root/testdata/sf0.001"
TOK = Tokenizer.from_file(BYTE_VOCABULARY)
TOK.encode_special_tokens = True


def ids_of(text):
    return TOK.encode(text or "", add_special_tokens=False).ids + [2]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 65535), st.integers(0, 3)), max_size=400), st.integers(1, 150))
def test_round_trip(ids, block):
    ids = np.array(ids, np.uint32)
    blocks = C.encode_blocks(ids, block)
    assert len(blocks) == -(-len(ids) // block)
    back = C.decode_blocks(blocks)
    assert np.concatenate([ids[:0], *back]).tolist() == ids.tolist()


@pytest.mark.parametrize("kind", ["same", "random", "cycle", "zipf"])
def test_long_blocks_and_size(kind):
    rng = np.random.default_rng(0)
    n = 30_000
    ids = {"same": np.full(n, 7), "random": rng.integers(0, 65536, n), "cycle": np.arange(n) % 97 * 300, "zipf": rng.zipf(1.5, n) % 50_000}[kind].astype(np.uint32)
    blocks = C.encode_blocks(ids, 10_000)
    assert np.concatenate(C.decode_blocks(blocks)).tolist() == ids.tolist()
    bits = 8 * sum(map(len, blocks)) / n
    assert bits < {"same": 0.2, "random": 19, "cycle": 1.5, "zipf": 8}[kind]


def test_blocks_stand_alone():
    """Any block decodes without the others, in any order and company."""
    ids = np.random.default_rng(1).zipf(1.3, 5000).astype(np.uint32) % 50_000
    blocks = C.encode_blocks(ids, 700)
    assert C.decode_blocks(blocks[3:4])[0].tolist() == ids[2100:2800].tolist()
    mixed = [blocks[7], blocks[0], C.encode_blocks(ids[:5] + np.uint32(1 << 20), 10)[0], blocks[2]]
    assert [x.tolist() for x in C.decode_blocks(mixed)] == [ids[4900:].tolist(), ids[:700].tolist(), (ids[:5] + (1 << 20)).tolist(), ids[1400:2100].tolist()]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 2**32 - 1), st.integers(65534, 65538), st.integers(0, 3)), max_size=300), st.integers(1, 90))
def test_wide_ids(ids, block):
    """Ids of any 32 bits, alone or beside narrow ones, repeated and new."""
    ids = np.array(ids * 2, np.uint32)
    assert np.concatenate([ids[:0], *C.decode_blocks(C.encode_blocks(ids, block))]).tolist() == ids.tolist()


def test_more_different_ids_than_the_list_holds():
    ids = np.concatenate((np.arange(9000), np.arange(9000)[::-1], np.arange(0, 9000, 3))).astype(np.uint32) * 7
    assert np.concatenate(C.decode_blocks(C.encode_blocks(ids, ids.size))).tolist() == ids.tolist()


@pytest.mark.parametrize("at", [0, 4, 8, 12, 16, 20, 25, 40, -1])
def test_damage_is_noticed(at):
    block = bytearray(C.encode_blocks(np.arange(300, dtype=np.uint32) * 7, 300)[0])
    block[at] ^= 0x55
    with pytest.raises(C.CorruptBlock):
        C.decode_blocks([bytes(block)])
    with pytest.raises(C.CorruptBlock):
        C.decode_blocks([bytes(block[:-4])])


def want_of(rows):
    out, start = [], 0
    for key, text in rows:
        ids = np.array(ids_of(text), "<u4")
        out.append((key, start, len(ids), zlib.crc32(ids)))
        start += len(ids)
    return out


def test_whole_table(spark, documents):
    rows = sorted((r["doc_id"], r["text"]) for r in documents.collect())
    got = registry.op9_token_file(spark, SF).collect()
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got) == want_of(rows)


def test_small_segments_and_edge_rows(spark, make_docs):
    rows = [(4, "four"), (None, "null key"), (1, None), (9, "nine " * 5000), (2, ""), (7, "sev#en"), (-3, "日本 <|endoftext|>")]
    path = shared_dir(spark, "ids")
    F.write_ids(make_docs(rows).repartition(3), path, BYTE_VOCABULARY, segment_ids=8, block=100)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    got = F.read_ids(spark, path).collect()
    assert sorted((r["start"], r["ids"]) for r in got) == sorted((w[1], ids_of(t)) for w, (_, t) in zip(want_of(ordered), ordered))
    assert {r["doc_id"]: r["start"] for r in got} == {w[0]: w[1] for w in want_of(ordered)}


def test_repeated_keys_and_empty_table(spark, make_docs):
    path = shared_dir(spark, "ids")
    F.write_ids(make_docs([(1, "a"), (1, "a"), (1, "b c d")]), path, BYTE_VOCABULARY)
    got = F.read_ids(spark, path).collect()
    assert sorted(r["ids"] for r in got) == sorted(map(ids_of, ["a", "a", "b c d"]))
    assert sorted(r["start"] for r in got)[0] == 0
    empty = shared_dir(spark, "ids")
    F.write_ids(make_docs([]), empty, BYTE_VOCABULARY)
    assert F.read_ids(spark, empty).count() == 0
