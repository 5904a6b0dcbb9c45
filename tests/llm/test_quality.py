import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from basketry.llm import quality as Q
from basketry.llm import registry
from basketry.llm.registry import BYTE_VOCABULARY, PIECE_VOCABULARY

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_base(text):
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + d for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for d in range(3)}
    seen, dups = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dups += line in seen
            seen.add(line)
    n = len(words)
    return n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dups, len(covered), n < 50 or 100 * len(covered) > 50 * n


def base(r):
    return r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]


def test_whole_table_against_brute_force(spark, documents):
    from tokenizers import Tokenizer
    import sentencepiece

    tok = Tokenizer.from_file(BYTE_VOCABULARY)
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE_VOCABULARY)
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    got = registry.op1_quality(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        text = texts[r["doc_id"]] or ""
        assert base(r) == brute_base(text)
        ids = tok.encode(text, add_special_tokens=False).ids
        pieces = [i for w in WORD.findall(text) for i in sp.encode(w)]
        chars = r["word_chars"] - r["n_symbols"]
        assert r["n_tokens"] == len(ids)
        if len(ids) > 1 and pieces:
            assert r["chars_per_token"] == pytest.approx(chars / len(ids))
            assert r["piece_chars"] == pytest.approx(chars / len(pieces))
            assert r["fallback_share"] == pytest.approx(sum(map(sp.is_byte, pieces)) / len(pieces))
            p = np.array(list(Counter(ids).values())) / len(ids)
            assert r["token_entropy"] == pytest.approx(-(p * np.log2(p)).sum() / np.log2(len(ids)))
        assert r["kept"] == (r["reasons"] == "")
        assert not (r["base_failed"] and r["kept"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "c", "dd"]), max_size=40))
def test_repeated_words(words):
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    want = brute_base(" ".join(words))[4]
    assert Q.repeated_words(np.array([numbers[w] for w in words], np.int64)) == want
    assert Q.repeated_words(np.array([numbers[w] + (1 << 30) for w in words], np.int64)) == want


PROSE = "The committee agreed that the report should be published before the end of the year and that every member would receive a copy . "


def test_bands_reject_noise_and_keep_prose(make_docs):
    rng = np.random.default_rng(0)
    letters = list("bcdfghjklmnpqrstvwxz0123456789")
    noise = " ".join("".join(rng.choice(letters, 9)) for _ in range(200))
    words = sorted({w for w in PROSE.split()})
    prose = " ".join(rng.permutation(words * 12))
    symbols = " ".join(w + "&&&***" for w in rng.permutation(words * 12))
    cyr = " ".join("".join(rng.choice(list("абвгдежзиклмнопрст"), 6)) for _ in range(300))
    rows = [(1, prose), (2, noise), (3, symbols), (4, prose, None), (5, prose, "xx"), (6, cyr, "ru"), (7, " " * 120, None)]
    got = {r["doc_id"]: r for r in Q.quality(make_docs(rows), BYTE_VOCABULARY, PIECE_VOCABULARY).collect()}
    assert got[1]["kept"] and got[4]["kept"] and got[5]["kept"]
    assert not got[2]["kept"] and "chars_per_token" in got[2]["reasons"]
    assert not got[3]["kept"]
    assert (got[4]["band"], got[6]["band"], got[7]["band"]) == ("Latin", "Cyrillic", "other")


def test_edge_rows(make_docs):
    rows = [(1, None), (2, ""), (3, " \n\t"), (None, "a"), (4, "a b c " * 30_000), (4, "a b c " * 30_000), (5, "日本語 " * 60, None), (6, "x" * 300_000 + " y" * 60), (7, "é\x1cé\xa0é " * 60)]
    docs = make_docs(rows)
    got = Q.quality(docs, BYTE_VOCABULARY, PIECE_VOCABULARY).collect()
    want = sorted(((r[0] or 0), *brute_base(r[1] or "")) for r in rows)
    assert sorted(((r["doc_id"] or 0), *base(r)) for r in got) == want
    kept = Q.keep_quality(docs, BYTE_VOCABULARY, PIECE_VOCABULARY)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["kept"] for r in got)


def test_empty_table(make_docs):
    assert Q.quality(make_docs([]), BYTE_VOCABULARY, PIECE_VOCABULARY).count() == 0
    assert Q.keep_quality(make_docs([]), BYTE_VOCABULARY, PIECE_VOCABULARY).count() == 0


def test_good_labelled_documents_are_kept(spark):
    """Held-out size: the bands were fitted on another table."""
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    judged = registry.op1_quality(spark, sf).where("not base_failed").join(labels, "doc_id")
    by = {r["quality"]: (r["n"], r["kept"]) for r in judged.groupBy("quality").agg({"*": "count", "kept": "max"}).selectExpr("quality", "`count(1)` as n", "`max(kept)` as kept").collect()}
    good = judged.where("quality = 1").count()
    assert judged.where("quality = 1 and kept").count() >= 0.995 * good
    assert judged.where("quality = 0 and kept").count() <= 0.2 * by[0][0]
