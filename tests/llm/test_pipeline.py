"""The pipeline stage by stage against brute force, and its odd inputs."""


import numpy as np
import pytest

import corpus_pipeline as P
from basketry.llm import secrets
from test_packing import gapless, pieces_of
from test_quality import PROSE, brute_base
from test_simhash import brute_components

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage got and gave, written and read again."""
    folder = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in P.STAGES:
        path = str(folder / name)
        stage(spark, docs, SF).write.parquet(path)
        given, docs = docs, spark.read.parquet(path)
        out[name] = (given.collect(), docs.collect(), docs.columns)
    return out


def test_order_and_columns(stages):
    assert [n for n, _ in P.STAGES] == ["quality", "dedup", "secrets", "mix", "pack"]
    for name in ("quality", "dedup", "secrets", "mix"):
        assert stages[name][2] == COLUMNS


def test_quality(stages):
    given, kept, _ = stages["quality"]
    assert set(kept) <= set(given)
    gone = set(given) - set(kept)
    assert all(not brute_base(r["text"])[5] for r in kept)
    assert {r for r in given if brute_base(r["text"])[5]} <= gone


def test_dedup(stages):
    given, kept, _ = stages["dedup"]
    rows = [(r["doc_id"], r["text"]) for r in given]
    _, component = brute_components(rows)
    assert sorted(r["doc_id"] for r in kept) == sorted(set(component.values()))
    assert set(kept) <= set(given)


def test_secrets(stages):
    given, kept, _ = stages["secrets"]
    by_id = {r["doc_id"]: r for r in kept}
    assert len(kept) == len(given)
    for r in given:
        other = by_id[r["doc_id"]]
        if not secrets.spans(r["text"]):
            assert other["text"] == r["text"]
        else:
            assert not [s for s in secrets.spans(other["text"]) if s.kind in ("access", "hex")]
        assert other["n_chars"] == len(other["text"])


def test_mix(stages):
    given, kept, _ = stages["mix"]
    copies = {r: kept.count(r) for r in given}
    assert sum(copies.values()) == len(kept) and max(copies.values()) <= 3


def test_pack(stages):
    given, rows, _ = stages["pack"]
    want = sorted((r["doc_id"], *p) for r in given for p in pieces_of(r["text"]))
    assert sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    gapless(rows)


def test_run_is_the_stages(spark, stages):
    got = P.run(spark, SF)
    key = lambda r: (r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"])
    assert sorted(map(key, got.collect())) == sorted(map(key, stages["pack"][1]))


def test_odd_rows_and_empty_table(make_docs, spark, tmp_path):
    prose = " ".join(np.random.default_rng(0).permutation(sorted(set(PROSE.split())) * 12))
    rows = [(1, None), (2, ""), (None, prose), (None, prose), (3, prose + " end"), (3, prose + " end"), (4, "x " * 100_000), (5, prose.upper(), None, None), (6, "日本語 " * 80, "ja", None)]
    for n, table in (("odd", make_docs(rows)), ("none", make_docs([]))):
        path = str(tmp_path / n)
        table.write.parquet(f"{path}/documents.parquet")
        out = P.run(spark, path)
        assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
        assert (out.count() == 0) == (n == "none")
