from pathlib import Path

import pytest

from basketry.llm import licenses as L
from basketry.llm.license_texts import DIGESTS, NOTICES, TEXTS
from pyspark.sql import functions as F


def found(docs):
    return sorted(((r["doc_id"] or 0, r["line"], r["license"]) for r in L.scan(docs).collect()))


def test_variants_of_one_text(make_docs):
    mit = TEXTS[0][1]
    changed = "Copyright (c) 2021 Some Body\nAll rights reserved.\n\n" + mit.upper().replace(" ", "\n  ", 40).replace('"', "'").replace(",", "")
    commented = "\n".join("# " + line for line in ("MIT Licence\n\nCopyright 2020 X\n\n" + mit).split("\n"))
    assert found(make_docs([(1, mit), (2, changed), (3, commented), (4, mit + " More."), (5, mit.replace("without restriction", "with restriction"))])) == [(1, 0, "MIT"), (2, 0, "MIT"), (3, 0, "MIT")]


def test_every_known_text_is_found_and_no_digest_has_two_licences(spark, make_docs):
    every = [(i, t) for i, (_, t) in enumerate((*TEXTS, *NOTICES))]
    got = {(r["doc_id"], r["license"]) for r in L.scan(make_docs(every)).where("line = 0").collect()}
    assert got == {(i, n) for i, (n, _) in enumerate((*TEXTS, *NOTICES))}
    assert all(L.CLUE in t.lower() for _, t in NOTICES)
    assert L.known_digests(spark).groupBy("digest").count().where("count > 1").count() == 0


def test_spellings_and_lines(make_docs):
    text = "Some prose.\nThis project is licenced under the MIT Licence\nmore\n * Licensed under CC BY-NC 4.0\n"
    assert found(make_docs([(7, text)])) == [(7, 2, "MIT"), (7, 4, "CC-BY-NC-4.0")]


def test_edge_rows(make_docs):
    notice = "Released under the MIT License."
    rows = [(1, None), (2, ""), (None, notice), (3, notice), (3, notice), (4, "x " * 200_000 + "\n" + notice)]
    assert found(make_docs(rows)) == [(0, 0, "MIT"), (0, 1, "MIT"), (3, 0, "MIT"), (3, 0, "MIT"), (3, 1, "MIT"), (3, 1, "MIT"), (4, 2, "MIT")]
    assert found(make_docs([])) == []


def test_native_and_own_table(spark, make_docs):
    known = spark.createDataFrame([("hello  WORLD!", "own")], "text string, license string").select(L.digest(F.col("text")).alias("digest"), "license")
    out = L.scan(make_docs([(1, "Hello, world")]), known=known)
    assert [(r["line"], r["license"]) for r in out.collect()] == [(0, "own")]
    plan = L.scan(make_docs([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


COPYRIGHTS = [
    "Copyright The Kubernetes Authors.",
    "Copyright Jane Doe",
    "Copyright: 2020 X",
    "Copyright, 2019 Y",
    "Portions Copyright (c) 2001 Z",
    "(C) Foo Corp 2001",
    "(c) Foo Corp",
    "Copyright <YEAR> <OWNER>",
    "Copyright [yyyy] [name of copyright owner]",
    " * Copyright by Some Body",
    "© Some Body",
]
WORDING = [
    "copyright notice and this", "copyright notices, and", "COPYRIGHT HOLDERS BE LIABLE", "copyright owner or", "copyright license to", "copyright law: that is",
    "copyright", "copyright, patent, trademark, and", "copyrighted works", "copyright-like rights", "copyright the software, and", "(c) You must retain, in the Source",
    "(c) the licenses granted in this", "(c) under Patent Claims", "(c)    Representations.",
]


def test_copyright_lines(spark, make_docs):
    mit = TEXTS[0][1]
    assert found(make_docs([(i, f"{c}\n\n{mit}") for i, c in enumerate(COPYRIGHTS, 1)])) == [(i, 0, "MIT") for i in range(1, len(COPYRIGHTS) + 1)]
    kept = spark.createDataFrame([(w,) for w in WORDING], "t string").select(L.canonical(F.concat(F.lit("x\n"), "t", F.lit("\ny"))).alias("c"), "t").collect()
    assert [r["t"] for r in kept if r["c"] == "x y"] == []


def test_wrapped_texts_keep_their_wording(make_docs):
    """Lines broken in front of every "copyright" inside a known text."""
    rows = [(i, t.replace(" copyright", "\ncopyright").replace(" COPYRIGHT", "\nCOPYRIGHT")) for i, (_, t) in enumerate(TEXTS, 1)]
    assert [(i, n) for i, line, n in found(make_docs(rows)) if line == 0] == [(i, n) for i, (n, _) in enumerate(TEXTS, 1)]


COMMON = Path("/usr/share/common-licenses")


@pytest.mark.skipif(not COMMON.is_dir(), reason="no common licences here")
def test_common_licences(make_docs):
    """Whole files, and what stands up to the end of the terms, are found."""
    rows, want = [], []
    for i, (name, _, source) in enumerate(DIGESTS, 1):
        file, _, end = source.partition(" up to ")
        if not (COMMON / file).exists():
            assert name == "Artistic-2.0"
            continue
        text = (COMMON / file).read_text()
        rows.append((i, text[: text.index(end) + len(end)] if end else "Copyright The Authors of This\n\n" + text))
        want.append((i, 0, name))
    assert len(want) >= 20
    assert [x for x in found(make_docs(rows)) if x[1] == 0] == want


def test_oracle_knows_all_forms_and_digests(make_docs):
    """The SQL on texts that need every form of copyright line and the digests."""
    import duckdb

    mit = TEXTS[0][1]
    rows = [f"{c}\n\n{mit}" for c in COPYRIGHTS] + [f"x\n{w}\n{mit}" for w in WORDING] + [f"{w}\n{n}" for w in WORDING for _, n in NOTICES[:3]] + [t for _, t in TEXTS]
    if COMMON.is_dir():
        for _, _, source in DIGESTS:
            file, _, end = source.partition(" up to ")
            if (COMMON / file).exists():
                text = (COMMON / file).read_text()
                rows.append(text[: text.index(end) + len(end)] if end else "Copyright The Authors of This\n\n" + text)
    docs = make_docs(list(enumerate(rows, 1)), extra=False)
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    want = sorted(con.sql(L.oracle_sql()).fetchall())
    assert sorted((r["doc_id"], r["line"], r["license"], r["digest"]) for r in L.scan(docs).collect()) == want
    assert len(want) > len(COPYRIGHTS) + len(DIGESTS) + len(TEXTS) - 2
