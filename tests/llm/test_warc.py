import datetime as dt

import pytest
from pyspark.sql import functions as F

from basketry.llm import warc as W

SCHEMA = "record_id string, type string, url string, date timestamp, headers string, payload string, canonical string, at long, base string, `a.b` string"
T0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def rec(rid, kind, url, hours, headers="", payload=None):
    return (rid, kind, url, None if hours is None else T0 + dt.timedelta(hours=hours), headers, payload, "x", 1, "x", "x")


@pytest.fixture
def resolve(spark):
    def run(rows, **more):
        out = W.resolve_revisits(spark.createDataFrame(rows, SCHEMA), **more).collect()
        return {r["record_id"]: (r["refers_to"], r["outcome"], r["headers"], r["payload"]) for r in out}

    return run


@pytest.mark.parametrize(
    "url, want",
    [
        ("HTTP://WWW.Ex.org:80/A/?utm_source=x&b=1#top", "ex.org/A/?b=1"),
        ("https://ex.org/A/?b=1&ref=y", "ex.org/A/?b=1"),
        ("https://m.ex.org/A/?utm_medium=1", "ex.org/A"),
        ("ex.org", "ex.org"),
        ("http://ex.org/?a=1&utm_id=2&c=3", "ex.org/?a=1&c=3"),
        ("https://www.m.ex.org:443", "m.ex.org"),
        ("http://www.ex.org:80:443//", "ex.org:80"),
        ("ex.org?b=1&&c=2&", "ex.org?b=1&c=2"),
        ("ex.org/a&utm_x=1", "ex.org/a"),
        ("wwwx.org:8080/?", "wwwx.org:8080"),
        (" ex.org/a//#x#y ", "ex.org/a"),
        ("", ""),
        (None, None),
    ],
)
def test_canonical_url(spark, url, want):
    assert spark.createDataFrame([(url,)], "u string").select(W.canonical_url(F.col("u")).alias("x")).first()["x"] == want


@pytest.mark.parametrize("block", ['ETag: "1"', ' etag :W/"1" \r\nX: y', "x: 1\nETAG: a\r\nEtag:  b  ", "etag:", "X-ETag: 1\r\nno etag: 2", "a: b\u2028etag: 3", "", None])
def test_header_value_is_that_of_the_pairs(spark, block):
    row = spark.createDataFrame([(block,)], "b string").select(W.header_value(F.col("b"), "etag").alias("one"), W.header_pairs(F.col("b")).alias("all")).first()
    assert row["one"] == dict(map(tuple, row["all"])).get("etag")


def test_latest_earlier_response_and_merge(resolve):
    rows = [
        rec("a", "response", "http://e.org/x", 0, 'ETag: "1"\r\nContent-Type: text/html\r\nExpires: old', "one"),
        rec("b", "response", "https://www.e.org/x/", 30, 'ETag: "2"\r\nContent-Type: text/html\r\nExpires: old\r\nX-A: 1\r\nX-A: 2', "two"),
        rec("c", "response", "http://e.org/x", 90, 'ETag: "3"', "three"),
        rec("v1", "revisit", "http://e.org/x#f", 10, 'etag: W/"1"\r\nContent-Type: none\r\nExpires: new'),
        rec("v2", "revisit", "http://e.org/x", 80, 'ETag: "2"\r\nDate: now\r\nConnection: close'),
        rec("v3", "revisit", "http://e.org/x", 85, 'ETag: "1"'),
        rec("v4", "revisit", "http://e.org/x", -1, 'ETag: "1"'),
        rec("v5", "revisit", "http://e.org/x", 30, 'ETag: "1"'),  # b is not earlier
        rec("v6", "revisit", "http://e.org/y", 99, 'ETag: "1"'),
        rec("v7", "revisit", "http://e.org/x", 99, "Date: now"),
        rec("m", "metadata", "http://e.org/x", 98, 'ETag: "9"', "no"),
    ]
    got = resolve(rows)
    assert got["v1"] == ("a", "resolved", 'content-type: text/html\netag: W/"1"\nexpires: new', "one")
    assert got["v2"] == ("b", "resolved", 'content-type: text/html\ndate: now\netag: "2"\nexpires: old\nx-a: 1, 2', "two")
    assert got["v3"] == ("b", "mismatch", None, None)
    assert got["v4"] == (None, "no_response", None, None)
    assert got["v5"][:2] == ("a", "resolved")
    assert got["v6"][:2] == (None, "no_response")
    assert got["v7"][:2] == ("c", "no_validator")
    assert len(got) == 7


def test_block_length_does_not_matter(resolve):
    rows = [rec(f"r{i}", "response", "e.org", 7 * i, f"Last-Modified: {i}", f"p{i}") for i in range(30)]
    rows += [rec(f"v{i}", "revisit", "e.org", 5 * i + 1, f"Last-Modified: {(5 * i + 1 - 1) // 7 if (5 * i + 1) % 7 else (5 * i + 1) // 7 - 1}") for i in range(30)]
    got = resolve(rows)
    assert all(x[1] == "resolved" for x in got.values())
    assert got == resolve(rows, block_seconds=60) == resolve(rows, block_seconds=10**9)


def test_edge_rows(resolve):
    rows = [
        rec("a", "response", "e.org", 0, 'ETag: "1"', "one"),
        rec("b", "response", "e.org", 0, 'ETag: "2"', "two"),
        rec("n", "response", None, 0, 'ETag: "1"', "no"),
        rec("nd", "response", "e.org", None, 'ETag: "1"', "no"),
        rec("v", "revisit", "e.org", 1, 'ETag: "2"'),
        rec("v", "revisit", "e.org", 1, 'ETag: "2"'),
        rec("u", "revisit", None, 1, 'ETag: "1"'),
        rec("d", "revisit", "e.org", None, 'ETag: "1"'),
        rec(None, "revisit", "e.org", 2, None),
        rec("z", None, "e.org", 2, None),
        rec("long", "revisit", "e.org", 3, "X: " + "y" * 100_000 + '\r\nETag: "2"\r\nbroken line\r\n: none'),
    ]
    got = resolve(rows)
    assert got["v"][:2] == ("b", "resolved")  # the greater id of one instant
    assert got["u"][1] == got["d"][1] == "no_response"
    assert got[None][:2] == ("b", "no_validator")
    assert got["long"][1] == "resolved"
    assert resolve([]) == {}
