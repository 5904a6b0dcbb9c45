"""WARC revisit records: what a 304 Not Modified stands for.

A crawler that gets "not modified" stores a revisit record without payload.
:func:`resolve_revisits` finds the latest earlier full response of the same
canonical URL, checks that the validators agree, and merges the headers a 304
may update into the stored ones.

The as-of join has two levels, since one URL may hold a third of all records:
rows are grouped by URL and time block; the last response of each earlier
block is carried over from one row per block; only a block's rows are sorted
together.  Of the records it sees the URL key, time and validators, and a
revisit's own headers; they are written once, since two passes read them.
Stored headers and payloads take no part in the join: they are fetched by
record id for the revisits that are resolved.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.session import materialize

#: Headers that a 304 updates in the stored response.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
#: Length of the time blocks of a URL's records.
BLOCK_SECONDS = 600
_TRACKING = "utm_[a-z]+|gclid|fbclid|ref"


def canonical_url(url: Column) -> Column:
    """Scheme, ``www.`` or ``m.``, default port, fragment, tracking parameters
    and trailing slashes dropped, host in lower case.  Only URLs that have
    parameters take the patterns for them."""
    bare = F.substring_index(F.regexp_replace(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://", ""), "#", 1)
    host = F.substring_index(F.substring_index(bare, "/", 1), "?", 1)
    path = F.substr(bare, F.length(host) + 1)
    host = F.lower(host)
    for mark in ("www.", "m."):
        host = F.when(F.startswith(host, F.lit(mark)), F.concat(F.lit("\n"), F.substr(host, F.lit(len(mark) + 1)))).otherwise(host)
    host = F.ltrim(host, F.lit("\n"))  # one of the two marks goes
    for port in (":80", ":443"):
        host = F.when(F.endswith(host, F.lit(port)), F.substr(host, F.lit(1), F.length(host) - len(port))).otherwise(host)
    plain = F.regexp_replace(path, rf"([?&])({_TRACKING})=[^&]*", "$1")
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(plain, r"&+", "&"), r"\?&", "?"), r"[?&]+$", "")
    path = F.when(F.contains(path, F.lit("?")) | F.contains(path, F.lit("&")), plain).otherwise(path)
    return F.concat(host, F.rtrim(path, F.lit("/")))


def header_pairs(block: Column) -> Column:
    """array<struct<name, value>> of a header block of "Name: value" lines,
    names in lower case and once each; values of a repeated name are joined by
    ", ".  Null: an empty array."""
    lines = F.filter(F.split(F.coalesce(block, F.lit("")), r"\r?\n"), lambda x: F.instr(x, ":") > 1)
    pair = lambda name, value: F.struct(name.alias("name"), value.alias("value"))
    pairs = F.transform(lines, lambda x: pair(F.lower(F.trim(F.substring_index(x, ":", 1))), F.trim(F.substr(x, F.instr(x, ":") + 1))))
    names = F.array_distinct(F.transform(pairs, lambda p: p["name"]))
    joined = F.transform(names, lambda n: pair(n, F.array_join(F.transform(F.filter(pairs, lambda p: p["name"] == n), lambda p: p["value"]), ", ")))
    return F.when(F.size(names) == F.size(pairs), pairs).otherwise(joined)


def header_value(block: Column, name: str) -> Column:
    """The value that ``header_pairs`` has for ``name``, by one pattern; null
    if there is none."""
    found = F.regexp_extract_all(block, F.lit(rf"(?imd)^ *{re.escape(name)} *: *(.*?) *\r?$"), F.lit(1))
    return F.when(F.size(found) > 0, F.array_join(found, ", "))


def header_text(pairs: Column) -> Column:
    """"name: value" lines in the order of the names."""
    return F.array_join(F.transform(F.array_sort(pairs), lambda p: F.concat(p["name"], F.lit(": "), p["value"])), "\n")


def merge_headers(stored: Column, update: Column, permitted: tuple[str, ...] = PERMITTED) -> Column:
    """``stored`` with the permitted ones of ``update`` put in their place."""
    allowed = F.filter(update, lambda p: p["name"].isin(*permitted))
    names = F.transform(allowed, lambda p: p["name"])
    return F.concat(F.filter(stored, lambda p: ~F.array_contains(names, p["name"])), allowed)


def _weak(etag: Column) -> Column:
    """ETags compare without their weakness mark."""
    return F.when(F.startswith(etag, F.lit("W/")), F.substr(etag, F.lit(3))).otherwise(etag)


def resolve_revisits(records: DataFrame, block_seconds: int = BLOCK_SECONDS) -> DataFrame:
    """One row per revisit record of ``records`` (record_id, type, url, date
    timestamp, headers string, payload of any type): its record_id, canonical, refers_to,
    outcome, headers (text) and payload.

    outcome: "resolved"; "mismatch" if the latest earlier response has another
    validator (ETag if both have one, else Last-Modified); "no_validator" if
    there is none to compare; "no_response" if the URL, or the date, is null
    or no full response is strictly earlier.  Only resolved rows have the
    merged headers and the payload; refers_to names the response also when
    validators fail.  Of responses at one instant the one with the greatest
    record_id counts.  Repeated rows are resolved alike, provided record ids
    of responses are unique; an empty table gives no rows."""
    slim = records.where(F.col("type").isin("response", "revisit")).select(
        "record_id",
        (F.col("type") == "revisit").alias("revisit"),
        canonical_url(F.col("url")).alias("canonical"),
        F.unix_micros(F.col("date").cast("timestamp")).alias("at"),
        _weak(header_value(F.col("headers"), "etag")).alias("etag"),
        header_value(F.col("headers"), "last-modified").alias("modified"),
        F.when(F.col("type") == "revisit", F.col("headers")).alias("update"),
    )
    slim = materialize(slim.withColumn("block", F.floor(F.col("at") / (block_seconds * 1_000_000))), "captures")
    # without URL or date there is no earlier response: such records, of which
    # there may be many, stay out of the grouping
    apart = F.col("canonical").isNull() | F.col("at").isNull()
    timed = slim.where(~apart)
    response = F.when(~F.col("revisit"), F.struct("at", "record_id", "etag", "modified"))
    last = timed.groupBy("canonical", "block").agg(F.max(response).alias("last"))
    before = Window.partitionBy("canonical").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(F.col("canonical").alias("c"), F.col("block").alias("b"), F.max("last").over(before).alias("carried"))
    placed = timed.join(carried, (F.col("canonical") == F.col("c")) & (F.col("block") == F.col("b")), "left")
    earlier = Window.partitionBy("canonical", "block").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    found = placed.withColumn("base", F.coalesce(F.max(response).over(earlier), "carried")).where("revisit")
    by_tag = F.col("etag").isNotNull() & F.col("base.etag").isNotNull()
    by_date = F.col("modified").isNotNull() & F.col("base.modified").isNotNull()
    outcome = (
        F.when(F.col("base").isNull(), "no_response")
        .when(by_tag, F.when(F.col("etag") == F.col("base.etag"), "resolved").otherwise("mismatch"))
        .when(by_date, F.when(F.col("modified") == F.col("base.modified"), "resolved").otherwise("mismatch"))
        .otherwise("no_validator")
    )
    decided = found.select("record_id", "canonical", F.col("base.record_id").alias("refers_to"), outcome.alias("outcome"), "update")
    lone = slim.where(apart & F.col("revisit")).select("record_id", "canonical", F.lit(None).cast("string").alias("refers_to"), F.lit("no_response").alias("outcome"), "update")
    stored = records.where("type = 'response'").select(F.col("record_id").alias("r"), F.col("headers").alias("stored"), "payload")
    done = decided.union(lone).join(stored, (F.col("refers_to") == F.col("r")) & (F.col("outcome") == "resolved"), "left")
    merged = header_text(merge_headers(header_pairs(F.col("stored")), header_pairs(F.col("update"))))
    return done.select("record_id", "canonical", "refers_to", "outcome", F.when(F.col("r").isNotNull(), merged).alias("headers"), "payload")


def page_captures(pages: DataFrame) -> DataFrame:
    """WARC records derived from a table of pages (page_id, url, html): per
    page two full responses of different versions and two revisits, at times
    spread over some days so that they come in any order."""
    n = F.col("n")
    version = F.when(n < 2, 0).otherwise(1)
    changed = F.concat("html", F.lit("<!-- 2 -->"))
    payload = F.when(version == 0, F.col("html")).otherwise(changed)
    tag = F.substring(F.when(version == 0, F.col("md5_0")).otherwise(F.col("md5_1")), 1, 16)
    stamp = (F.lit(1_700_000_000) + F.pmod(F.col("page_id") * 7919 + n * 104_729, F.lit(400_000))).cast("long")
    revisit = n % 2 == 1
    lines = [
        F.concat(F.lit("Date: "), stamp.cast("string")),
        F.when(F.pmod("page_id", F.lit(11)) != 0, F.concat(F.when(revisit, "ETag: W/\"").otherwise("ETag: \""), tag, F.lit('"'))),
        F.when(F.pmod("page_id", F.lit(22)) != 0, F.concat(F.lit("Last-Modified: "), version.cast("string"))),
        F.concat(F.lit("Cache-Control: max-age="), (n * 60).cast("string")),
        F.concat(F.lit("Content-Type: text/"), F.when(revisit, "plain").otherwise("html")),
    ]
    url = F.when(revisit, F.concat(F.col("url"), F.lit("#again"))).otherwise(F.col("url"))
    hashed = pages.select("page_id", "url", "html", F.md5("html").alias("md5_0"), F.md5(changed).alias("md5_1"))
    return hashed.select("*", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("n")).select(
        F.concat(F.col("page_id").cast("string"), F.lit("-"), n.cast("string")).alias("record_id"),
        F.when(revisit, "revisit").otherwise("response").alias("type"),
        url.alias("url"),
        F.timestamp_seconds(stamp).alias("date"),
        F.concat_ws("\r\n", *lines).alias("headers"),
        F.when(~revisit, payload).alias("payload"),
    )
