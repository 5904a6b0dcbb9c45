"""Licence scan by canonical digests.

DataFrame functions only.  A text is brought to a canonical form (copyright
lines and list or comment marks dropped, lower case, punctuation removed,
equivalent spellings made one) and hashed; the digest is joined with those of
known licences.  Units are the whole text, and each line that mentions a
licence, so one-line notices inside a document are found by the same lookup.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm.license_texts import DIGESTS, NOTICES, TEXTS

#: Words that go on from "copyright" in licence wording; such lines stay.
_WORDING = (
    "notices?|holders?|owners?(?:hip)?|licen[cs]e[ds]?|laws?|statements?|interests?|disclaimers?|permissions?|treat(?:y|ies)|doctrines?|"
    "protections?|claims?|rights?|terms?|infringements?|patents?|trademarks?|assignments?|information|act|like|"
    "and|or|of|on|in|is|are|if|to|that|which|resulting|the[ \t]+(?:software|library|program)[ \t]*(?:,|and|$|\n)"
)
#: Words that begin the third item of a list, "(c)", in licence wording.
_ITEM = "You|Representations|The|Any|If|An?|No|All|In|Each|This|Such|For|To|That|When|Where|Under|Neither|Redistributions?|Accompany|Give|Make|Cause|Convey"
#: (pattern, replacement with \1 for the group) in order.
RULES = [
    # a copyright line: the word, "(c)" or the sign at the line's start, unless it goes on as licence wording
    (
        r"(?i)(^|\n)[ \t#/*;%-]*(?:portions[ \t]+)?(?:"
        rf"copyright[ \t]*(?:\(c\)|©|[0-9])|copyright(?![a-z])[ \t]*[,:;-]*[ \t]*(?!(?:{_WORDING})(?![a-z]))[^\s,:;.\"')-]"
        rf"|\(c\)[ \t]*(?:[0-9]|copyright|by[ \t]|[^\n]*(?<![0-9])(?:19|20)[0-9][0-9](?![0-9])|(?-i:(?!(?:{_ITEM})(?![A-Za-z]))[A-Z][A-Za-z]*[a-z]))"
        r"|©|all rights reserved)[^\n]*",
        r"\1",
    ),
    # list and comment marks
    (r"(^|\n)[ \t]*(?:[#/*;%•-]+|[0-9a-z]{1,2}[.)])[ \t]+", r"\1"),
    (r"[^\p{L}\p{N}\x09-\x0D\x20]+", ""),
    (r"[\x09-\x0D\x20]+", " "),
    (r"licenc(e|ing)", r"licens\1"),
    (r"is(ations?|e[ds]?|ing)( |$)", r"iz\1\2"),
    (r"(behavi|col|fav|hon|lab)our", r"\1or"),
]
#: Equivalent spellings, one word each.
SPELLINGS = {
    "acknowledgement": "acknowledgment",
    "analogue": "analog",
    "artefact": "artifact",
    "catalogue": "catalog",
    "copyright owner": "copyright holder",
    "fulfilment": "fulfillment",
    "judgement": "judgment",
    "per cent": "percent",
    "programme": "program",
    "whilst": "while",
}
#: Every known notice holds this after lower-casing, so only such lines are units.
CLUE = "licen"


def canonical(text: Column) -> Column:
    """The canonical form; null stays null."""
    out = text
    for i, (pattern, put) in enumerate(RULES):
        out = F.regexp_replace(out, F.lit(pattern), F.lit(put.replace("\\", "$")))
        if i == 1:
            out = F.lower(out)
    for a, b in SPELLINGS.items():
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.trim(out)


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_digests(
    spark: SparkSession, texts: Iterable[tuple[str, str]] = (*TEXTS, *NOTICES), digests: Iterable[tuple[str, str, str]] = tuple(DIGESTS)
) -> DataFrame:
    """(digest, license) of known texts, and of texts known by digest alone."""
    hashed = spark.createDataFrame(list(texts), "license string, text string").select(digest(F.col("text")).alias("digest"), "license")
    return hashed.union(spark.createDataFrame([(d, name) for name, d, _ in digests], "digest string, license string")).distinct()


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", known: DataFrame | None = None) -> DataFrame:
    """One row per match: (key, line int, license, digest); ``line`` 0 is the
    whole text, others count from 1.

    The built-in table has a few dozen digests, so Spark broadcasts it;
    ``known`` (digest, license) of any size is joined as Spark sees fit.  Null
    and empty texts match nothing, repeated rows match alike, an empty table
    gives no rows; other columns of ``docs`` are not read."""
    table = F.broadcast(known_digests(docs.sparkSession)) if known is None else known
    slim = docs.select(F.col(key).alias("__key"), F.col(text).cast("string").alias("__text")).where(F.col("__text").isNotNull())
    unit = lambda n, x: F.struct(n.cast("int").alias("line"), x.alias("text"))
    lines = F.filter(F.transform(F.split("__text", "\n"), lambda x, i: unit(i + 1, x)), lambda u: F.contains(F.lower(u["text"]), F.lit(CLUE)))
    units = slim.select("__key", F.explode(F.concat(F.array(unit(F.lit(0), F.col("__text"))), lines)).alias("unit"))
    hashed = units.select(F.col("__key").alias(key), F.col("unit.line").alias("line"), digest(F.col("unit.text")).alias("digest"))
    return hashed.join(table, "digest").select(key, "line", "license", "digest")


def oracle_sql() -> str:
    """The scan of ``documents`` in DuckDB SQL.  Its patterns cannot look
    ahead, so copyright lines are told line by line, by what is in front of and
    what follows the mark."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    front = r"(?i)^[ \t#/*;%-]*(portions[ \t]+)?"

    def is_copyright(line: str) -> str:
        has = lambda x, pattern: f"regexp_matches({x}, {quote(pattern)})"
        after = lambda mark: f"regexp_replace({line}, {quote(front + mark)}, '')"
        named, item = after(r"copyright[ \t]*[,:;-]*[ \t]*"), after(r"\(c\)[ \t]*")
        wording = _WORDING.replace("|$|\n)", "|$)")
        return f"""CASE
          WHEN {has(line, front + r"(copyright[ \t]*(\(c\)|©|[0-9])|©|all rights reserved)")} THEN true
          WHEN {has(line, front + "copyright([^a-z]|$)")} THEN {has(named, r"""^[^\s,:;."')-]""")} AND NOT {has(named, f"(?i)^({wording})([^a-z]|$)")}
          WHEN {has(line, front + r"\(c\)")} THEN {has(item, r"(?i)^([0-9]|copyright|by[ \t])")} OR {has(item, "(^|[^0-9])(19|20)[0-9][0-9]([^0-9]|$)")}
            OR {has(item, "^[A-Z][A-Za-z]*[a-z]")} AND NOT {has(item, f"^({_ITEM})([^A-Za-z]|$)")}
          ELSE false END"""

    def form(x: str) -> str:
        x = f"array_to_string(list_transform(string_split({x}, chr(10)), lambda l: CASE WHEN {is_copyright('l')} THEN '' ELSE l END), chr(10))"
        for i, (pattern, put) in enumerate(RULES[1:]):
            x = f"regexp_replace({x}, {quote(pattern)}, {quote(put)}, 'g')"
            if i == 0:
                x = f"lower({x})"
        for a, b in SPELLINGS.items():
            x = f"replace({x}, {quote(a)}, {quote(b)})"
        return f"sha256(trim({x}, ' '))"

    values = ",\n".join(f"({quote(name)}, {quote(text)})" for name, text in (*TEXTS, *NOTICES))
    digests = ",\n".join(f"({quote(d)}, {quote(name)})" for name, d, _ in DIGESTS)
    return f"""
WITH known AS (
  SELECT {form("t")} AS digest, license FROM (VALUES {values}) v(license, t)
  UNION SELECT digest, license FROM (VALUES {digests}) d(digest, license)
), lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS t, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS line
  FROM documents WHERE text IS NOT NULL
), units AS (
  SELECT doc_id, 0 AS line, text AS t FROM documents WHERE text IS NOT NULL
  UNION ALL SELECT doc_id, line, t FROM lines WHERE contains(lower(t), '{CLUE}')
), hashed AS (SELECT doc_id, line::INT AS line, {form("t")} AS digest FROM units)
SELECT doc_id, line, license, digest FROM hashed JOIN known USING (digest)
"""
