"""The thin ``opN_*`` queries over the driver's tables, and their SQL where
SQL can express them.  Each query goes through its operator and derives the
result's columns from what that returns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import hardneg, html, jaccard, licenses, mixing, packing, quality, secrets, simhash, spelling, tokenfile, topk, warc
from basketry.llm.common import load
from basketry.session import shared_dir

Query = Callable[[SparkSession, str], DataFrame]

#: Vocabulary files; any other path can be passed to the operators.
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
PIECE_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(load(spark, sf_dir, "documents"), BYTE_VOCABULARY, PIECE_VOCABULARY)


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(load(spark, sf_dir, "documents"))


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(load(spark, sf_dir, "pages"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"), WORD_VOCABULARY)


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(load(spark, sf_dir, "documents"))
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin(*kinds))
    return found.select(
        "doc_id",
        *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in secrets.KINDS],
        F.sha2(secrets.span_list(of("assign", "access", "hex")), 256).alias("base_sha256"),
        secrets.span_list(F.col("spans")).alias("spans"),
    )


def op6_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = warc.page_captures(load(spark, sf_dir, "pages"))
    # the payload's digest and length stand for it: no body is shuffled
    digests = captures.withColumn("payload", F.when(F.col("payload").isNotNull(), F.struct(F.md5("payload").alias("md5"), F.length("payload").alias("chars"))))
    resolved = warc.resolve_revisits(digests)
    return resolved.select("record_id", "canonical", "refers_to", "outcome", "headers", F.col("payload.md5").alias("payload_md5"), F.coalesce("payload.chars", F.lit(0)).alias("payload_chars"))


OP6_SQL = r"""
WITH captures AS (
  SELECT page_id, n, n % 2 = 1 AS revisit, n >= 2 AS later, (1700000000 + (page_id * 7919 + n * 104729) % 400000)::BIGINT AS stamp,
         html || CASE WHEN n >= 2 THEN '<!-- 2 -->' ELSE '' END AS payload,
         regexp_replace(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare
  FROM pages CROSS JOIN (VALUES (0), (1), (2), (3)) v(n)
), urls AS (
  SELECT *, regexp_replace(lower(regexp_extract(bare, '^[^/?#]*')), '^(www|m)\.|:(80|443)$', '', 'g') AS host,
         regexp_replace(regexp_replace(regexp_replace(bare, '#.*$', ''), '^[^/?]*', ''), '([?&])(utm_[a-z]+|gclid|fbclid|ref)=[^&]*', '\1', 'g') AS path
  FROM captures
), records AS (
  SELECT page_id || '-' || n AS record_id, revisit, later, stamp, payload, n,
         host || regexp_replace(regexp_replace(regexp_replace(regexp_replace(path, '&+', '&', 'g'), '\?&', '?', 'g'), '[?&]+$', ''), '/+$', '') AS canonical,
         CASE WHEN page_id % 11 <> 0 THEN substr(md5(payload), 1, 16) END AS tag,
         CASE WHEN page_id % 22 <> 0 THEN later::INT::VARCHAR END AS modified
  FROM urls
), found AS (
  SELECT v.*, r.record_id AS refers_to, r.tag AS r_tag, r.modified AS r_modified, r.payload AS r_payload
  FROM records v LEFT JOIN records r ON v.canonical = r.canonical AND NOT r.revisit AND r.stamp < v.stamp
  WHERE v.revisit
  QUALIFY row_number() OVER (PARTITION BY v.record_id ORDER BY r.stamp DESC NULLS LAST, r.record_id DESC) = 1
), decided AS (
  SELECT *, CASE WHEN refers_to IS NULL THEN 'no_response'
                 WHEN tag IS NOT NULL AND r_tag IS NOT NULL THEN CASE WHEN tag = r_tag THEN 'resolved' ELSE 'mismatch' END
                 WHEN modified IS NOT NULL AND r_modified IS NOT NULL THEN CASE WHEN modified = r_modified THEN 'resolved' ELSE 'mismatch' END
                 ELSE 'no_validator' END AS outcome
  FROM found
)
SELECT record_id, canonical, refers_to, outcome,
       CASE WHEN outcome = 'resolved' THEN 'cache-control: max-age=' || n * 60 || chr(10) || 'content-type: text/html' || chr(10) || 'date: ' || stamp
         || CASE WHEN tag IS NOT NULL THEN chr(10) || 'etag: W/"' || tag || '"' ELSE '' END
         || CASE WHEN r_modified IS NOT NULL THEN chr(10) || 'last-modified: ' || r_modified ELSE '' END END AS headers,
       CASE WHEN outcome = 'resolved' THEN md5(r_payload) END AS payload_md5,
       CASE WHEN outcome = 'resolved' THEN length(r_payload) ELSE 0 END::INT AS payload_chars
FROM decided
"""


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count("text").alias("size"))
    mixed = mixing.mix_counts(docs, size=F.col("size"))
    return mixed.select("row.doc_id", "row.source", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), src AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, 3.0::DOUBLE * source_size AS cap,
         CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::DOUBLE AS weight
  FROM src
), filled AS (  -- words shared out when this source is just full
  SELECT a.source, sum(least(b.cap, a.cap / a.weight * b.weight)) <= (SELECT sum(source_size) FROM src) AS is_full
  FROM w a CROSS JOIN w b GROUP BY a.source
), level AS (
  SELECT ((SELECT sum(source_size) FROM src) - coalesce(sum(cap) FILTER (is_full), 0))::DOUBLE
         / nullif(sum(weight) FILTER (NOT is_full), 0) AS level
  FROM w JOIN filled ON w.source IS NOT DISTINCT FROM filled.source
), goal AS (
  SELECT w.source, source_size, CASE WHEN is_full THEN cap ELSE level * weight END AS target
  FROM w JOIN filled ON w.source IS NOT DISTINCT FROM filled.source CROSS JOIN level
), draw AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS expected,
         ('0x' || substr(md5('0:' || coalesce('+' || source, '-')), 1, 6))::BIGINT AS start
  FROM goal
), ranked AS (
  SELECT d.doc_id, d.source, d.size, source_size, target, floor(expected)::BIGINT AS whole, start,
         round((expected - floor(expected)) * 16777216)::BIGINT AS part,
         row_number() OVER (PARTITION BY d.source ORDER BY
           length(size::VARCHAR) * 100 + substr(size::VARCHAR, 1, 2)::INT, substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 2),
           size, length(doc_id::VARCHAR) NULLS FIRST, doc_id::VARCHAR NULLS FIRST) AS place
  FROM d JOIN draw ON d.source IS NOT DISTINCT FROM draw.source
), copied AS (
  SELECT *, (whole + ((start + place * part) >> 24) - ((start + (place - 1) * part) >> 24))::INT AS copies FROM ranked
)
SELECT doc_id, source, size, source_size, target, copies, (size * copies)::BIGINT AS taken FROM copied
"""


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(load(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id", "kept")


def op9_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "token-ids")
    tokenfile.write_ids(load(spark, sf_dir, "documents"), path, BYTE_VOCABULARY)
    return tokenfile.read_checksums(spark, path)


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP10_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def op11_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(load(spark, sf_dir, "documents"))


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11_SQL = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), grams AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g
  FROM words
), sizes AS (
  SELECT doc_id, count(g) AS n FROM words LEFT JOIN grams USING (doc_id) GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), linked AS (
  SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * c >= 90 * (x.n + y.n - c)
), reach AS (
  SELECT doc_id, doc_id AS other FROM sizes
  UNION
  SELECT reach.doc_id, linked.b FROM reach JOIN linked ON reach.other = linked.a
)
SELECT doc_id, any_value(n)::BIGINT AS n_shingles, min(other) AS component_id FROM reach JOIN sizes USING (doc_id) GROUP BY doc_id
"""


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(load(spark, sf_dir, "documents"))


OP12_SQL = rf"""
WITH RECURSIVE crc AS (  -- the table of CRC-32, by its polynomial
  SELECT list_transform(range(256), lambda i: list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), runs AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL
), bytes AS (
  SELECT run, n, hex(encode(doc_id || ':' || run)) AS hx FROM runs
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(range(length(hx) // 2), lambda j: ('0x' || substr(hx, 2 * j + 1, 2))::BIGINT),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
  FROM bytes, crc
), words AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(n)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 7 AND sum(n) >= 2
), cut AS (  -- each word without its i-th code point
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) AS n_near, max(n) AS top, arg_min(other, (-n, other)) AS usual FROM near GROUP BY word
), found AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 10 * words.n THEN usual END AS form, CASE WHEN top >= 10 * words.n THEN top END AS form_n
  FROM words LEFT JOIN best USING (word)
), up AS (
  SELECT word, form AS root, 1 AS depth FROM found WHERE form IS NOT NULL
  UNION ALL SELECT up.word, f.form, depth + 1 FROM up JOIN found f ON up.root = f.word WHERE f.form IS NOT NULL
), roots AS (
  SELECT word, arg_max(root, depth) AS root FROM up GROUP BY word
)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM found LEFT JOIN roots USING (word)
"""


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.mine(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)


OP13_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id, list_inner_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE a.vec_id % 50 = 0
), positive AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
), negative AS (
  SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INT AS rank, id AS negative_id, positive_score, score AS negative_score
  FROM positive JOIN scored USING (anchor_id)
  WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
)
SELECT * FROM negative WHERE rank <= 3
"""


QUERIES: dict[str, Query] = {
    "op1_quality": op1_quality,
    "op2_licenses": op2_licenses,
    "op3_html": op3_html,
    "op4_packing": op4_packing,
    "op5_secrets": op5_secrets,
    "op6_revisits": op6_revisits,
    "op7_mixing": op7_mixing,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_token_file": op9_token_file,
    "op10_top_k": op10_top_k,
    "op11_jaccard_join": op11_jaccard_join,
    "op12_spelling": op12_spelling,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES: dict[str, str] = {
    "op2_licenses": licenses.oracle_sql(),
    "op6_revisits": OP6_SQL,
    "op7_mixing": OP7_SQL,
    "op10_top_k": OP10_SQL,
    "op11_jaccard_join": OP11_SQL,
    "op12_spelling": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}
