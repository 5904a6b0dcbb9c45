"""Corpus pipeline: from raw documents to packed training sequences.

``STAGES`` lists the stages in order.  Each takes (spark, docs, sf_dir) and
returns a DataFrame; ``run`` writes every stage's result as Parquet to the
shared checkpoint folder and hands what it reads back to the next stage, so a
lost executor costs at most the running stage's tasks.

1. quality: documents that the quality rules reject go.
2. dedup: one document of each near-duplicate group stays.
3. secrets: secrets are masked in the text; every document stays.
4. mix: documents are taken as often as their source's target weight asks.
5. pack: the rest is packed into sequences of 2048 tokens; one row a piece.

Null, empty and repeated rows have the result that each operator states;
an empty table runs through and gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import mixing, packing, quality, secrets, simhash
from basketry.llm.common import load
from basketry.llm.registry import BYTE_VOCABULARY, PIECE_VOCABULARY, WORD_VOCABULARY
from basketry.session import materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_quality(docs, BYTE_VOCABULARY, PIECE_VOCABULARY)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicate(docs)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = secrets.redact(docs)
    kind = docs.schema["n_chars"].dataType
    return masked.withColumn("n_chars", F.length("text").cast(kind))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, WORD_VOCABULARY)


STAGES = [("quality", quality_stage), ("dedup", dedup_stage), ("secrets", secrets_stage), ("mix", mix_stage), ("pack", pack_stage)]

#: Token ids, fingerprints and compressed sizes are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
