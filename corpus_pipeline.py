"""A corpus from raw documents to tokens: select by quality, drop near-duplicates, redact
personal data, mix the sources, encode.

Each stage takes (spark, docs, sf_dir), works on every document that the stage before it
kept, and returns documents, the last one tokens. Stages hand over written tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orestrata.llm import classify, mixing, near_dedup, pii, queries, sentencepiece
from orestrata.sources.scratch import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance resampling draws."""
    docs = docs.select(*COLUMNS)
    picked = classify.select_quality(docs, queries.table(spark, sf_dir, "labels"))
    out = picked.filter(~F.col("selected")).select(F.col("doc_id").alias("out_id"), "text_hash").distinct()
    same = F.col("doc_id").eqNullSafe(F.col("out_id")) & (F.xxhash64("text") == F.col("text_hash"))
    return docs.join(out, same, "left_anti")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest doc_id; of repeated rows one."""
    docs = docs.select(*COLUMNS)
    judged = near_dedup.near_duplicates(docs)
    out = judged.filter(~F.col("kept")).select(F.col("doc_id").alias("out_id"), "text_hash").distinct()
    kept = docs.join(out, (F.col("doc_id") == F.col("out_id")) & (F.xxhash64("text") == F.col("text_hash")), "left_anti")
    return kept.dropDuplicates(["doc_id", "text"])


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced, and their new lengths."""
    clean = pii.redact(docs.select(*COLUMNS))
    return clean.withColumn("n_chars", F.length("text").cast("bigint"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.emit_copies(mixing.mix_sources(docs.select(*COLUMNS)))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document."""
    sentencepiece.verify_parity(queries.PIECES)
    coded = sentencepiece.encode(docs.select("doc_id", "source", "text"), queries.PIECES)
    return coded.select("doc_id", "source", "token_ids", F.size("token_ids").cast("bigint").alias("n_tokens"))


STAGES = [
    ("quality", select_quality),
    ("near_dedup", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

# Encoding, redaction and selection are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`: the rows of the last one."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
