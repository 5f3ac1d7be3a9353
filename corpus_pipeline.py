"""From raw documents to packed training sequences: rules, near copies, secrets, mixture, packing.

``STAGES`` lists the stages in order. Each takes ``(spark, docs, sf_dir)``, works on all documents that the one before kept,
and returns documents (the last one: pieces of sequences); ``run`` writes each result as Parquet and reads it again.

Rows without an id, null and empty texts, repeated rows and further columns pass through as each operator states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sitefold.llm import common as C, mixing, neardup, packing, quality, secrets

#: No SQL: hashes, learned rules and tokenizers decide. Tests hold the stages against plain Python.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor the learned list rejects."""
    return quality.kept(docs, quality.learn(docs, C.table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return neardup.keep_one(docs, neardup.cluster(docs))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret replaced by its kind; ``n_chars`` follows where the table has it."""
    found = secrets.Ledger(spark, C.new_path(spark, "secret-ledger")).scan(docs)
    return secrets.redact(docs, found)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them: none, one or two rows each."""
    return mixing.apply(docs, mixing.mix(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 4096 ids."""
    return packing.pack(docs, C.tokenizer_path("word_bpe_49k.json"), 2)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("secret_scan", secret_scan), ("source_mix", source_mix), ("packing", pack)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = C.written(stage(spark, docs, sf_dir), name)
    return docs
