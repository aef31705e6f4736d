"""The corpus pipeline: five stages over ``documents``.

Every stage reads what its predecessor has kept, written as Parquet in the
shared folder. All but the last return the columns of ``documents``; the last
returns the token ids of each document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.llm import bpe, decontaminate, language_id, minhash_dedup, secrets
from pagetrail.llm.shared import shared_path, ship, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that language ID rejects: no letters, or too far from every language."""
    ship(spark)
    labelled = docs.select("text", "lang", F.col("doc_id").alias("id"))
    return language_id.accepted(docs, language_id.fit(labelled))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, that with the smallest id.

    Five-word shingles, similarity 0.8. The rows of an id stay or go
    together; equal rows of an id become one. Rows without an id stay.
    """
    ship(spark)
    found = minhash_dedup.near_duplicates(docs, words=5, percent=80)
    kept = found.where("kept").select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return named.select(docs.columns).unionByName(docs.where("doc_id IS NULL"))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark item."""
    ship(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its secrets become ``<SECRET>`` and ``n_chars`` follows."""
    ship(spark)
    return secrets.redacted(docs, secrets.fit(docs), length_col="n_chars")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every document."""
    ship(spark)
    encoded = bpe.encode(docs, bpe.vocabulary(spark))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("language ID", identify_language),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark),
    ("secret scans", redact_secrets),
    ("byte-level BPE encoding and decoding", tokenize),
]

#: SQL has no trained models and no BPE; the tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; returns the last one's table."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        path = shared_path(spark, f"pipeline-{i}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
