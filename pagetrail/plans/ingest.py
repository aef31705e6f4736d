"""Ingest of raw logs: bad lines into quarantine, and counts from the same pass."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pagetrail.schemas import PAGEVIEW_SCHEMA
from pagetrail.session import checkpoint_dir
from pagetrail.sources.files import BAD_LINE, read_pageview_tsv


def split_tsv(spark: SparkSession, src: str) -> tuple[DataFrame, dict[str, int]]:
    """Lines of a raw log with ``rejected`` and ``bad_line``, stored in the shared folder, and their counts.

    One job reads, writes and counts. A line is rejected if a field does not parse or its
    number of fields is wrong; ``without_key`` counts the others whose
    cookie time, the key of the keyed table, is missing.
    """
    lines = read_pageview_tsv(spark, src, keep_bad_lines=True).withColumn("rejected", F.col(BAD_LINE).isNotNull())
    seen = Observation("ingest")
    counted = lines.observe(
        seen,
        F.count(F.lit(1)).alias("read"),
        F.count_if("rejected").alias("rejected"),
        F.count_if(~F.col("rejected") & F.col("cookieCreate").isNull()).alias("without_key"),
    )
    path = f"{checkpoint_dir(spark).rstrip('/')}/ingest-{uuid.uuid4().hex}"
    counted.write.partitionBy("rejected").parquet(path)
    return spark.read.schema(lines.schema).parquet(path), {k: seen.get[k] for k in ("read", "rejected", "without_key")}


def ingest_tsv(spark: SparkSession, src: str, dst: str, quarantine: str) -> dict[str, int]:
    """Raw log -> Parquet at ``dst``; lines with a bad field go to ``quarantine`` as text. Returns the counts.

    ``dst`` is replaced, the quarantine must be new.
    """
    rows, counts = split_tsv(spark, src)
    rows.where("rejected").select(BAD_LINE).write.text(quarantine)
    rows.where("NOT rejected").select(*PAGEVIEW_SCHEMA.names).write.mode("overwrite").parquet(dst)
    return counts


def ingest_counts(spark: SparkSession, src: str) -> DataFrame:
    """The counts of ``split_tsv`` as a row."""
    counts = split_tsv(spark, src)[1]
    return spark.createDataFrame([tuple(counts.values())], "lines long, rejected long, without_key long")
