"""Micro-batch loading of page views into the cookie-keyed table.

New log files are read with Structured Streaming; every micro-batch is
turned into puts (``plans.keyed_pageviews.pageview_puts``) and appended,
with its batch number, to a put log (Parquet). The keyed table is the
last-writer-wins merge of the put log (``read_keyed``): a later batch wins
over an earlier one, then the usual version order applies.

A replayed micro-batch (after a failure between the write and the commit)
appends the same puts again; a keyed put is idempotent, so the merged table
is unchanged — at-least-once delivery gives exactly-once results. No state
is kept in the stream itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pagetrail.operators.keyed import keyed_upsert
from pagetrail.plans.keyed_pageviews import TIE_BREAK, pageview_puts
from pagetrail.schemas import PAGEVIEW_COLUMNS, PAGEVIEW_SCHEMA
from pagetrail.sources.files import read_pageview_parquet

BATCH_COLUMN = "ingest_batch"


def start_pageview_load(
    spark: SparkSession,
    source_dir: str,
    put_log: str,
    checkpoint_location: str,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Stream page-view Parquet files from ``source_dir`` into ``put_log``.

    ``checkpoint_location`` must be on storage every executor and the
    driver share. With ``available_now`` the query processes what is there
    and stops; otherwise it keeps polling.
    """
    reader = spark.readStream.schema(PAGEVIEW_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)

    def append_batch(batch: DataFrame, batch_id: int) -> None:
        puts = pageview_puts(batch).withColumn(BATCH_COLUMN, F.lit(batch_id).cast("long"))
        puts.write.mode("append").parquet(put_log)

    writer = stream.writeStream.foreachBatch(append_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def read_keyed(spark: SparkSession, put_log: str) -> DataFrame:
    """The keyed page-view table as of the put log: ``row_key`` + 20 cells."""
    puts = spark.read.parquet(put_log)
    tail = [TIE_BREAK] if TIE_BREAK in puts.columns else []
    rest = [c for c in PAGEVIEW_COLUMNS if c != "timeCreate"]
    return keyed_upsert(puts, PAGEVIEW_COLUMNS, version=[BATCH_COLUMN, "timeCreate", *tail, *rest])


def load_batch_file(spark: SparkSession, path: str) -> DataFrame:
    """Page-view Parquet file(s) as a batch DataFrame (same schema as the stream)."""
    return read_pageview_parquet(spark, path)
