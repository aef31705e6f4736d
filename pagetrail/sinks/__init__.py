"""Sinks: Parquet overwrite, tab-joined text, keyed tables, JDBC.

All writes run on the executors; nothing passes through the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession

from pagetrail.schemas import ROW_KEY
from pagetrail.sinks.batches import JsonLines, Puts, put_once
from pagetrail.sinks.bucketed import bucketed_merge, merge_bucketed, write_bucketed
from pagetrail.sinks.store import Store, create_store, is_store, merge_store, open_store

__all__ = [
    "JsonLines", "Puts", "Store", "bucketed_merge", "create_store", "for_each_batch_of_rows", "is_store", "merge_bucketed", "merge_store",
    "open_store", "put_once", "read_keyed_table", "write_bucketed", "write_jdbc", "write_keyed_table", "write_parquet", "write_text",
]


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Parquet write; replaces an existing folder by default."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_text(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a one-string-column DataFrame as text lines.

    The default mode fails when the folder exists, as a plain text save does.
    """
    if len(df.columns) != 1:
        raise ValueError("text sink needs exactly one string column")
    df.write.mode(mode).text(path)


def write_keyed_table(df: DataFrame, path: str, key: str = ROW_KEY, num_partitions: int | None = None, mode: str = "overwrite") -> None:
    """Store a keyed table as Parquet, range-partitioned and sorted by key.

    Each file then covers one key range and each row group a narrower one,
    so ``range_scan``/``multi_get`` filters on the key skip files and row
    groups by their min/max statistics. A table to be merged into is a store
    (``create_store``).
    """
    parts = int(num_partitions or df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    out = df.repartitionByRange(parts, key).sortWithinPartitions(key)
    out.write.mode(mode).parquet(path)


def read_keyed_table(spark: SparkSession, path: str) -> DataFrame:
    """A stored keyed table: the last version of a store, or a Parquet folder."""
    return open_store(spark, path).read() if is_store(spark, path) else spark.read.parquet(path)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    batch_size: int = 100,
    num_partitions: int | None = None,
    properties: dict[str, str] | None = None,
) -> None:
    """Batched JDBC insert, one connection per partition.

    ``num_partitions`` caps concurrent connections (coalesce, no shuffle).
    """
    out = df.coalesce(num_partitions) if num_partitions else df
    w = (
        out.write.format("jdbc")
        .mode(mode)
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", batch_size)
    )
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


def for_each_batch_of_rows(
    df: DataFrame, handle: Callable[[list[Row]], None], batch_size: int = 100
) -> None:
    """Run ``handle`` on batches of at most ``batch_size`` rows per partition.

    For external stores without a Spark connector: the function (and any
    client it opens) runs on the executors, once per partition, and a
    failed task is retried, so ``handle`` must be idempotent (a keyed put is);
    where it is not, see ``put_once``.
    """

    def per_partition(rows: Iterator[Row]) -> None:
        batch: list[Row] = []
        for r in rows:
            batch.append(r)
            if len(batch) >= batch_size:
                handle(batch)
                batch = []
        if batch:
            handle(batch)

    df.foreachPartition(per_partition)
