"""Keyed tables as Spark's bucketed tables: a merge that shuffles the batch alone.

For batches that touch most of a table. Target and result are hash buckets
of the key, sorted by it, so the target is joined where it lies and the result is
written without another shuffle. (For batches that touch a few key
ranges see ``store``.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetrail.functions.time import q
from pagetrail.schemas import ROW_KEY


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, key: str = ROW_KEY) -> None:
    """Write ``df`` to a new folder as the catalog table ``table``, one sorted file per bucket of the key."""
    _save(df.repartition(buckets, key), table, path, buckets, key)


def _save(df: DataFrame, table: str, path: str, buckets: int, key: str) -> None:
    df.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).mode("errorifexists").saveAsTable(table)


def merge_bucketed(batch: DataFrame, table: str, into: str, path: str, key: str = ROW_KEY) -> None:
    """Merge a keyed batch into the bucketed table ``table`` and write the result as the table ``into``.

    ``table`` stays as it is, so a merge that is cut short has changed
    nothing; use the new name once it is there. Each task of the join holds one
    bucket and writes its file.
    """
    spark = batch.sparkSession
    told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    _save(bucketed_merge(batch, table, key), into, path, int(told["Num Buckets"]), key)


def bucketed_merge(batch: DataFrame, table: str, key: str = ROW_KEY) -> DataFrame:
    """The bucketed table with a keyed batch merged into it.

    Both are unique on the key, so this is a full join: the batch is
    shuffled to the table's buckets, the table is not. Non-null cells of the batch replace
    stored ones, cells new to the table are null in all other rows, and
    puts without a key are not stored. Nothing is written.
    """
    target = batch.sparkSession.table(table)
    puts = batch.where(F.col(key).isNotNull()).withColumn(key, F.col(key).cast(target.schema[key].dataType))
    old, put = target.alias("old"), puts.alias("put")
    col = lambda side, name: F.col(f"{side}.{q(name)}")
    cells = [
        (F.coalesce(col("put", f.name).cast(f.dataType), col("old", f.name)) if f.name in puts.columns else col("old", f.name)).alias(f.name)
        for f in target.schema.fields
        if f.name != key
    ]
    added = [col("put", c).alias(c) for c in puts.columns if c not in target.columns]
    joined = old.join(put.hint("merge"), col("old", key) == col("put", key), "full")
    return joined.select(F.coalesce(col("put", key), col("old", key)).alias(key), *cells, *added)
