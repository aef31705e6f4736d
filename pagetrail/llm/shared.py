"""What several operators need: tables, the shared folder, batches of text."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
import weakref
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per Spark context."""
    context = spark.sparkContext
    if context not in _SHIPPED:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        base = os.path.join(tempfile.mkdtemp(prefix="pagetrail-ship-"), "pagetrail-src")
        context.addPyFile(shutil.make_archive(base, "zip", root, "pagetrail"))
        _SHIPPED.add(context)


_SHIPPED: weakref.WeakSet = weakref.WeakSet()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset a local session gets a folder of its own; any other
    master must name one, as a machine-local folder would not be shared.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pagetrail-shared-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The table cuts the lineage and survives lost executors; read back, it is
    a plain scan, so that adaptive execution can split a skewed join on it.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Groups of scan partitions whose first rows are picked before the last pick: it reads at most so many times the sample.
PICK_GROUPS = 64


def excerpt(text: Column, chars: int, pieces: int = 8) -> Column:
    """A text of more than ``chars`` code points cut down to pieces spread evenly over its length, from its first to its last."""
    size = chars // pieces
    gap = F.char_length(text) - size
    cut = [F.substr(text, F.floor(gap * i / (pieces - 1)).cast("int") + 1, F.lit(size)) for i in range(pieces)]
    return F.when(F.char_length(text) <= chars, text).otherwise(F.concat(*cut))


def sampled(rows: DataFrame, by: str, limit: int) -> DataFrame:
    """(r, h, t, text) and ``by`` of the first ``limit`` different texts of each value of ``by``, in order of h.

    ``rows`` has ``by``, ``h`` (a hash of the row's id) and ``text``. They are
    picked by hashes of id and text alone, so that no text is shuffled to be
    ranked, and then looked up; rows alike in both count once.
    """
    narrow = rows.select(by, "h", F.xxhash64("text").alias("t"))
    rank = lambda *keys: F.dense_rank().over(Window.partitionBy(*keys).orderBy("h", "t"))
    grouped = narrow.withColumn("_group", F.spark_partition_id() % PICK_GROUPS)
    some = grouped.withColumn("_r", rank(by, "_group")).where(F.col("_r") <= limit).select(by, "h", "t").distinct()
    keys = stored(some.withColumn("r", rank(by)).where(F.col("r") <= limit), "sample")
    found = rows.withColumn("t", F.xxhash64("text")).join(F.broadcast(keys), [by, "h", "t"])
    return found.select(by, "r", "h", "t", "text")


def text_slices(texts: Sequence[str], max_chars: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` with about ``max_chars`` characters each.

    They bound what one step holds in memory; a longer text is a range of
    its own, never cut.
    """
    start = chars = 0
    for i, text in enumerate(texts):
        if i > start and chars + len(text) > max_chars:
            yield start, i
            start, chars = i, 0
        chars += len(text)
    if start < len(texts):
        yield start, len(texts)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads 64-bit values (fixed constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
