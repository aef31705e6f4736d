"""Session construction and the shared checkpoint folder.

Library functions never create a session; they take the one they are given.
``build_session`` is for scripts, tests and the bench.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale. AQE re-plans joins from measured sizes,
# coalesces small shuffle partitions and splits skewed join partitions.
SCALE_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # checkpoint files of DataFrames that are gone are deleted, so a
    # long-lived session does not fill the shared checkpoint folder
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
}


def build_session(
    app: str = "pagetrail",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or get) a session with the scale defaults.

    ``master`` is left to spark-submit when None. On a cluster, size
    ``shuffle_partitions`` so a partition is ~128-256 MB of shuffle data;
    AQE then coalesces the small ones.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith(("local[", "local*")) or spark.sparkContext.master == "local"


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only in local mode.

    On a cluster the folder must be shared storage named by
    ``spark.checkpoint.dir``; a machine-local temp folder would not survive
    the loss of the executor that wrote it, so we refuse to invent one.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's spark.checkpoint.dir applies
        return spark.conf.get("spark.checkpoint.dir", "")
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not _is_local(spark):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "(e.g. an HDFS or object-store folder) before running this job"
        )
    local_dir = tempfile.mkdtemp(prefix="pagetrail-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local_dir)
    return sc.getCheckpointDir() or local_dir


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: evaluated once, and with its true size for the planner."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
