"""File sources.

All readers take a declared schema where one exists, so no job is spent on
schema inference and Parquet scans get column pruning and pushed filters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetrail.schemas import PAGEVIEW_SCHEMA


# Declared schemas of the driver tables the jobs read, so a read never
# spends a driver round trip inferring them from Parquet footers.
DRIVER_TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table: ``{sf_dir}/{name}.parquet`` (declared schema when known)."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    ddl = DRIVER_TABLES.get(name)
    return spark.read.schema(ddl).parquet(path) if ddl else spark.read.parquet(path)


#: Column of the raw line where a field of it does not parse.
BAD_LINE = "bad_line"


def read_pageview_tsv(spark: SparkSession, path: str, keep_bad_lines: bool = False) -> DataFrame:
    """Header-less tab-separated page-view log with the declared schema.

    Permissive mode: a field that does not parse (bad timestamp or number)
    becomes null and the row is kept; with ``keep_bad_lines`` it has the raw line
    in the column ``bad_line``.
    """
    schema = PAGEVIEW_SCHEMA.fields + [T.StructField(BAD_LINE, T.StringType())] * keep_bad_lines
    return (
        spark.read.schema(T.StructType(schema))
        .option("columnNameOfCorruptRecord", BAD_LINE)
        .option("sep", "\t")
        .option("header", "false")
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def read_pageview_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Page-view Parquet read with the declared schema (columns by name)."""
    return spark.read.schema(PAGEVIEW_SCHEMA).parquet(path)


def read_points_text(spark: SparkSession, path: str) -> DataFrame:
    """Text lines ``x,y`` -> doubles ``x``, ``y``; unparsable parts -> null."""
    parts = F.split(F.col("value"), ",")
    return spark.read.text(path).select(
        F.try_element_at(parts, F.lit(1)).try_cast("double").alias("x"),
        F.try_element_at(parts, F.lit(2)).try_cast("double").alias("y"),
    )


def read_header_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header line; names from the header, every column a string."""
    return spark.read.option("header", "true").option("inferSchema", "false").csv(path)
