"""Relational sources over JDBC, read in parallel by the executors.

Instead of paging ``LIMIT n OFFSET m`` through the driver (which, without an
ORDER BY, may repeat or skip rows), a large table is split into disjoint
ranges of a numeric column, one partition per range, each read by one task.
Filters and column selections written against the returned DataFrame are
pushed into the database's WHERE / SELECT list by Spark.

Credentials come only from the caller (options or environment); none are
stored here.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession

# Rows per partition when the caller gives a row count instead of a
# partition count.
DEFAULT_ROWS_PER_PARTITION = 50_000
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def partitions_for(row_count: int, rows_per_partition: int = DEFAULT_ROWS_PER_PARTITION) -> int:
    """``ceil(row_count / rows_per_partition)``, at least 1."""
    return max(1, math.ceil(row_count / rows_per_partition))


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str | None = None,
    query: str | None = None,
    properties: dict[str, str] | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Read a table (``dbtable``) or a query (``query``) in one partition.

    Use for small tables; use ``read_jdbc_partitioned`` for big ones.
    """
    if (table is None) == (query is None):
        raise ValueError("give exactly one of table or query")
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", fetch_size)
    reader = reader.option("dbtable", table) if table else reader.option("query", query)
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader.load()


def read_jdbc_partitioned(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    lower: int,
    upper: int,
    num_partitions: int,
    properties: dict[str, str] | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Parallel read: ``num_partitions`` disjoint ranges of ``column``.

    ``lower``/``upper`` only shape the ranges (the first and last ranges are
    open), so no row is lost or read twice even if the bounds are loose.
    ``table`` may be a parenthesised sub-query with an alias.
    """
    return (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("partitionColumn", column)
        .option("lowerBound", str(lower))
        .option("upperBound", str(upper))
        .option("numPartitions", str(num_partitions))
        .option("fetchsize", fetch_size)
        .options(**(properties or {}))
        .load()
    )


def read_jdbc_auto(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    rows_per_partition: int = DEFAULT_ROWS_PER_PARTITION,
    properties: dict[str, str] | None = None,
    fetch_size: int = 10_000,
) -> DataFrame:
    """Count, then read in parallel: one partition per ``rows_per_partition`` rows.

    A single small query returns ``min``, ``max`` and ``count`` of the
    numeric ``column`` (one row to the driver); the table is then read as
    ``ceil(count / rows_per_partition)`` disjoint ranges of that column.
    ``column`` and ``table`` are plain names (the table's may be qualified),
    as they become part of that query's text. The ranges are equally wide, so
    a value that holds much of the table is one range; see ``split_predicates`` for keys dealt unevenly.
    """
    if not _NAME.fullmatch(column) or not all(map(_NAME.fullmatch, table.split("."))):
        raise ValueError(f"not plain names: {column!r}, {table!r}")
    stats = read_jdbc(
        spark,
        url,
        query=f"SELECT MIN({column}) AS lo, MAX({column}) AS hi, COUNT(*) AS n FROM {table}",
        properties=properties,
    ).first()
    # positional: some databases upper-case unquoted aliases
    lo, hi, n = (stats[0], stats[1], stats[2]) if stats is not None else (None, None, 0)
    if not n or lo is None:
        return read_jdbc(spark, url, table=table, properties=properties, fetch_size=fetch_size)
    return read_jdbc_partitioned(
        spark,
        url,
        table,
        column,
        int(lo),
        int(hi) + 1,
        partitions_for(int(n), rows_per_partition),
        properties=properties,
        fetch_size=fetch_size,
    )


def split_predicates(keys: DataFrame, column: str, second: str, rows_per_partition: int = DEFAULT_ROWS_PER_PARTITION) -> list[str]:
    """Disjoint conditions that deal a table into parts of about ``rows_per_partition`` rows, however uneven ``column`` is.

    ``keys`` holds the two numeric columns of the table (read from it, or from an
    index or copy). The ranges of ``column`` end at its quantiles. A value that
    would fill more than one range is a part of its own, split at quantiles of
    ``second``. Every row fulfils just one condition; nulls have conditions of
    their own. What reaches the driver are the quantiles.
    """
    if not all(map(_NAME.fullmatch, (column, second))):
        raise ValueError(f"not plain names: {column!r}, {second!r}")
    parts = partitions_for(keys.count(), rows_per_partition)
    found = [f"{column} IS NULL"]
    lower = f"{column} IS NOT NULL"
    for point, times in _quantiles(keys, column, parts):
        found.append(f"{lower} AND {column} < {point}")
        if times < 2:
            lower = f"{column} >= {point}"
            continue
        lower, hot = f"{column} > {point}", f"{column} = {point}"
        own = keys.where(hot)
        found.append(f"{hot} AND {second} IS NULL")
        at_least = f"{hot} AND {second} IS NOT NULL"
        for cut, _ in _quantiles(own, second, partitions_for(own.count(), rows_per_partition)):
            found.append(f"{at_least} AND {second} < {cut}")
            at_least = f"{hot} AND {second} >= {cut}"
        found.append(at_least)
    return [*found, lower]


def _quantiles(keys: DataFrame, column: str, parts: int) -> list[tuple[int | float, int]]:
    """The values that cut ``column`` into ``parts`` equal parts, with how many of the cuts fall on each."""
    if parts < 2:
        return []
    kind = int if keys.schema[column].dataType.typeName() in ("byte", "short", "integer", "long") else float
    cuts = keys.approxQuantile(column, [i / parts for i in range(1, parts)], 1 / (8 * parts))
    return sorted(Counter(map(kind, cuts)).items())


def read_jdbc_split(
    spark: SparkSession, url: str, table: str, predicates: list[str], properties: dict[str, str] | None = None, fetch_size: int = 10_000
) -> DataFrame:
    """Parallel read: a partition for each of ``split_predicates``."""
    return spark.read.jdbc(url, table, predicates=predicates, properties={"fetchsize": str(fetch_size), **(properties or {})})
