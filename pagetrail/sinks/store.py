"""A keyed table in key ranges, with a manifest that names the files in force.

``<path>/data/<write>/...``           Parquet files, each a sorted range of keys
``<path>/manifests/version=<n>/...``  one file: a row per range

A merge writes the ranges that hold a key of the batch anew, beside the old
files, and then one manifest, which Spark's committer puts in place by a
rename. Readers follow the last manifest, so a merge that is cut short
anywhere leaves the table as it was, and can be run again; files that no
manifest names are never read. The manifest holds the schema, so no footers
are opened to find it, and the first key of every range, so scans and look-ups
open only the ranges they need.
"""

from __future__ import annotations

import json
import math
import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetrail.functions.keys import prefix_successor
from pagetrail.operators.keyed import multi_get, range_scan
from pagetrail.schemas import ROW_KEY
from pagetrail.session import staged

#: Rows of a range when it is made; one that has grown to more than twice that is split when it is written.
ROWS_PER_RANGE = 5_000_000
# Column of the range numbers while files are written.
_RANGE = "__key_range"


@dataclass(frozen=True)
class Store:
    """One version of a stored table. Range i has the keys from ``firsts[i]`` on that are less than ``firsts[i + 1]``.

    The first range has no lower bound (None). ``files[i]`` is None in a table without rows.
    """

    spark: SparkSession = field(repr=False)
    path: str
    key: str
    version: int
    rows_per_range: int
    schema: T.StructType = field(repr=False)
    firsts: Sequence[object]
    files: Sequence[str | None]
    rows: Sequence[int]

    def read(self, ranges: Iterable[int] | None = None) -> DataFrame:
        """The table, or the ranges of the given numbers."""
        numbers = range(len(self.files)) if ranges is None else sorted(set(ranges))
        files = [f"{self.path}/data/{self.files[i]}" for i in numbers if self.files[i]]
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*files)

    def scan(self, start: object = None, stop: object = None) -> DataFrame:
        """Rows with ``start <= key < stop`` (None is open), from the ranges that may hold some."""
        first = 0 if start is None else bisect_right(self.firsts, start, lo=1) - 1
        last = len(self.firsts) if stop is None else bisect_left(self.firsts, stop, lo=1)
        return range_scan(self.read(range(first, max(first + 1, last))), start, stop, self.key)

    def prefix(self, prefix: str) -> DataFrame:
        """Rows whose text key starts with ``prefix``."""
        return self.scan(prefix, prefix_successor(prefix))

    def get(self, keys: Sequence[object] | DataFrame, cells: Sequence[str] | None = None, keep_missing: bool = False) -> DataFrame:
        """``cells`` (all by default) of the given keys, from the ranges that may hold them.

        A list of keys is a set, pushed into the scan, where row groups are
        skipped by their statistics and bloom filters. A DataFrame of keys is
        looked up as by ``multi_get``, with multiplicity; the numbers of the ranges that
        it touches reach the driver.
        """
        cells = [c for c in self.schema.names if c != self.key] if cells is None else list(cells)
        if isinstance(keys, DataFrame):
            own = keys.select(F.col(self.key).cast(self.schema[self.key].dataType).alias(self.key))
            touched = own.where(F.col(self.key).isNotNull()).select(self.range_of(F.col(self.key))).distinct()
            return multi_get(self.read(r[0] for r in touched.collect()), own, cells, self.key, keep_missing)
        wanted = [k for k in dict.fromkeys(keys) if k is not None]
        found = self.read(bisect_right(self.firsts, k, lo=1) - 1 for k in wanted).where(F.col(self.key).isin(wanted))
        if not keep_missing:
            return found.select(self.key, *cells)
        named = self.spark.createDataFrame([(k,) for k in wanted], T.StructType([self.schema[self.key]]))
        return multi_get(found, named, cells, self.key, keep_missing=True)

    def range_of(self, key: Column) -> Column:
        """Number of a key's range: a binary search among the first keys, as an expression."""
        n = len(self.firsts) - 1
        if not n:
            return F.lit(0)
        bounds = F.array(*[F.lit(f) for f in self.firsts[1:]])
        steps = F.array(*[F.lit(1 << k) for k in reversed(range(n.bit_length()))])
        further = lambda at, step: F.coalesce(F.get(bounds, at + step - 1) <= key, F.lit(False))
        return F.aggregate(steps, F.lit(0), lambda at, step: F.when(further(at, step), at + step).otherwise(at))


def is_store(spark: SparkSession, path: str) -> bool:
    try:
        return bool(spark.read.parquet(f"{path.rstrip('/')}/manifests").columns)
    except AnalysisException:
        return False


def open_store(spark: SparkSession, path: str) -> Store:
    """The last version of the table at ``path``."""
    path = path.rstrip("/")
    manifests = spark.read.parquet(f"{path}/manifests")
    version = manifests.agg(F.max("version")).first()[0]
    rows = manifests.where(F.col("version") == version).orderBy("number").collect()
    if len({r.commit for r in rows}) > 1:
        raise RuntimeError(f"two merges have written version {version} of {path} at the same time")
    one = rows[0]
    schema = T.StructType.fromJson(json.loads(one.table_schema))
    return Store(
        spark, path, one.key, version, one.rows_per_range, schema, [r["first"] for r in rows], [r["file"] for r in rows], [r["rows"] for r in rows]
    )


def _write_ranges(rows: DataFrame, path: str, key: str, per_range: int, large: Sequence[int], tasks: int) -> dict[int, list[tuple]]:
    """Write rows with range numbers under a new folder; (first key, file, rows) of the new files by number.

    A range is written by one task, but for the ``large`` ones, which are dealt
    to several by key; a file ends after twice ``per_range`` rows.
    """
    spark, folder = rows.sparkSession, uuid.uuid4().hex
    if large:
        out = rows.repartitionByRange(tasks, _RANGE, F.when(F.col(_RANGE).isin(list(large)), F.col(key)))
    else:
        out = rows.repartition(tasks, _RANGE)
    writer = out.sortWithinPartitions(_RANGE, key).write.option("maxRecordsPerFile", 2 * per_range)
    writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true").option(f"parquet.bloom.filter.expected.ndv#{key}", per_range)
    writer.partitionBy(_RANGE).parquet(f"{path}/data/{folder}")
    written = spark.read.schema(T.StructType([rows.schema[key]])).parquet(f"{path}/data/{folder}")
    named = written.select(F.col("_metadata.file_path").alias("file"), key).groupBy("file")
    found: dict[int, list[tuple]] = {}
    for file, first, n in named.agg(F.min(key), F.count("*")).collect():
        _, sub, name = file.rsplit("/", 2)
        found.setdefault(int(sub.partition("=")[2]), []).append((first, f"{folder}/{sub}/{name}", n))
    return {number: sorted(files) for number, files in found.items()}


def _commit(store: Store) -> Store:
    """Put the manifest of a new version in place: from here on it is what readers see."""
    spark, key_type = store.spark, store.schema[store.key].dataType
    schema = T.StructType.fromDDL("commit string, number int, file string, rows long, rows_per_range long, key string, table_schema string")
    schema = schema.add("first", key_type, True)
    commit, kept = uuid.uuid4().hex, store.schema.json()
    rows = [
        (commit, i, file, n, store.rows_per_range, store.key, kept, first)
        for i, (first, file, n) in enumerate(zip(store.firsts, store.files, store.rows, strict=True))
    ]
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{store.path}/manifests/version={store.version}")
    return store


def create_store(df: DataFrame, path: str, key: str = ROW_KEY, rows_per_range: int = ROWS_PER_RANGE, ranges: int | None = None) -> Store:
    """Store a keyed table; a table at ``path`` is replaced by a new version.

    ``df`` is unique on the key; rows without one are not stored. Choose
    ``rows_per_range``, or the number of ``ranges``, so that a file has some
    100 MB to a gigabyte.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    version = open_store(spark, path).version + 1 if is_store(spark, path) else 1
    rows = staged(df.where(F.col(key).isNotNull()).withColumn(_RANGE, F.lit(0)), "store-create")
    n = rows.count()
    rows_per_range = max(1, math.ceil(n / ranges)) if ranges else rows_per_range
    files = _write_ranges(rows, path, key, rows_per_range, [0], max(1, math.ceil(n / rows_per_range))).get(0) if n else None
    firsts, names, counts = zip(*files, strict=True) if files else ((None,), (None,), (0,))
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
    return _commit(Store(spark, path, key, version, rows_per_range, schema, [None, *firsts[1:]], names, counts))


def merge_store(batch: DataFrame, path: str) -> int:
    """Merge a keyed batch into the stored table at ``path``; returns how many ranges were rewritten.

    ``batch`` is unique on the key (what the ``load_*`` functions return).
    Its non-null cells replace stored ones, other cells stay; cells new to
    the table are null in all other rows. Only ranges that hold a key of the batch
    are read and written; their numbers and sizes are what reaches the driver.
    Nothing is in force before the manifest is in place. If another merge has
    been faster, this one fails and changes nothing.
    """
    store = open_store(batch.sparkSession, path)
    key, schema = store.key, store.schema
    puts = batch.where(F.col(key).isNotNull()).withColumn(key, F.col(key).cast(schema[key].dataType))
    puts = staged(puts.withColumn(_RANGE, store.range_of(F.col(key))), "store-puts")
    new = {r[0]: r[1] for r in puts.groupBy(_RANGE).count().collect()}
    if not new:
        return 0
    added = [f for f in puts.schema.fields if f.name not in (*schema.names, _RANGE)]
    target, cells = store.read(new), [f for f in schema.fields if f.name != key]
    old, put = target.alias("old"), puts.alias("put")
    col = lambda side, name: F.col(f"{side}.`{name}`")
    merged = old.join(put, col("old", key) == col("put", key), "full").select(
        F.coalesce(col("put", key), col("old", key)).alias(key),
        *[(F.coalesce(col("put", f.name).cast(f.dataType), col("old", f.name)) if f.name in puts.columns else col("old", f.name)).alias(f.name) for f in cells],
        *[col("put", f.name).alias(f.name) for f in added],
    )
    merged = merged.withColumn(_RANGE, store.range_of(F.col(key)))
    sizes = {i: store.rows[i] + n for i, n in new.items()}
    large = [i for i, n in sizes.items() if n > 2 * store.rows_per_range]
    if large:  # dealing out by ranges takes a sample first
        merged = staged(merged, "store-merged")
    tasks = max(len(new), math.ceil(sum(sizes.values()) / store.rows_per_range))
    written = _write_ranges(merged, store.path, key, store.rows_per_range, large, tasks)
    entries = []
    for i, entry in enumerate(zip(store.firsts, store.files, store.rows, strict=True)):
        files = written.get(i, [entry])
        entries += [(entry[0], *files[0][1:]), *files[1:]]
    firsts, names, counts = zip(*entries, strict=True)
    if open_store(store.spark, path).version != store.version:
        raise RuntimeError(f"{path} has been merged into meanwhile; run the merge again")
    kept = T.StructType([*schema.fields, *[T.StructField(f.name, f.dataType, True) for f in added]])
    _commit(Store(store.spark, store.path, key, store.version + 1, store.rows_per_range, kept, firsts, names, counts))
    return len(new)
