"""pagetrail — web-log and workforce analytics as plain Spark DataFrame jobs.

Every public job is a function ``DataFrame(s) -> DataFrame``; nothing is
collected to the driver and no per-row Python runs in a hot path.

Subpackages
-----------
sources    readers: tab-separated logs, Parquet, text points, header CSV, JDBC
sinks      writers: Parquet overwrite, tab-joined text, keyed tables, JDBC
functions  column helpers: epoch millis, hour floor, row keys, tab lines
operators  keyed tables (upsert / multi-get / range scan), top-k, joins
plans      the end-to-end answers (page views, keyed look-ups, workforce,
           k-means, word count) and the fixtures derived from driver tables
streaming  micro-batch loading of page views into a keyed table
cli        ``python -m pagetrail <command>``: every job on Parquet / text inputs
"""

__version__ = "0.1.0"
