"""Page views in a keyed table, and the look-ups that read it back.

Two keyed tables are built from a page-view log:

* by cookie time (``load_pageviews``): row key = epoch millis of
  ``cookieCreate`` (a null cookie gives key 0). Every view with the same
  cookie time lands on one key and the latest view wins.
* by visit (``load_pageviews_by_visit``): row key = ``guid_timeCreate``
  text, so the views of one visitor on one day are one key range.

The look-ups (``ips_of_guid``, ``last_visit``, ``guids_os_browser_time``)
take every row of the log, fetch the survivor stored under its cookie key
and answer from the fetched cells — so a survivor counts once per log row
that points at it. With ``keyed=None`` the keyed table is the one loaded
from this same log, and the look-up folds into the load's aggregation: the
number of log rows per key is counted alongside the survivor's cells, so
there is no join back to the log at all. Pass a stored keyed table as
``keyed`` to look up against it instead (then a join is needed).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetrail.functions.keys import join_key
from pagetrail.functions.time import dtype_of, epoch_millis, epoch_millis_sql, open_millis_range_hint, q
from pagetrail.operators.joins import salted_join
from pagetrail.operators.keyed import keyed_upsert, prefix_scan
from pagetrail.operators.topk import top_k
from pagetrail.schemas import PAGEVIEW_COLUMNS, PAGEVIEW_SCHEMA, PAGEVIEW_TIME_COLUMNS, ROW_KEY

TIE_BREAK = "event_id"  # optional unique id column of the log


def cookie_key_sql(log: DataFrame) -> str:
    """Row key of a view in the cookie-keyed table (null cookie -> 0), as SQL."""
    return f"coalesce({epoch_millis_sql('cookieCreate', dtype_of(log, 'cookieCreate'))}, CAST(0 AS BIGINT))"


def pageview_puts(log: DataFrame, null_defaults: bool = True) -> DataFrame:
    """Log rows as puts: ``row_key`` + the 20 cells, times as epoch millis.

    With ``null_defaults`` a null number or time becomes 0 and a null text
    becomes "" (what the loader stores); otherwise nulls stay absent cells.
    A unique id column of the log, if present, is carried as a tie-breaker.
    One ``selectExpr`` builds the whole projection.
    """
    types = {f.name: f.dataType for f in PAGEVIEW_SCHEMA.fields}
    exprs = [f"{cookie_key_sql(log)} AS {ROW_KEY}"]
    for name in PAGEVIEW_COLUMNS:
        if name in PAGEVIEW_TIME_COLUMNS:
            value, default = epoch_millis_sql(name, dtype_of(log, name)), "CAST(0 AS BIGINT)"
        elif isinstance(types[name], T.StringType):
            value, default = q(name), "''"
        else:
            value, default = q(name), f"CAST(0 AS {types[name].simpleString()})"
        exprs.append(f"{f'coalesce({value}, {default})' if null_defaults else value} AS {q(name)}")
    exprs += [q(c) for c in log.columns if c == TIE_BREAK or c.startswith("__")]
    return log.selectExpr(*exprs)


def _version(puts: DataFrame) -> list[str]:
    # Later view wins; then the unique id, or without one the cell values
    # themselves, so the survivor never depends on how rows are partitioned.
    if TIE_BREAK in puts.columns:
        return ["timeCreate", TIE_BREAK]
    return ["timeCreate", *[c for c in PAGEVIEW_COLUMNS if c != "timeCreate"]]


def load_pageviews(
    log: DataFrame,
    target: DataFrame | None = None,
    null_defaults: bool = True,
    cells: list[str] | None = None,
    count_as: str | None = None,
) -> DataFrame:
    """Keyed table by cookie time: ``row_key`` + 20 cells (times in millis)."""
    puts = pageview_puts(log, null_defaults)
    return keyed_upsert(
        puts, cells or PAGEVIEW_COLUMNS, version=_version(puts), target=target, count_as=count_as
    )


def visit_key(log: DataFrame) -> F.Column:
    """``guid_<timeCreate as text>``: one visitor's views sort by time."""
    return join_key(F.col("guid"), F.col("timeCreate").cast("string"))


def load_pageviews_by_visit(log: DataFrame, null_defaults: bool = True) -> DataFrame:
    """Keyed table by visit: text ``row_key`` + the 20 cells."""
    keyed_log = log.withColumn("__visit_key", visit_key(log))
    puts = pageview_puts(keyed_log, null_defaults).withColumn(ROW_KEY, F.col("__visit_key"))
    return keyed_upsert(puts, PAGEVIEW_COLUMNS, version=_version(puts))


def urls_of_guid_day(visits: DataFrame, guid: int, day: str) -> DataFrame:
    """Paths a visitor viewed on ``day`` (``yyyy-MM-dd``), in key order.

    A key-range scan over the by-visit table: keys ``guid_day...``.
    """
    hits = prefix_scan(visits, f"{guid}_{day}")
    return hits.select(ROW_KEY, "path").orderBy(ROW_KEY).select("path")


def urls_of_guid_day_from_log(log: DataFrame, guid: int, day: str) -> DataFrame:
    """``urls_of_guid_day`` on the by-visit table loaded from ``log``.

    Keys ``guid_day...`` come exactly from the views of that visitor on
    that day (the key is the visitor number, "_", then the view time as
    text), so the log is narrowed to those views before the load. The same
    keys are loaded and merged, and the narrowing predicates reach the scan
    (``guid = g`` becomes a pushed Parquet filter).
    """
    narrowed = log.where(
        (F.col("guid") == F.lit(guid)) & (F.to_date("timeCreate") == F.lit(dt.date.fromisoformat(day)))
    )
    return urls_of_guid_day(load_pageviews_by_visit(narrowed), guid, day)


def _keys_of_log(log: DataFrame) -> DataFrame:
    return log.selectExpr(f"{cookie_key_sql(log)} AS {ROW_KEY}")


def _survivors_per_log_row(log: DataFrame, keyed: DataFrame | None, cells: list[str]) -> DataFrame:
    """Survivor cells per key + ``n_rows`` = how many log rows point at it."""
    if keyed is None:
        return load_pageviews(log, cells=cells, count_as="n_rows")
    n = _keys_of_log(log).groupBy(ROW_KEY).agg(F.count(F.lit(1)).alias("n_rows"))
    return keyed.select(ROW_KEY, *cells).join(n, ROW_KEY, "inner")


def ips_of_guid(log: DataFrame, guid: int, keyed: DataFrame | None = None) -> DataFrame:
    """Addresses of a visitor by frequency (ip, count), via the keyed table."""
    per_key = _survivors_per_log_row(log, keyed, ["guid", "ip"])
    hits = per_key.where(F.col("guid") == F.lit(guid))
    counts = hits.groupBy("ip").agg(F.sum("n_rows").alias("count"))
    return counts.orderBy(F.desc("count"), F.asc("ip"))


def last_visit(log: DataFrame, guid: int, keyed: DataFrame | None = None) -> DataFrame:
    """Latest visit of a visitor (guid, timeCreate millis, ip), via the keyed table.

    At most one row; ties go to the smaller ip, then the smaller key.
    """
    per_key = _survivors_per_log_row(log, keyed, ["guid", "timeCreate", "ip"])
    hits = per_key.where(F.col("guid") == F.lit(guid))
    best = top_k(hits, [("timeCreate", "desc"), ("ip", "asc"), (ROW_KEY, "asc")], 1)
    return best.select("guid", "timeCreate", "ip")


def guids_os_browser_time(
    log: DataFrame,
    os_code: int,
    browser_code: int,
    t1_millis: int,
    t2_millis: int,
    keyed: DataFrame | None = None,
) -> DataFrame:
    """Visits with the OS and browser and ``t1 < timeCreate < t2`` (millis).

    One row per log row whose survivor matches (not de-duplicated). The join
    of the log with the matching survivors is salted, so that the rows of a
    hot key are dealt to several tasks; when adaptive execution measures the
    survivors as small, it broadcasts them instead.
    """
    cells = ["guid", "timeCreate", "osCode", "browserCode"]
    table = keyed if keyed is not None else load_pageviews(log, cells=cells)
    match = table.where(
        (F.col("osCode") == F.lit(os_code))
        & (F.col("browserCode") == F.lit(browser_code))
        & (F.col("timeCreate") > F.lit(t1_millis))
        & (F.col("timeCreate") < F.lit(t2_millis))
    ).select(ROW_KEY, *cells)
    spread_by = [c for c in (TIE_BREAK, "timeCreate", "guid") if c in log.columns]
    rows = log.selectExpr(f"{cookie_key_sql(log)} AS {ROW_KEY}", *(f"{q(c)} AS __by_{c}" for c in spread_by))
    return salted_join(rows, match, ROW_KEY, [f"__by_{c}" for c in spread_by]).select(*cells)


# ----------------------------------------------- the same questions on the log


def ips_of_guid_on_log(log: DataFrame, guid: int) -> DataFrame:
    """Addresses of a visitor by frequency, read straight from the log."""
    counts = log.where(F.col("guid") == F.lit(guid)).groupBy("ip").agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), F.asc("ip"))


def last_visit_on_log(log: DataFrame, guid: int) -> DataFrame:
    """Latest view of a visitor from the log (guid, timeCreate millis, ip)."""
    rows = log.where(F.col("guid") == F.lit(guid)).select(
        "guid", epoch_millis("timeCreate", dtype_of(log, "timeCreate")).alias("timeCreate"), "ip"
    )
    return top_k(rows, [("timeCreate", "desc"), ("ip", "asc")], 1)


def guids_os_browser_time_on_log(
    log: DataFrame, os_code: int, browser_code: int, t1_millis: int, t2_millis: int
) -> DataFrame:
    """Views with the OS, browser and open time range, from the log.

    The range is also stated on the raw timestamp (an implied, never
    narrower predicate), so the scan can skip row groups by time.
    """
    ttype = dtype_of(log, "timeCreate")
    t = epoch_millis("timeCreate", ttype)
    hinted = log.where(open_millis_range_hint("timeCreate", ttype, t1_millis, t2_millis))
    rows = hinted.select("guid", t.alias("timeCreate"), "osCode", "browserCode")
    return rows.where(
        (F.col("osCode") == F.lit(os_code))
        & (F.col("browserCode") == F.lit(browser_code))
        & (F.col("timeCreate") > F.lit(t1_millis))
        & (F.col("timeCreate") < F.lit(t2_millis))
    )
