"""Page-view analytics over a log with the page-view schema.

Every function takes the log DataFrame and returns the answer DataFrame.
Orders carry tie-breakers so answers are deterministic.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetrail.functions.keys import tab_line
from pagetrail.functions.time import dtype_of, epoch_seconds, seconds_interval
from pagetrail.operators.topk import top_k, top_per_group
from pagetrail.session import checkpoint_dir

# Report sizes of the three top-k answers.
TOP_IPS = 1000
TOP_DOMAINS = 100
TOP_LOCATIONS = 10


def top_url_per_guid_day(log: DataFrame) -> DataFrame:
    """Most visited path of each visitor on each day.

    Columns: guid, timeCreate (the day), path, access_count, rank. Ties go to
    the smaller path. Plan: count per (guid, day, path) (hash aggregation
    with a map-side partial step), then ``row_number() = 1`` per (guid, day),
    which a partial WindowGroupLimit cuts to one row per group and task
    before its shuffle.
    """
    daily = log.select("guid", F.to_date("timeCreate").alias("timeCreate"), "path")
    return _best_url(daily.groupBy("guid", "timeCreate", "path").agg(F.count(F.lit(1)).alias("n")))


def _best_url(counts: DataFrame) -> DataFrame:
    named = counts.select("guid", "timeCreate", "path", F.col("n").alias("access_count"))
    best = top_per_group(named, ["guid", "timeCreate"], [("access_count", "desc"), ("path", "asc")], n=1, rank_col="rank")
    return best.select("guid", "timeCreate", "path", "access_count", "rank")


def distinct_count(log: DataFrame, key: str, of: str, alias: str) -> DataFrame:
    """``count(DISTINCT of)`` per ``key``, safe when one key is hot.

    The (key, of) pairs are de-duplicated with a shuffle on *both* columns,
    then counted per key with partial aggregation (one row per key per
    task crosses the second shuffle). A plain distinct aggregate shuffles
    the pairs on ``key`` alone, so a hot address with millions of visitors
    would land in one task.
    """
    return _per_key(log.select(key, of).distinct(), key, of, alias)


def _per_key(pairs: DataFrame, key: str, of: str, alias: str) -> DataFrame:
    return pairs.groupBy(key).agg(F.count(of).alias(alias))


def _top_ips(per_ip: DataFrame, n: int = TOP_IPS) -> DataFrame:
    return top_k(per_ip, [("guid_count", "desc"), ("ip", "asc")], n)


def top_ips_by_guid(log: DataFrame, n: int = TOP_IPS) -> DataFrame:
    """The ``n`` addresses used by the most distinct visitors (ip, guid_count)."""
    return _top_ips(distinct_count(log, "ip", "guid", "guid_count"), n)


def _top_domains(per_domain: DataFrame, n: int = TOP_DOMAINS) -> DataFrame:
    return top_k(per_domain.select("domain", F.col("n").alias("count")), [("count", "desc"), ("domain", "asc")], n)


def top_domains(log: DataFrame, n: int = TOP_DOMAINS) -> DataFrame:
    """The ``n`` most visited domains (domain, count)."""
    return _top_domains(log.groupBy("domain").agg(F.count(F.lit(1)).alias("n")), n)


def _top_locations(per_loc: DataFrame, n: int = TOP_LOCATIONS) -> DataFrame:
    return top_k(per_loc, [("unique_ip_count", "desc"), ("locId", "asc")], n)


def top_locations_by_ip(log: DataFrame, n: int = TOP_LOCATIONS) -> DataFrame:
    """The ``n`` locations with the most distinct addresses (locId, unique_ip_count)."""
    return _top_locations(distinct_count(log, "locId", "ip", "unique_ip_count"), n)


def top_browser_per_os(log: DataFrame) -> DataFrame:
    """Most used browser of each operating system (osCode, browserCode, rank).

    Ties go to the smaller browser code; the count itself is not returned.
    """
    return _best_browser(log.groupBy("osCode", "browserCode").agg(F.count(F.lit(1)).alias("n")))


def _best_browser(counts: DataFrame) -> DataFrame:
    best = top_per_group(counts, ["osCode"], [("n", "desc"), ("browserCode", "asc")], n=1)
    return best.select("osCode", "browserCode", "rank")


def gap_rows(log: DataFrame, gap_seconds: float = 600) -> DataFrame:
    """Views later than their cookie time by more than ``gap_seconds``."""
    return log.where(F.col("timeCreate") > F.col("cookieCreate") + seconds_interval(gap_seconds))


def gap_rows_whole_seconds(log: DataFrame, gap_seconds: int = 600_000) -> DataFrame:
    """Same test on epoch seconds (sub-second parts dropped first).

    This is the literal comparison ``cast(t as long) > cast(c as long) + gap``.
    """
    t = epoch_seconds("timeCreate", dtype_of(log, "timeCreate"))
    c = epoch_seconds("cookieCreate", dtype_of(log, "cookieCreate"))
    return log.where(t > c + F.lit(gap_seconds))


def export_lines(rows: DataFrame, fill_nulls: bool = False) -> DataFrame:
    """``guid<TAB>domain<TAB>path<TAB>timeCreate`` per row, column ``concatenated``.

    Nulls are skipped (later fields shift left) unless ``fill_nulls``.
    """
    line = tab_line("guid", "domain", "path", "timeCreate", fill_nulls=fill_nulls)
    return rows.select(line.alias("concatenated"))


def gap_export(log: DataFrame, gap_seconds: float = 600, fill_nulls: bool = False) -> DataFrame:
    """Tab-joined export of the views more than ``gap_seconds`` after their cookie."""
    return export_lines(gap_rows(log, gap_seconds), fill_nulls)


def gap_export_whole_seconds(log: DataFrame, gap_seconds: int = 600_000, fill_nulls: bool = False) -> DataFrame:
    """Tab-joined export using the whole-second comparison."""
    return export_lines(gap_rows_whole_seconds(log, gap_seconds), fill_nulls)


# ------------------------------------------------------ all answers together

# The groups that the five counting answers are made of.
REPORT_SETS = {
    "top_url_per_guid_day": ["guid", "timeCreate", "path"],
    "top_ips_by_guid": ["ip", "guid"],
    "top_domains": ["domain"],
    "top_locations_by_ip": ["locId", "ip"],
    "top_browser_per_os": ["osCode", "browserCode"],
}


def report_counts(log: DataFrame) -> DataFrame:
    """Row counts of all groups of ``REPORT_SETS`` in one pass over the log: answer, the group columns and ``n``.

    One aggregation by grouping sets, partial before its shuffle, so each
    group crosses it as one row per task. A column outside an answer's set is null.
    """
    columns = list(dict.fromkeys(c for cols in REPORT_SETS.values() for c in cols))
    daily = log.select(*[F.to_date(c).alias(c) if c == "timeCreate" else c for c in columns])
    counts = daily.groupingSets([[F.col(c) for c in cols] for cols in REPORT_SETS.values()], *columns)
    # the grouping id has a bit for each column, set where the column is not grouped by
    bits = {sum((c not in cols) << (len(columns) - 1 - i) for i, c in enumerate(columns)): name for name, cols in REPORT_SETS.items()}
    answer = F.coalesce(*[F.when(F.col("__set") == b, F.lit(name)) for b, name in bits.items()])
    named = counts.agg(F.grouping_id().alias("__set"), F.count(F.lit(1)).alias("n"))
    return named.select(answer.alias("answer"), *columns, "n")


def stored_counts(log: DataFrame) -> DataFrame:
    """``report_counts`` in the shared folder, a folder per answer; the log is read once, whatever answers are asked."""
    spark = log.sparkSession
    counts = report_counts(log)
    path = f"{checkpoint_dir(spark).rstrip('/')}/report-{uuid.uuid4().hex}"
    counts.write.partitionBy("answer").parquet(path)
    return spark.read.schema(counts.schema).parquet(path)


def report(counts: DataFrame) -> dict[str, DataFrame]:
    """The five counting answers from ``stored_counts`` of a log (or ``report_counts``)."""
    of = {name: counts.where(F.col("answer") == name).select(*cols, "n") for name, cols in REPORT_SETS.items()}
    return {
        "top_url_per_guid_day": _best_url(of["top_url_per_guid_day"]),
        "top_ips_by_guid": _top_ips(_per_key(of["top_ips_by_guid"], "ip", "guid", "guid_count")),
        "top_domains": _top_domains(of["top_domains"]),
        "top_locations_by_ip": _top_locations(_per_key(of["top_locations_by_ip"], "locId", "ip", "unique_ip_count")),
        "top_browser_per_os": _best_browser(of["top_browser_per_os"]),
    }


def report_table(log: DataFrame) -> DataFrame:
    """All five answers as one table (answer, k1, k2, k3, n): the columns of each as text, and its count or rank."""
    answers = report(stored_counts(log))
    rows = []
    for name, df in answers.items():
        keys = [c for c in REPORT_SETS[name] if c in df.columns]
        amount = next(c for c in df.columns if c not in keys)
        texts = [F.col(k).cast("string") for k in keys] + [F.lit(None).cast("string")] * (3 - len(keys))
        rows.append(df.select(F.lit(name).alias("answer"), *[t.alias(f"k{i}") for i, t in enumerate(texts, 1)], F.col(amount).cast("long").alias("n")))
    return reduce(DataFrame.unionByName, rows)
