"""Inputs of the reference's shape, derived by Spark from the driver tables.

The jobs expect a page-view log, six workforce tables, points and text; the
driver ships TPC-H-like tables instead. Each function here is a lazy
DataFrame over those tables, so the work of every query grows with them.
The same derivations are written in SQL for the oracle (``plans.oracle``).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.functions.time import epoch_millis_sql, hour_floor_sql
from pagetrail.operators.joins import salted_join
from pagetrail.schemas import PAGEVIEW_COLUMNS
from pagetrail.session import checkpoint_dir
from pagetrail.sources.files import read_table

# Fixed values of the derivation (chosen for this test bed, see FIXTURES.md).
BIRTH_DATE = "1960-01-01"
HIRE_DATE = "1990-01-01"
FROM_DATE = "1995-01-01"
OPEN_END = "9999-01-01"


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages (page_id 0 to n - 1) with domain and path, taken apart once per page."""
    return read_table(spark, sf_dir, "pages").selectExpr(
        "page_id",
        "regexp_extract(url, '^https?://([^/?#]+)', 1) AS domain",
        "regexp_extract(url, '^https?://[^/?#]+(/[^?#]*)', 1) AS path",
    )


# The page-view columns derived from one event and its page (fixed values of
# the derivation); ``{cookie}`` is the cookie-time expression.
_PAGEVIEW_EXPRS = [
    "ts AS timeCreate",
    "{cookie} AS cookieCreate",
    "CAST((event_id * 31 + user_id) % 5 AS INT) AS browserCode",
    "concat('v', CAST(event_id % 9 AS STRING)) AS browserVer",
    "CAST(event_id % 7 AS INT) AS osCode",
    "concat('o', CAST(event_id % 4 AS STRING)) AS osVer",
    "CAST((event_id * 17 + user_id) % 4001 AS BIGINT) AS ip",
    "CAST(event_id % 13 AS INT) AS locId",
    "domain",
    "CAST(event_id % 6 AS INT) AS siteId",
    "CAST(event_id % 8 AS INT) AS cId",
    "path",
    "CAST(NULL AS STRING) AS referer",
    "user_id AS guid",
    "'none' AS flashVersion",
    "CAST(event_id % 2 AS STRING) AS jre",
    "'1920x1080' AS sr",
    "'24' AS sc",
    "CAST(event_id % 3 AS INT) AS geographic",
    "CAST(event_id % 10 AS INT) AS category",
    "event_id",
]


def _pageview_from(events: DataFrame, pages: DataFrame, cookie_sql: str) -> DataFrame:
    n_pages = pages.select(F.count("*")).scalar()  # a one-row subquery of the same plan
    ev = events.withColumn("page_id", F.pmod("event_id", n_pages)).join(pages, "page_id", "inner")
    return ev.selectExpr(*[e.replace("{cookie}", cookie_sql) for e in _PAGEVIEW_EXPRS])


def pageview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page-view log: one row per event, cookie time = the event's hour.

    Many views share one cookie time on purpose (keyed-table collisions).
    ``event_id`` is kept as a unique tie-breaker for upserts.
    """
    events = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    ts_type = events.schema["ts"].dataType
    return _pageview_from(events, _pages(spark, sf_dir), hour_floor_sql("ts", ts_type))


def pageview_lines(spark: SparkSession, sf_dir: str) -> str:
    """Folder with the page-view log as raw tab-separated lines, some of them bad.

    By event id some lines have a time that is none, some lack their last
    field, and some have no cookie time.
    """
    log = pageview(spark, sf_dir)
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in PAGEVIEW_COLUMNS]
    every = lambda n, k: F.col("event_id") % n == k
    raw = log.select("event_id", *fields)
    raw = raw.withColumn("timeCreate", F.when(every(50, 0), F.lit("no time")).otherwise(F.col("timeCreate")))
    raw = raw.withColumn("cookieCreate", F.when(every(70, 7), F.lit("")).otherwise(F.col("cookieCreate")))
    line = F.when(every(90, 11), F.concat_ws("\t", *PAGEVIEW_COLUMNS[:-1])).otherwise(F.concat_ws("\t", *PAGEVIEW_COLUMNS))
    path = f"{checkpoint_dir(spark).rstrip('/')}/raw-log-{uuid.uuid4().hex}"
    raw.select(line).write.text(path)
    return path


def pageview_zoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pageview`` with instants (``timestamp``) for its wall-clock times, read as UTC whatever the session zone."""
    log = pageview(spark, sf_dir)
    times = {c: F.expr(f"timestamp_millis({epoch_millis_sql(c, log.schema[c].dataType)})") for c in ("timeCreate", "cookieCreate")}
    return log.withColumns(times)


def pageview_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page-view log whose cookie time is the user's first event time.

    The per-user minimum is an aggregate joined back on ``user_id``, not a
    window over all of a user's events. The join is salted, as adaptive
    execution does not split one on top of an aggregation: a user owning a
    third of the log meets its minimum in several tasks.
    """
    events = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    first = events.groupBy("user_id").agg(F.min("ts").alias("first_ts"))
    ev = salted_join(events, first, "user_id", ["event_id"])
    return _pageview_from(ev, _pages(spark, sf_dir), "first_ts")


# ---------------------------------------------------------------- workforce


def _dept_no_sql(nationkey: str) -> str:
    return f"concat('d', lpad(CAST({nationkey} AS STRING), 3, '0'))"


def departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation")
    return n.selectExpr(f"{_dept_no_sql('n_nationkey')} AS dept_no", "n_name AS dept_name")


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.selectExpr(
        "c_custkey AS emp_no",
        f"DATE'{BIRTH_DATE}' AS birth_date",
        "c_name AS first_name",
        "c_mktsegment AS last_name",
        "CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender",
        f"DATE'{HIRE_DATE}' AS hire_date",
    )


def dept_emp(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.selectExpr(
        "c_custkey AS emp_no",
        f"{_dept_no_sql('c_nationkey')} AS dept_no",
        f"DATE'{FROM_DATE}' AS from_date",
        f"DATE'{OPEN_END}' AS to_date",
    )


def dept_manager(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The smallest employee number of each department is its manager."""
    de = dept_emp(spark, sf_dir)
    return de.groupBy("dept_no").agg(F.min("emp_no").alias("emp_no")).selectExpr(
        "dept_no", "emp_no", f"DATE'{FROM_DATE}' AS from_date", f"DATE'{OPEN_END}' AS to_date"
    )


def _orders_by_customer_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    return o.selectExpr(
        "o_custkey AS emp_no", "CAST(o_orderdate AS DATE) AS from_date", "o_orderpriority", "o_totalprice"
    )


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One title per (customer, order day): the smallest order priority."""
    o = _orders_by_customer_day(spark, sf_dir)
    return o.groupBy("emp_no", "from_date").agg(F.min("o_orderpriority").alias("title")).selectExpr(
        "emp_no", "title", "from_date", f"DATE'{OPEN_END}' AS to_date"
    )


def titles_ungrouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One title per order, from the first of its month, so that many share an employee and start date."""
    return _orders_by_customer_day(spark, sf_dir).selectExpr(
        "emp_no", "o_orderpriority AS title", "CAST(trunc(from_date, 'MM') AS DATE) AS from_date", f"DATE'{OPEN_END}' AS to_date"
    )


def salaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One salary per (customer, order day), valid until the next one.

    The ``lead`` window is per employee, and an employee has at most one row
    per calendar day after the grouping, so a window group is bounded by the
    number of distinct order days, not by the size of the orders table.
    """
    o = _orders_by_customer_day(spark, sf_dir)
    per_day = o.groupBy("emp_no", "from_date").agg(F.expr("CAST(max(floor(o_totalprice)) AS BIGINT)").alias("salary"))
    return per_day.selectExpr(
        "emp_no",
        "salary",
        "from_date",
        f"coalesce(lead(from_date) OVER (PARTITION BY emp_no ORDER BY from_date), DATE'{OPEN_END}') AS to_date",
    )


# ------------------------------------------------------------------- others


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k-means input: x = quantity, y = discount of every line item."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.selectExpr("l_quantity AS x", "l_discount AS y")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word-count input: the text of every document."""
    return read_table(spark, sf_dir, "documents").select("text")
