"""Registered answers: name -> callable(spark, sf_dir) -> DataFrame.

Each callable derives its inputs from the driver tables under ``sf_dir``
(``plans.fixtures``) and runs one job of this package over them, whole.
Parameter values are ones with non-empty answers on the test tables.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.operators import paged
from pagetrail.plans import clustering, fixtures, ingest, keyed_pageviews, pageviews, text, workforce
from pagetrail.session import checkpoint_dir
from pagetrail.sinks import Store, create_store, merge_bucketed, merge_store, open_store, write_bucketed, write_keyed_table

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered look-ups.
GUID = 3
DAY = "2024-01-05"
OS_CODE = 2
BROWSER_CODE = 3
T1 = dt.datetime(2024, 1, 5, tzinfo=dt.timezone.utc)
T2 = dt.datetime(2024, 1, 10, tzinfo=dt.timezone.utc)
DEPT_NO = "d001"
PAYROLL_DATE = "1999-01-01"
EMP_NO = 82
KMEANS_K = 3
GIVEN_CENTERS = [(10.0, 0.02), (25.0, 0.05), (41.0, 0.08)]
FIT_FROM = [(1.0, 0.0), (2.0, 0.05), (3.0, 0.1)]
PAGE_SIZE = 100
PAGE_NUMBER = 9
FEW_DOMAINS = 7
MERGE_DAY = "2024-01-08"
REPUT_DATE = "2001-01-01"
HALF_HOUR = 30
STORE_RANGES = 16
BUCKETS = 16
HOURS = [dt.datetime(2024, 1, 3, h, tzinfo=dt.timezone.utc) for h in (5, 6, 23)] + [dt.datetime(2024, 1, 20, 7, tzinfo=dt.timezone.utc)]
GAP_SECONDS = 600
GAP_SECONDS_LITERAL = 600_000


def _millis(t: dt.datetime) -> int:
    return int(t.timestamp() * 1000)


def _pv(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.pageview(spark, sf)


def _hr(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    return (
        fixtures.dept_emp(spark, sf),
        fixtures.employees(spark, sf),
        fixtures.departments(spark, sf),
        fixtures.dept_manager(spark, sf),
    )


def _flat(spark: SparkSession, sf: str) -> DataFrame:
    return workforce.flatten_dept_emp(*_hr(spark, sf))


def _keyed_dept_emp(spark: SparkSession, sf: str) -> DataFrame:
    return workforce.load_dept_emp(_flat(spark, sf))


def _stored(keyed: DataFrame) -> DataFrame:
    """The keyed table written to the shared folder, sorted by key, and read back."""
    spark = keyed.sparkSession
    path = f"{checkpoint_dir(spark)}/keyed-{uuid.uuid4().hex}"
    write_keyed_table(keyed, path)
    return spark.read.schema(keyed.schema).parquet(path)


def _pageview_merge(spark: SparkSession, sf: str) -> DataFrame:
    """The views before a day are stored first, those of that day and later are merged into them."""
    log = _pv(spark, sf)
    early = F.to_date("timeCreate") < F.lit(MERGE_DAY).cast("date")
    return keyed_pageviews.load_pageviews(log.where(~early), target=keyed_pageviews.load_pageviews(log.where(early)))


def _pageview_bucketed_merge(spark: SparkSession, sf: str) -> DataFrame:
    """``_pageview_merge`` with the early views in a bucketed table, which the merge does not shuffle."""
    log, name = _pv(spark, sf), uuid.uuid4().hex
    early = F.to_date("timeCreate") < F.lit(MERGE_DAY).cast("date")
    first, merged, path = f"keyed_{name}", f"merged_{name}", f"{checkpoint_dir(spark)}/bucketed-{name}"
    write_bucketed(keyed_pageviews.load_pageviews(log.where(early)), first, f"{path}/first", BUCKETS)
    merge_bucketed(keyed_pageviews.load_pageviews(log.where(~early)), first, merged, f"{path}/merged")
    return spark.table(merged)


def _merged_store(spark: SparkSession, sf: str, load: Callable[[DataFrame], DataFrame]) -> Store:
    """A store of the views of each hour's second half, into which those of the first half are merged.

    Most cookie hours are in both, and the batch, though earlier in time, is put later.
    """
    log = _pv(spark, sf)
    batch = F.minute("timeCreate") < HALF_HOUR
    path = f"{checkpoint_dir(spark)}/keyed-{uuid.uuid4().hex}"
    create_store(load(log.where(~batch)), path, ranges=STORE_RANGES)
    merge_store(load(log.where(batch)), path)
    return open_store(spark, path)


def _urls_of_guid_day_stored(spark: SparkSession, sf: str) -> DataFrame:
    visits = _merged_store(spark, sf, keyed_pageviews.load_pageviews_by_visit)
    return keyed_pageviews.urls_of_guid_day(visits.prefix(f"{GUID}_{DAY}"), GUID, DAY)


def _ingested(spark: SparkSession, sf: str) -> DataFrame:
    rows, _ = ingest.split_tsv(spark, fixtures.pageview_lines(spark, sf))
    wall = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("timeCreate", "cookieCreate")]
    return rows.where("NOT rejected").select("guid", *wall, "domain", "path", "ip", "category")


def _reput(spark: SparkSession, sf: str) -> DataFrame:
    """Every row put again without manager cells, even employees with a new start date."""
    first = _flat(spark, sf)
    again = first.drop("dm_from_date", "dm_to_date").where(F.col("emp_no") % 2 == 0)
    again = again.withColumn("de_from_date", F.lit(REPUT_DATE).cast("date"))
    return workforce.load_dept_emp(again, target=workforce.load_dept_emp(first))


QUERIES: dict[str, Query] = {
    # page-view analytics
    "pv_top_url_per_guid_day": lambda s, sf: pageviews.top_url_per_guid_day(_pv(s, sf)),
    "pv_top_ips_by_guid": lambda s, sf: pageviews.top_ips_by_guid(_pv(s, sf)),
    "pv_top_domains": lambda s, sf: pageviews.top_domains(_pv(s, sf)),
    "pv_top_domains_few": lambda s, sf: pageviews.top_domains(_pv(s, sf), FEW_DOMAINS),
    "pv_top_locs_by_ip": lambda s, sf: pageviews.top_locations_by_ip(_pv(s, sf)),
    "pv_top_browser_per_os": lambda s, sf: pageviews.top_browser_per_os(_pv(s, sf)),
    "pv_gap_export": lambda s, sf: pageviews.gap_export(_pv(s, sf), GAP_SECONDS),
    "pv_gap_600000s": lambda s, sf: pageviews.gap_export_whole_seconds(
        fixtures.pageview_first_seen(s, sf), GAP_SECONDS_LITERAL
    ),
    "pv_report": lambda s, sf: pageviews.report_table(_pv(s, sf)),
    "pv_ingest_counts": lambda s, sf: ingest.ingest_counts(s, fixtures.pageview_lines(s, sf)),
    "pv_ingest_rows": _ingested,
    # keyed page-view table
    "kv_upsert_pageview": lambda s, sf: keyed_pageviews.load_pageviews(_pv(s, sf)),
    "kv_upsert_pageview_merge": _pageview_merge,
    "kv_upsert_pageview_bucketed": _pageview_bucketed_merge,
    "kv_upsert_pageview_stored": lambda s, sf: _merged_store(s, sf, keyed_pageviews.load_pageviews).read(),
    "kv_get_hours_stored": lambda s, sf: _merged_store(s, sf, keyed_pageviews.load_pageviews).get([_millis(t) for t in HOURS]),
    "kv_upsert_pageview_zoned": lambda s, sf: keyed_pageviews.load_pageviews(fixtures.pageview_zoned(s, sf)),
    "kv_urls_of_guid_day": lambda s, sf: keyed_pageviews.urls_of_guid_day_from_log(_pv(s, sf), GUID, DAY),
    "kv_urls_of_guid_day_stored": _urls_of_guid_day_stored,
    "kv_ips_of_guid": lambda s, sf: keyed_pageviews.ips_of_guid(_pv(s, sf), GUID),
    "kv_last_visit": lambda s, sf: keyed_pageviews.last_visit(_pv(s, sf), GUID),
    "kv_guids_os_browser_time": lambda s, sf: keyed_pageviews.guids_os_browser_time(
        _pv(s, sf), OS_CODE, BROWSER_CODE, _millis(T1), _millis(T2)
    ),
    "kv_ips_of_guid_stored": lambda s, sf: keyed_pageviews.ips_of_guid(
        _pv(s, sf), GUID, keyed=_stored(keyed_pageviews.load_pageviews(_pv(s, sf)))
    ),
    "kv_ips_of_guid_log": lambda s, sf: keyed_pageviews.ips_of_guid_on_log(_pv(s, sf), GUID),
    "kv_last_visit_log": lambda s, sf: keyed_pageviews.last_visit_on_log(_pv(s, sf), GUID),
    "kv_guids_os_browser_time_log": lambda s, sf: keyed_pageviews.guids_os_browser_time_on_log(
        _pv(s, sf), OS_CODE, BROWSER_CODE, _millis(T1), _millis(T2)
    ),
    "kv_guids_os_browser_time_log_zoned": lambda s, sf: keyed_pageviews.guids_os_browser_time_on_log(
        fixtures.pageview_zoned(s, sf), OS_CODE, BROWSER_CODE, _millis(T1), _millis(T2)
    ),
    # workforce
    "emp_flat_dept_emp": _keyed_dept_emp,
    "emp_flat_dept_emp_reput": _reput,
    "emp_flat_count": lambda s, sf: workforce.flat_count(_flat(s, sf)),
    "emp_flat_salaries": lambda s, sf: workforce.load_salaries(fixtures.salaries(s, sf)),
    "emp_flat_titles": lambda s, sf: workforce.load_titles(fixtures.titles(s, sf)),
    "emp_flat_titles_collide": lambda s, sf: workforce.load_titles(fixtures.titles_ungrouped(s, sf)),
    "emp_dept_employees": lambda s, sf: workforce.department_from_tables(*_hr(s, sf), DEPT_NO),
    "emp_dept_managers": lambda s, sf: workforce.department_from_tables(*_hr(s, sf), DEPT_NO, managers=True),
    "emp_salaries_page": lambda s, sf: paged(fixtures.salaries(s, sf), ["emp_no", "from_date"]).page(PAGE_NUMBER, PAGE_SIZE),
    "emp_payroll_on_date": lambda s, sf: workforce.payroll_on(fixtures.salaries(s, sf), PAYROLL_DATE),
    "emp_titles": lambda s, sf: workforce.titles_of_from_table(fixtures.titles(s, sf), EMP_NO),
    "emp_distinct_title_dates": lambda s, sf: workforce.title_dates(fixtures.titles(s, sf)),
    # clustering and text
    "kmeans_centers": lambda s, sf: clustering.kmeans_centers(fixtures.points(s, sf), KMEANS_K),
    "kmeans_assign": lambda s, sf: clustering.kmeans_assign(fixtures.points(s, sf), KMEANS_K),
    "kmeans_certificate": lambda s, sf: clustering.kmeans_certificate(fixtures.points(s, sf), KMEANS_K),
    "kmeans_fit_from": lambda s, sf: clustering.fit_from(fixtures.points(s, sf), FIT_FROM),
    "kmeans_assign_given": lambda s, sf: clustering.assign_given(fixtures.points(s, sf), GIVEN_CENTERS),
    "kmeans_step": lambda s, sf: clustering.step(fixtures.points(s, sf), GIVEN_CENTERS),
    "text_word_count": lambda s, sf: text.word_count(fixtures.texts(s, sf)),
}
