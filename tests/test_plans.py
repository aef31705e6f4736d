"""Plan shape checks: pushdown, pruning, no Python in the hot path."""

import __spark_entry__ as E
from pagetrail.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
# Answers that fit a model or store a table while they are built.
# These fit a model or store a table before they answer.
EAGER = (
    "kmeans_centers", "kmeans_assign", "kmeans_certificate", "kmeans_fit_from", "kv_ips_of_guid_stored", "kv_upsert_pageview_stored",
    "kv_upsert_pageview_bucketed", "kv_get_hours_stored", "kv_urls_of_guid_day_stored", "emp_salaries_page", "pv_report", "pv_ingest_counts", "pv_ingest_rows",
)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udfs_in_any_plan(spark):
    for name, q in QUERIES.items():
        if name in EAGER:
            continue
        p = _plan(q(spark, SF))
        assert "PythonUDF" not in p and "EvalPython" not in p, name


def test_every_page_reaches_the_log_and_columns_are_pruned(spark):
    from pagetrail.plans import fixtures

    p = _plan(E.queries()["pv_top_domains"](spark, SF))
    assert "ReadSchema: struct<page_id:bigint,url:string>" in p  # html never read
    urls = spark.read.parquet(f"{SF}/pages.parquet").selectExpr("regexp_extract(url, '^https?://[^/?#]+(/[^?#]*)', 1) AS path").distinct()
    assert urls.join(fixtures.pageview(spark, SF), "path", "left_anti").count() == 0


def test_building_a_query_starts_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    for name, q in QUERIES.items():
        if name in EAGER:
            continue
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        q(spark, SF)
        assert not tracker.getJobIdsForGroup(f"build-{name}"), name
    spark.sparkContext.setJobGroup("tests", "tests")


def test_lookup_answer_folds_into_one_aggregation(spark):
    p = _plan(E.queries()["kv_ips_of_guid"](spark, SF))
    assert "SortMergeJoin" not in p and "ShuffledHashJoin" not in p
    assert p.count("BroadcastHashJoin") <= 1  # only the page dimension


def test_key_range_pushed_below_upsert(spark):
    from pagetrail.plans import fixtures, keyed_pageviews as K

    df = K.urls_of_guid_day(K.load_pageviews_by_visit(fixtures.pageview(spark, SF)), 3, "2024-01-05")
    opt = df._jdf.queryExecution().optimizedPlan().toString()
    merge_at = min(i for i in (opt.find("Window"), opt.find("Aggregate")) if i >= 0)
    scan_at = opt.index("Relation [event_id")
    filter_at = opt.find("3_2024-01-05", merge_at)
    assert merge_at < filter_at < scan_at  # the key filter sits under the upsert, next to the scan


def test_point_lookups_reach_the_scan(spark):
    p = _plan(E.queries()["kv_urls_of_guid_day"](spark, SF))
    assert "EqualTo(user_id,3)" in p
    p = _plan(E.queries()["emp_titles"](spark, SF))
    assert "EqualTo(o_custkey,82)" in p


def test_time_range_reaches_the_scan(spark):
    p = _plan(E.queries()["kv_guids_os_browser_time_log"](spark, SF))
    assert "GreaterThan(ts,2024-01-05T00:00)" in p and "LessTh" in p  # the plan string cuts long filter lists
