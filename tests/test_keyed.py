import datetime as dt

from helpers import pv_rows, view
from pyspark.sql import functions as F

from pagetrail.functions.keys import prefix_successor
from pagetrail.operators.keyed import keyed_upsert, multi_get, prefix_scan, range_scan
from pagetrail.plans import keyed_pageviews as K

UTC = dt.timezone.utc


def _ms(s):
    return int(dt.datetime.fromisoformat(s).replace(tzinfo=UTC).timestamp() * 1000)


def test_key_collision_later_view_wins_and_lookup_counts_each_row(spark):
    log = pv_rows(spark, [
        view(1, "2024-01-05 10:00:00", cookie="2024-01-05 09:00:00", ip=11, event_id=1),
        view(2, "2024-01-05 10:30:00", cookie="2024-01-05 09:00:00", ip=22, event_id=2),
    ])
    table = K.load_pageviews(log).collect()
    assert len(table) == 1 and table[0].guid == 2 and table[0].row_key == _ms("2024-01-05 09:00:00")
    # both log rows look up the survivor of guid 2
    assert [tuple(r) for r in K.ips_of_guid(log, 2).collect()] == [(22, 2)]
    assert K.ips_of_guid(log, 1).count() == 0
    assert [tuple(r) for r in K.ips_of_guid_on_log(log, 1).collect()] == [(11, 1)]


def test_null_row_gets_defaults_and_key_zero(spark):
    log = pv_rows(spark, [{}], with_id=False)
    (row,) = K.load_pageviews(log).collect()
    d = row.asDict()
    assert d["row_key"] == 0 and d["timeCreate"] == 0 and d["cookieCreate"] == 0
    assert d["browserVer"] == "" and d["referer"] == "" and d["ip"] == 0 and d["osCode"] == 0


def test_absent_cell_keeps_earlier_value(spark):
    first = spark.createDataFrame([("k1", "a", "2000-01-01")], "row_key string, v string, mgr string")
    second = spark.createDataFrame([("k1", "b", None)], "row_key string, v string, mgr string")
    t1 = keyed_upsert(first, ["v", "mgr"], ["v"])
    t2 = keyed_upsert(second, ["v", "mgr"], ["v"], target=t1)
    assert [tuple(r) for r in t2.collect()] == [("k1", "b", "2000-01-01")]


def test_upsert_is_idempotent_and_order_independent(spark):
    rows = [("k", i % 3, f"v{i}", i) for i in range(20)]
    df = spark.createDataFrame(rows, "row_key string, a int, b string, ver int")
    once = keyed_upsert(df, ["a", "b"], version=["ver"])
    shuffled = keyed_upsert(df.repartition(7).orderBy(F.rand(3)), ["a", "b"], version=["ver"])
    again = keyed_upsert(df, ["a", "b"], version=["ver"], target=once)
    assert once.collect() == shuffled.collect() == again.collect() == [("k", 19 % 3, "v19")]


def test_upsert_with_count(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 3, 1)], "row_key string, x int, ver int")
    got = sorted(tuple(r) for r in keyed_upsert(df, ["x"], version=["ver"], count_as="n").collect())
    assert got == [("a", 2, 2), ("b", 3, 1)]


def test_multi_get_keeps_multiplicity_and_missing(spark):
    table = spark.createDataFrame([("a", 1), ("b", 2)], "row_key string, x int")
    keys = spark.createDataFrame([("a",), ("a",), ("z",)], "row_key string")
    assert sorted(tuple(r) for r in multi_get(table, keys, ["x"]).collect()) == [("a", 1), ("a", 1)]
    got = sorted(multi_get(table, keys, ["x"], keep_missing=True).collect(), key=lambda r: r.row_key)
    assert [tuple(r) for r in got] == [("a", 1), ("a", 1), ("z", None)]


def test_range_and_prefix_scan_bounds(spark):
    t = spark.createDataFrame([(k,) for k in ["3_2024-01-05 1", "3_2024-01-05|", "3_2024-01-06", "31_2024", "3_"]], "row_key string")
    got = sorted(r.row_key for r in prefix_scan(t, "3_2024-01-05").collect())
    assert got == ["3_2024-01-05 1", "3_2024-01-05|"]
    got = sorted(r.row_key for r in range_scan(t, "3_2024-01-05", "3_2024-01-05|").collect())
    assert got == ["3_2024-01-05 1"]
    assert prefix_successor("ab") == "ac" and prefix_successor("") is None


def test_urls_of_guid_day_by_visit_key(spark):
    log = pv_rows(spark, [
        view(3, "2024-01-05 08:00:00", path="/morning"), view(3, "2024-01-05 20:00:00", path="/evening"),
        view(3, "2024-01-06 00:00:00", path="/next"), view(31, "2024-01-05 09:00:00", path="/other"),
    ])
    got = [r.path for r in K.urls_of_guid_day(K.load_pageviews_by_visit(log), 3, "2024-01-05").collect()]
    assert got == ["/morning", "/evening"]
    assert [r.path for r in K.urls_of_guid_day_from_log(log, 3, "2024-01-05").collect()] == got


def test_lookups_against_stored_table_equal_fused_path(spark):
    log = pv_rows(spark, [
        view(g, f"2024-01-0{d} {h:02d}:15:00", cookie=f"2024-01-0{d} {h:02d}:00:00", ip=(g * 7 + h) % 5,
             os_code=g % 2, browser=h % 3, event_id=g * 100 + d * 10 + h)
        for g in range(1, 5) for d in range(5, 9) for h in range(0, 24, 5)
    ])
    keyed = K.load_pageviews(log)
    for g in (1, 2, 3):
        assert K.ips_of_guid(log, g).collect() == K.ips_of_guid(log, g, keyed=keyed).collect()
        assert K.last_visit(log, g).collect() == K.last_visit(log, g, keyed=keyed).collect()
    t1, t2 = _ms("2024-01-05 00:00:00"), _ms("2024-01-08 00:00:00")
    a = sorted(K.guids_os_browser_time(log, 0, 0, t1, t2).collect())
    b = sorted(K.guids_os_browser_time(log, 0, 0, t1, t2, keyed=keyed).collect())
    assert a == b and len(a) > 0


def test_open_time_bounds(spark):
    log = pv_rows(spark, [
        view(1, "2024-01-05 00:00:00", cookie="2024-01-05 00:00:00", os_code=2, browser=3, event_id=1),
        view(1, "2024-01-06 00:00:00", cookie="2024-01-06 00:00:00", os_code=2, browser=3, event_id=2),
        view(1, "2024-01-07 00:00:00", cookie="2024-01-07 00:00:00", os_code=2, browser=3, event_id=3),
    ])
    t1, t2 = _ms("2024-01-05 00:00:00"), _ms("2024-01-07 00:00:00")
    got = [r.timeCreate for r in K.guids_os_browser_time(log, 2, 3, t1, t2).collect()]
    assert got == [_ms("2024-01-06 00:00:00")]
    assert [r.timeCreate for r in K.guids_os_browser_time_on_log(log, 2, 3, t1, t2).collect()] == got


def test_last_visit_empty_gives_no_row(spark):
    log = pv_rows(spark, [view(1, "2024-01-05 00:00:00", cookie="2024-01-05 00:00:00", event_id=1)])
    assert K.last_visit(log, 99).count() == 0
    assert K.last_visit_on_log(log, 99).count() == 0


def test_merge_keeps_untouched_rows_and_cells(spark):
    target = spark.createDataFrame([(f"k{i}", i, "old") for i in range(200)], "row_key string, x int, y string")
    batch = spark.createDataFrame([("k5", "new"), ("k500", None)], "row_key string, y string")
    merged = keyed_upsert(batch, ["x", "y"], ["y"], target=target)
    rows = {r.row_key: (r.x, r.y) for r in merged.collect()}
    assert len(rows) == 201 and rows["k5"] == (5, "new") and rows["k500"] == (None, None) and rows["k7"] == (7, "old")


def test_merge_drops_no_target_cell_and_needs_an_order(spark):
    import pytest

    target = spark.createDataFrame([("j", 1, 3)], "row_key string, a int, b int")
    batch = spark.createDataFrame([("j", 7)], "row_key string, a int")
    assert keyed_upsert(batch, ["a"], ["a"], target=target).collect() == [("j", 7, 3)]
    with pytest.raises(ValueError):
        keyed_upsert(batch, ["a"], [])


def test_repeated_target_rows_become_one_whatever_the_batch(spark):
    target = spark.createDataFrame([("j", 3), ("j", None)], "row_key string, a int")
    for keys in (["x"], ["j"]):
        batch = spark.createDataFrame([(k, 9) for k in keys], "row_key string, a int")
        got = {r.row_key: r.a for r in keyed_upsert(batch, ["a"], ["a"], target=target).collect()}
        assert got == {"j": 9 if keys == ["j"] else 3, **{k: 9 for k in keys}}


def test_a_null_version_is_the_least_and_still_stored(spark):
    for rows in ([("k", 7, None)], [("k", 8, None), ("k", 7, 1)], [("k", 7, 1), ("k", 8, None)]):
        df = spark.createDataFrame(rows, "row_key string, a int, v int")
        assert keyed_upsert(df, ["a"], ["v"]).collect() == [("k", 7)]


def test_colliding_titles_do_not_depend_on_input_order(spark):
    from pagetrail.plans import workforce as W

    d = dt.date
    rows = [(1, "Engineer", d(2000, 1, 1), d(2001, 1, 1)), (1, "Staff", d(2000, 1, 1), d(2001, 1, 1))]
    for r in (rows, rows[::-1]):
        df = spark.createDataFrame(r, "emp_no long, title string, from_date date, to_date date").coalesce(1)
        assert [x.title for x in W.load_titles(df).collect()] == ["Staff"]


def test_salted_join_equals_the_plain_join(spark):
    from pagetrail.operators.joins import salted_join

    rows = spark.createDataFrame([(i % 3 and 7, i) for i in range(60)], "k int, id int")
    lookup = rows.groupBy("k").agg(F.min("id").alias("low"))
    assert sorted(salted_join(rows, lookup, "k", ["id"]).collect()) == sorted(rows.join(lookup, "k").collect())


def test_multi_get_with_family_qualified_cells(spark):
    import pytest

    from pagetrail.schemas import DEPT_EMP_FAMILIES

    table = spark.createDataFrame([("d001_1", 1, "Ann", None)], "row_key string, emp_no long, first_name string, dm_from_date date")
    keys = spark.createDataFrame([("d001_1",)], "row_key string")
    got = multi_get(table, keys, ["cf_employee:emp_no", "cf_employee:first_name", "cf_manager:dm_from_date"],
                    families=DEPT_EMP_FAMILIES)
    assert got.columns == ["row_key", "emp_no", "first_name", "dm_from_date"]
    assert tuple(got.first()) == ("d001_1", 1, "Ann", None)
    with pytest.raises(KeyError):
        multi_get(table, keys, ["cf_info:emp_no"], families=DEPT_EMP_FAMILIES)
