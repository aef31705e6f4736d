import datetime as dt

from helpers import pv_rows, view

from pagetrail.plans import pageviews as P


def test_top_url_tie_goes_to_smaller_path(spark):
    log = pv_rows(spark, [
        view(1, "2024-01-05 10:00:00", path="/b"), view(1, "2024-01-05 11:00:00", path="/b"),
        view(1, "2024-01-05 12:00:00", path="/a"), view(1, "2024-01-05 13:00:00", path="/a"),
        view(1, "2024-01-05 14:00:00", path="/c"),
    ])
    rows = P.top_url_per_guid_day(log).collect()
    assert [(r.guid, r.timeCreate, r.path, r.access_count, r.rank) for r in rows] == [
        (1, dt.date(2024, 1, 5), "/a", 2, 1)
    ]


def test_top_url_midnight_split_gives_two_days(spark):
    log = pv_rows(spark, [view(7, "2024-01-05 23:59:59", path="/x"), view(7, "2024-01-06 00:00:00", path="/y")])
    got = sorted((r.timeCreate, r.path) for r in P.top_url_per_guid_day(log).collect())
    assert got == [(dt.date(2024, 1, 5), "/x"), (dt.date(2024, 1, 6), "/y")]


def test_top_ips_counts_distinct_guids_with_ties_by_ip(spark):
    log = pv_rows(spark, [
        view(1, "2024-01-01 00:00:00", ip=9), view(1, "2024-01-01 00:01:00", ip=9),
        view(2, "2024-01-01 00:02:00", ip=9), view(3, "2024-01-01 00:03:00", ip=5),
        view(4, "2024-01-01 00:04:00", ip=5), view(5, "2024-01-01 00:05:00", ip=7),
    ])
    got = [tuple(r) for r in P.top_ips_by_guid(log, n=2).collect()]
    assert got == [(5, 2), (9, 2)]


def test_top_domains_and_locations(spark):
    log = pv_rows(spark, [
        view(1, "2024-01-01 00:00:00", domain="b.com", locId=1, ip=1),
        view(1, "2024-01-01 00:00:01", domain="b.com", locId=1, ip=1),
        view(1, "2024-01-01 00:00:02", domain="a.com", locId=2, ip=1),
        view(1, "2024-01-01 00:00:03", domain="a.com", locId=2, ip=2),
        view(1, "2024-01-01 00:00:04", domain="c.com", locId=3, ip=3),
    ])
    assert [tuple(r) for r in P.top_domains(log, n=2).collect()] == [("a.com", 2), ("b.com", 2)]
    assert [tuple(r) for r in P.top_locations_by_ip(log, n=2).collect()] == [(2, 2), (1, 1)]


def test_top_browser_per_os(spark):
    log = pv_rows(spark, [
        view(1, "2024-01-01 00:00:00", os_code=1, browser=4), view(1, "2024-01-01 00:00:01", os_code=1, browser=4),
        view(1, "2024-01-01 00:00:02", os_code=1, browser=2), view(1, "2024-01-01 00:00:03", os_code=1, browser=2),
        view(1, "2024-01-01 00:00:04", os_code=2, browser=9),
    ])
    got = sorted(tuple(r) for r in P.top_browser_per_os(log).collect())
    assert got == [(1, 2, 1), (2, 9, 1)]


def test_gap_edge_exactly_ten_minutes_is_out(spark):
    log = pv_rows(spark, [
        view(1, "2024-01-05 10:10:00", cookie="2024-01-05 10:00:00", path="/exact"),
        view(1, "2024-01-05 10:10:00.000001", cookie="2024-01-05 10:00:00", path="/later"),
    ])
    got = [r.concatenated for r in P.gap_export(log, 600).collect()]
    assert got == ["1\tx.com\t/later\t2024-01-05 10:10:00.000001"]


def test_gap_export_null_skips_or_fills(spark):
    log = pv_rows(spark, [view(1, "2024-01-05 11:00:00", cookie="2024-01-05 10:00:00", path=None)])
    assert [r.concatenated for r in P.gap_export(log).collect()] == ["1\tx.com\t2024-01-05 11:00:00"]
    assert [r.concatenated for r in P.gap_export(log, fill_nulls=True).collect()] == ["1\tx.com\t\t2024-01-05 11:00:00"]


def test_whole_second_gap_drops_fractions(spark):
    log = pv_rows(spark, [
        view(1, "2024-01-05 10:00:10.9", cookie="2024-01-05 10:00:00.1", path="/ten"),  # 10 whole s -> not > 10
        view(1, "2024-01-05 10:00:11.0", cookie="2024-01-05 10:00:00.9", path="/eleven"),
    ])
    got = [r.concatenated.split("\t")[2] for r in P.gap_export_whole_seconds(log, 10).collect()]
    assert got == ["/eleven"]
