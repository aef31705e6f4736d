import os

import pytest
from helpers import pv_rows, view

from pagetrail import sinks
from pagetrail.cli import parser, run
from pagetrail.plans import fixtures, workforce
from pagetrail.schemas import PAGEVIEW_COLUMNS


def _run(spark, *argv):
    run(spark, parser().parse_args(list(argv)))


def test_pageview_commands_end_to_end(spark, tmp_dir):
    log = os.path.join(tmp_dir, "log")
    pv_rows(spark, [
        view(3, "2024-01-05 10:20:00", cookie="2024-01-05 10:00:00", path="/a", ip=7, event_id=1),
        view(3, "2024-01-05 11:00:00", cookie="2024-01-05 11:00:00", path="/b", ip=8, event_id=2),
    ]).drop("event_id").write.parquet(log)
    out = os.path.join(tmp_dir, "top")
    _run(spark, "top-urls", "--log", log, "--out", out)
    assert spark.read.parquet(out).count() == 1
    table, visits = os.path.join(tmp_dir, "kv"), os.path.join(tmp_dir, "visits")
    _run(spark, "load-pageviews", "--log", log, "--table", table, "--visits", visits)
    ips = os.path.join(tmp_dir, "ips")
    _run(spark, "ips-of-guid", "--log", log, "--table", table, "--guid", "3", "--out", ips)
    assert sorted(tuple(r) for r in spark.read.parquet(ips).collect()) == [(7, 1), (8, 1)]
    urls = os.path.join(tmp_dir, "urls")
    _run(spark, "urls-of-guid-day", "--visits", visits, "--guid", "3", "--day", "2024-01-05", "--out", urls)
    assert sorted(r.path for r in spark.read.parquet(urls).collect()) == ["/a", "/b"]
    export = os.path.join(tmp_dir, "result.dat")
    _run(spark, "gap-export", "--log", log, "--out", export)
    assert [r.value for r in spark.read.text(export).collect()] == ["3\tx.com\t/a\t2024-01-05 10:20:00"]


def test_load_pageviews_merges_into_its_store(spark, tmp_dir):
    logs = [os.path.join(tmp_dir, f"log{i}") for i in range(2)]
    for i, log in enumerate(logs):
        views = [view(3, "2024-01-05 10:20:00", cookie="2024-01-05 10:00:00", ip=7 + i), view(4, f"2024-01-0{6 + i} 10:20:00", cookie=f"2024-01-0{6 + i} 10:00:00")]
        pv_rows(spark, views).drop("event_id").write.parquet(log)
    table = os.path.join(tmp_dir, "kv")
    _run(spark, "load-pageviews", "--log", logs[0], "--table", table, "--ranges", "2")
    _run(spark, "load-pageviews", "--log", logs[1], "--table", table, "--merge")
    got = sinks.read_keyed_table(spark, table)
    assert sorted((r.guid, r.ip) for r in got.collect()) == [(3, 8), (4, 1), (4, 1)]


def test_load_workforce_takes_one_kind_of_source(spark, tmp_dir):
    for sources in ([], ["--tables", "x", "--jdbc-url", "y"]):
        with pytest.raises(SystemExit):
            _run(spark, "load-workforce", *sources, "--keyed", tmp_dir)


def test_workforce_commands_end_to_end(spark, tmp_dir):
    sf = "/root/testdata/sf0.001"
    tables = os.path.join(tmp_dir, "tables")
    for name in ["dept_emp", "employees", "departments", "dept_manager", "salaries", "titles"]:
        sinks.write_parquet(getattr(fixtures, name)(spark, sf), os.path.join(tables, name))
    keyed = os.path.join(tmp_dir, "keyed")
    _run(spark, "load-workforce", "--tables", tables, "--keyed", keyed)
    again = os.path.join(tmp_dir, "again")  # the same puts merged into the stored tables change nothing
    _run(spark, "load-workforce", "--tables", tables, "--keyed", again, "--into-salaries", os.path.join(keyed, "salaries"),
         "--into-titles", os.path.join(keyed, "titles"))
    for name in ("salaries", "titles"):
        assert sorted(spark.read.parquet(os.path.join(again, name)).collect()) == sorted(spark.read.parquet(os.path.join(keyed, name)).collect())
    members = os.path.join(tmp_dir, "members")
    _run(spark, "dept-members", "--keyed", os.path.join(keyed, "dept_emp"),
         "--dept-emp", os.path.join(tables, "dept_emp"), "--dept", "d001", "--out", members)
    want = workforce.department_members(
        workforce.load_dept_emp(workforce.flatten_dept_emp(
            fixtures.dept_emp(spark, sf), fixtures.employees(spark, sf),
            fixtures.departments(spark, sf), fixtures.dept_manager(spark, sf))),
        fixtures.dept_emp(spark, sf), "d001")
    assert sorted(spark.read.parquet(members).collect()) == sorted(want.collect())
    pay_stored, pay_folded = os.path.join(tmp_dir, "p1"), os.path.join(tmp_dir, "p2")
    sal = os.path.join(tables, "salaries")
    _run(spark, "payroll", "--salaries", sal, "--keyed", os.path.join(keyed, "salaries"), "--date", "1995-06-01", "--out", pay_stored)
    _run(spark, "payroll", "--salaries", sal, "--date", "1995-06-01", "--out", pay_folded)
    assert spark.read.parquet(pay_stored).collect() == spark.read.parquet(pay_folded).collect()


def test_every_other_command_runs(spark, tmp_dir, capsys):
    log = os.path.join(tmp_dir, "log")
    pv_rows(spark, [
        view(3, "2024-01-05 10:20:00", cookie="2024-01-05 10:00:00", path="/a", ip=7, os_code=2, browser=3),
        view(4, "2024-01-06 11:00:00", cookie="2024-01-06 11:00:00", path="/b", ip=8, os_code=2, browser=3),
    ]).drop("event_id").write.parquet(log)
    for cmd in ["top-ips", "top-domains", "top-locations", "top-browsers"]:
        _run(spark, cmd, "--log", log, "--show", "5")
    _run(spark, "last-visit", "--log", log, "--guid", "3")
    _run(spark, "guids-os-browser-time", "--log", log, "--os", "2", "--browser", "3",
         "--t1", "2024-01-05T00:00:00", "--t2", "2024-01-07T00:00:00")
    _run(spark, "gap-export", "--log", log, "--whole-seconds", "--gap-seconds", "60")
    tsv = os.path.join(tmp_dir, "log.tsv")
    with open(tsv, "w") as f:
        f.write("\t".join(["2024-01-05 10:20:00", "2024-01-05 10:00:00"] + ["1"] * 18) + "\n")
    _run(spark, "tsv-to-parquet", "--src", tsv, "--dst", os.path.join(tmp_dir, "from_tsv"))
    assert spark.read.parquet(os.path.join(tmp_dir, "from_tsv")).count() == 1
    pts = os.path.join(tmp_dir, "points.txt")
    with open(pts, "w") as f:
        f.write("\n".join(f"{x},{x % 3}" for x in range(30)) + "\n")
    _run(spark, "kmeans", "--points", pts, "--k", "2", "--out", os.path.join(tmp_dir, "pred"))
    assert spark.read.parquet(os.path.join(tmp_dir, "pred")).count() == 30
    txt = os.path.join(tmp_dir, "docs.txt")
    with open(txt, "w") as f:
        f.write("a b a\nB c\n")
    _run(spark, "word-count", "--text", txt, "--out", os.path.join(tmp_dir, "wc"))
    got = {r.word: r["count"] for r in spark.read.parquet(os.path.join(tmp_dir, "wc")).collect()}
    assert got == {"a": 2, "b": 2, "c": 1}
    titles = os.path.join(tmp_dir, "titles")
    spark.createDataFrame([(82, "Staff", "1995-01-01", "9999-01-01")], "emp_no long, title string, from_date string, to_date string") \
        .selectExpr("emp_no", "title", "CAST(from_date AS DATE) AS from_date", "CAST(to_date AS DATE) AS to_date") \
        .write.parquet(titles)
    keyed_titles = os.path.join(tmp_dir, "keyed_titles")
    from pagetrail.plans import workforce as W
    sinks.write_keyed_table(W.load_titles(spark.read.parquet(titles)), keyed_titles)
    _run(spark, "titles", "--keyed", keyed_titles, "--titles", titles, "--emp", "82", "--out", os.path.join(tmp_dir, "t"))
    assert [r.title for r in spark.read.parquet(os.path.join(tmp_dir, "t")).collect()] == ["Staff"]
    assert "guid" in capsys.readouterr().out


def test_report_writes_every_answer(spark, tmp_dir):
    from pagetrail.plans import pageviews

    log = os.path.join(tmp_dir, "log")
    pv_rows(spark, [
        view(g, f"2024-01-05 1{g}:20:00", cookie=f"2024-01-05 1{g}:00:00", path=f"/{g % 2}", ip=g % 3)
        for g in range(1, 8)
    ]).drop("event_id").write.parquet(log)
    out = os.path.join(tmp_dir, "report")
    _run(spark, "report", "--log", log, "--out", out)
    src = spark.read.parquet(log)
    answers = [pageviews.top_url_per_guid_day, pageviews.top_ips_by_guid, pageviews.top_domains, pageviews.top_locations_by_ip, pageviews.top_browser_per_os]
    for name, answer in zip(pageviews.REPORT_SETS, answers, strict=True):
        assert sorted(spark.read.parquet(os.path.join(out, name)).collect()) == sorted(answer(src).collect())
    assert len(spark.read.text(os.path.join(out, "result.dat")).collect()) == 7


def test_tsv_with_quarantine(spark, tmp_dir, capsys):
    tsv, good, bad = (os.path.join(tmp_dir, n) for n in ("log.tsv", "good", "bad"))
    line = lambda time, cookie: "\t".join([time, cookie] + ["1"] * 18)
    lines = [line("2024-01-05 10:20:00", "2024-01-05 10:00:00"), line("no time", "2024-01-05 10:00:00"), line("2024-01-05 10:20:00", ""), "short\tline"]
    with open(tsv, "w") as f:
        f.write("\n".join(lines) + "\n")
    _run(spark, "tsv-to-parquet", "--src", tsv, "--dst", good, "--quarantine", bad)
    assert sorted(r.value for r in spark.read.text(bad).collect()) == sorted([lines[1], lines[3]])
    rows = spark.read.parquet(good)
    assert rows.count() == 2 and rows.columns == PAGEVIEW_COLUMNS
    assert [x.split("\t") for x in capsys.readouterr().out.split("\n") if "\t" in x] == [["read", "4"], ["rejected", "2"], ["without_key", "1"]]


def test_load_workforce_merges_into_its_stores(spark, tmp_dir):
    sf, tables, keyed = "/root/testdata/sf0.001", os.path.join(tmp_dir, "tables"), os.path.join(tmp_dir, "keyed")
    for name in ["dept_emp", "employees", "departments", "dept_manager", "salaries", "titles"]:
        df = getattr(fixtures, name)(spark, sf)
        sinks.write_parquet(df, os.path.join(tables, name))
        sinks.write_parquet(df.where("emp_no % 3 = 0") if "emp_no" in df.columns else df, os.path.join(tables + "-part", name))
    _run(spark, "load-workforce", "--tables", tables + "-part", "--keyed", keyed, "--ranges", "4")
    _run(spark, "load-workforce", "--tables", tables, "--keyed", keyed, "--merge")
    whole = os.path.join(tmp_dir, "whole")
    _run(spark, "load-workforce", "--tables", tables, "--keyed", whole)
    for name in ("dept_emp", "salaries", "titles"):
        got, want = (sinks.read_keyed_table(spark, os.path.join(d, name)) for d in (keyed, whole))
        assert sinks.open_store(spark, os.path.join(keyed, name)).version == 2
        assert sorted(map(str, got.select(sorted(want.columns)).collect())) == sorted(map(str, want.select(sorted(want.columns)).collect()))
