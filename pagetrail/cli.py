"""Command line: run one job on Parquet / text inputs.

    python -m pagetrail <command> [options]          # local session
    zip -r pagetrail.zip pagetrail
    spark-submit --py-files pagetrail.zip pagetrail/__main__.py <command> [options]

Every command reads its inputs, runs the job's DataFrame function and either
shows the answer (``--show N``, default 20 rows) or writes it (``--out``,
Parquet; text for the tab export). Keyed tables are written by the ``load-*``
commands: Parquet folders sorted by key, or with ``--ranges`` stores that
``--merge`` merges into.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pagetrail import sinks
from pagetrail.plans import clustering, ingest, keyed_pageviews, pageviews, text, workforce
from pagetrail.sources import read_jdbc, read_jdbc_auto, read_pageview_parquet, read_pageview_tsv, read_points_text


def _millis(s: str) -> int:
    t = dt.datetime.fromisoformat(s)
    if t.tzinfo is None:
        t = t.replace(tzinfo=dt.timezone.utc)
    return int(t.timestamp() * 1000)


def _emit(df: DataFrame, args: argparse.Namespace) -> None:
    if getattr(args, "explain", False):
        df.explain("formatted")
    if args.out:
        sinks.write_parquet(df, args.out)
    else:
        df.show(args.show, truncate=False)


def _log(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    return read_pageview_parquet(spark, args.log)


def _table(spark: SparkSession, path: str | None) -> DataFrame | None:
    return sinks.read_keyed_table(spark, path) if path else None


def _keep(loaded: DataFrame, path: str, args: argparse.Namespace) -> None:
    """Write a loaded table as a Parquet folder or a store, or merge it into the store at ``path``."""
    if args.merge:
        sinks.merge_store(loaded, path)
    elif args.ranges:
        sinks.create_store(loaded, path, ranges=args.ranges)
    else:
        sinks.write_keyed_table(loaded, path)


def _relations(spark: SparkSession, args: argparse.Namespace) -> Callable[[str], DataFrame]:
    """Reader of the workforce tables by name: Parquet folders, or a database (the large ones by ranges of emp_no)."""
    if bool(args.tables) == bool(args.jdbc_url):
        raise SystemExit("give either --tables or --jdbc-url")
    if args.tables:
        return lambda name: spark.read.parquet(f"{args.tables.rstrip('/')}/{name}")
    props = dict(p.split("=", 1) for p in args.jdbc_property)

    def read(name: str) -> DataFrame:
        if name in ("departments", "dept_manager"):
            return read_jdbc(spark, args.jdbc_url, name, properties=props)
        return read_jdbc_auto(spark, args.jdbc_url, name, "emp_no", properties=props)

    return read


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    c = args.command
    if c == "tsv-to-parquet" and args.quarantine:
        for name, n in ingest.ingest_tsv(spark, args.src, args.dst, args.quarantine).items():
            print(f"{name}\t{n}")
    elif c == "tsv-to-parquet":
        sinks.write_parquet(read_pageview_tsv(spark, args.src), args.dst)
    elif c == "top-urls":
        _emit(pageviews.top_url_per_guid_day(_log(spark, args)), args)
    elif c == "top-ips":
        _emit(pageviews.top_ips_by_guid(_log(spark, args), args.n), args)
    elif c == "top-domains":
        _emit(pageviews.top_domains(_log(spark, args), args.n), args)
    elif c == "top-locations":
        _emit(pageviews.top_locations_by_ip(_log(spark, args), args.n), args)
    elif c == "top-browsers":
        _emit(pageviews.top_browser_per_os(_log(spark, args)), args)
    elif c == "gap-export":
        lines = (
            pageviews.gap_export_whole_seconds(_log(spark, args), int(args.gap_seconds), args.fill_nulls)
            if args.whole_seconds
            else pageviews.gap_export(_log(spark, args), args.gap_seconds, args.fill_nulls)
        )
        if args.out:
            sinks.write_text(lines, args.out)
        else:
            lines.show(args.show, truncate=False)
    elif c == "report":
        out = args.out.rstrip("/")
        log = _log(spark, args)
        for name, df in pageviews.report(pageviews.stored_counts(log)).items():
            sinks.write_parquet(df, f"{out}/{name}")
        sinks.write_text(pageviews.gap_export(log, args.gap_seconds), f"{out}/result.dat")
    elif c == "load-pageviews":
        log = _log(spark, args)
        _keep(keyed_pageviews.load_pageviews(log, target=_table(spark, args.into)), args.table, args)
        if args.visits:
            _keep(keyed_pageviews.load_pageviews_by_visit(log), args.visits, args)
    elif c == "urls-of-guid-day":
        day = f"{args.guid}_{args.day}"
        visits = sinks.open_store(spark, args.visits).prefix(day) if sinks.is_store(spark, args.visits) else spark.read.parquet(args.visits)
        _emit(keyed_pageviews.urls_of_guid_day(visits, args.guid, args.day), args)
    elif c == "ips-of-guid":
        _emit(keyed_pageviews.ips_of_guid(_log(spark, args), args.guid, _table(spark, args.table)), args)
    elif c == "last-visit":
        _emit(keyed_pageviews.last_visit(_log(spark, args), args.guid, _table(spark, args.table)), args)
    elif c == "guids-os-browser-time":
        _emit(
            keyed_pageviews.guids_os_browser_time(
                _log(spark, args), args.os, args.browser, _millis(args.t1), _millis(args.t2), _table(spark, args.table)
            ),
            args,
        )
    elif c == "load-workforce":
        read = _relations(spark, args)
        flat = workforce.flatten_dept_emp(read("dept_emp"), read("employees"), read("departments"), read("dept_manager"))
        out = args.keyed.rstrip("/")
        _keep(workforce.load_dept_emp(flat, _table(spark, args.into_dept_emp)), f"{out}/dept_emp", args)
        _keep(workforce.load_salaries(read("salaries"), _table(spark, args.into_salaries)), f"{out}/salaries", args)
        _keep(workforce.load_titles(read("titles"), _table(spark, args.into_titles)), f"{out}/titles", args)
    elif c == "dept-members":
        fn = workforce.department_managers if args.managers else workforce.department_members
        _emit(fn(_table(spark, args.keyed), spark.read.parquet(args.dept_emp), args.dept), args)
    elif c == "payroll":
        _emit(workforce.payroll_on(spark.read.parquet(args.salaries), args.date, _table(spark, args.keyed)), args)
    elif c == "titles":
        _emit(workforce.titles_of(_table(spark, args.keyed), spark.read.parquet(args.titles), args.emp), args)
    elif c == "kmeans":
        pts = read_points_text(spark, args.points)
        model = clustering.fit(pts, args.k, args.seed)
        clustering.centers(model, spark).show(args.k, truncate=False)
        _emit(clustering.assign(model, pts), args)
    elif c == "word-count":
        _emit(text.word_count(spark.read.text(args.text).withColumnRenamed("value", "text")), args)
    else:  # pragma: no cover - argparse rejects unknown commands
        raise SystemExit(f"unknown command {c}")


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="pagetrail", description=__doc__.splitlines()[0])
    ap.add_argument("--master", default=None, help="Spark master (default: from spark-submit, else local[*])")
    sub = ap.add_subparsers(dest="command", required=True)

    def cmd(name: str, help_: str) -> argparse.ArgumentParser:
        p = sub.add_parser(name, help=help_)
        p.add_argument("--out", help="write the answer here (Parquet) instead of showing it")
        p.add_argument("--show", type=int, default=20, help="rows to show")
        p.add_argument("--explain", action="store_true", help="print the physical plan first")
        return p

    def store_options(p: argparse.ArgumentParser) -> None:
        p.add_argument("--ranges", type=int, help="write the keyed tables as stores of so many key ranges, for later merges")
        p.add_argument("--merge", action="store_true", help="merge into the stores in place; only ranges that hold a loaded key are rewritten")

    p = cmd("tsv-to-parquet", "raw tab-separated log -> Parquet (overwrite)")
    p.add_argument("--src", required=True)
    p.add_argument("--dst", required=True)
    p.add_argument("--quarantine", help="move lines with a bad field here, and print the counts of lines read, rejected and without a key")
    for name, help_ in [
        ("top-urls", "most visited path per visitor and day"),
        ("top-browsers", "most used browser per OS"),
    ]:
        cmd(name, help_).add_argument("--log", required=True)
    for name, help_, n in [
        ("top-ips", "addresses used by the most visitors", pageviews.TOP_IPS),
        ("top-domains", "most visited domains", pageviews.TOP_DOMAINS),
        ("top-locations", "locations with the most distinct addresses", pageviews.TOP_LOCATIONS),
    ]:
        p = cmd(name, help_)
        p.add_argument("--log", required=True)
        p.add_argument("--n", type=int, default=n)
    p = cmd("gap-export", "views later than their cookie by a gap, tab-joined (text with --out)")
    p.add_argument("--log", required=True)
    p.add_argument("--gap-seconds", type=float, default=600)
    p.add_argument("--whole-seconds", action="store_true", help="compare whole epoch seconds")
    p.add_argument("--fill-nulls", action="store_true")
    p = sub.add_parser("report", help="every page-view answer: the counts in one pass, then the gap export (writes under --out)")
    p.add_argument("--log", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--gap-seconds", type=float, default=600)
    p = cmd("load-pageviews", "load the log into the cookie-keyed table (and the visit-keyed one)")
    p.add_argument("--log", required=True)
    p.add_argument("--table", required=True, help="output folder of the cookie-keyed table")
    p.add_argument("--into", help="existing keyed table to merge into (a folder other than --table)")
    store_options(p)
    p.add_argument("--visits", help="also write the visit-keyed table here")
    p = cmd("urls-of-guid-day", "paths of a visitor on a day (visit-keyed table)")
    p.add_argument("--visits", required=True)
    p.add_argument("--guid", type=int, required=True)
    p.add_argument("--day", required=True)
    for name, help_ in [("ips-of-guid", "addresses of a visitor by frequency"), ("last-visit", "latest visit")]:
        p = cmd(name, help_)
        p.add_argument("--log", required=True)
        p.add_argument("--table", help="stored cookie-keyed table (default: loaded from the log)")
        p.add_argument("--guid", type=int, required=True)
    p = cmd("guids-os-browser-time", "visits with an OS, browser and open time range")
    p.add_argument("--log", required=True)
    p.add_argument("--table")
    p.add_argument("--os", type=int, required=True)
    p.add_argument("--browser", type=int, required=True)
    p.add_argument("--t1", required=True, help="ISO time, UTC if no zone")
    p.add_argument("--t2", required=True)
    p = cmd("load-workforce", "flatten dept_emp and load the three keyed tables")
    p.add_argument("--tables", help="folder with dept_emp, employees, departments, dept_manager, salaries, titles")
    p.add_argument("--jdbc-url", help="database with these tables, instead of --tables")
    p.add_argument("--jdbc-property", action="append", default=[], metavar="NAME=VALUE", help="JDBC option such as user or driver; may be repeated")
    p.add_argument("--keyed", required=True, help="output folder for the keyed tables")
    store_options(p)
    for name in ("dept-emp", "salaries", "titles"):
        p.add_argument(f"--into-{name}", help="existing keyed table to merge into (not under --keyed)")
    p = cmd("dept-members", "members (or --managers) of a department")
    p.add_argument("--keyed", required=True, help="keyed dept_emp table")
    p.add_argument("--dept-emp", required=True, help="dept_emp relation (key list)")
    p.add_argument("--dept", required=True)
    p.add_argument("--managers", action="store_true")
    p = cmd("payroll", "sum of salaries in force on a date")
    p.add_argument("--salaries", required=True)
    p.add_argument("--keyed", help="stored keyed salaries (default: loaded from --salaries)")
    p.add_argument("--date", required=True)
    p = cmd("titles", "titles an employee has held")
    p.add_argument("--keyed", required=True)
    p.add_argument("--titles", required=True)
    p.add_argument("--emp", type=int, required=True)
    p = cmd("kmeans", "k-means over x,y text points")
    p.add_argument("--points", required=True)
    p.add_argument("--k", type=int, required=True)
    p.add_argument("--seed", type=int, default=clustering.KMEANS_SEED)
    p = cmd("word-count", "word count over text files")
    p.add_argument("--text", required=True)
    return ap


def main(argv: list[str] | None = None) -> None:
    from pagetrail.session import build_session

    args = parser().parse_args(argv)
    spark = build_session(app=f"pagetrail-{args.command}", master=args.master)
    run(spark, args)


if __name__ == "__main__":
    main(sys.argv[1:])
