"""Registered answers on a log where one visitor owns a third of all rows.

Every third event is re-assigned to visitor 3 (the visitor the registered
look-ups ask about); answers must still equal the SQL oracle.
"""

import os
import sys

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_compare import digest, duck  # noqa: E402

SRC = "/root/testdata/sf0.001"
NAMES = [
    "pv_top_url_per_guid_day", "pv_top_ips_by_guid", "pv_top_locs_by_ip", "pv_gap_600000s",
    "kv_upsert_pageview", "kv_ips_of_guid", "kv_last_visit", "kv_guids_os_browser_time", "kv_ips_of_guid_log",
]


@pytest.fixture(scope="module")
def skewed_dir(tmp_path_factory):
    d = tmp_path_factory.mktemp("skewed")
    events = pq.read_table(f"{SRC}/events.parquet")
    # event_id % 3 == 0 (ids are non-negative)
    hot = pc.equal(pc.subtract(events["event_id"], pc.multiply(pc.divide(events["event_id"], 3), 3)), 0)
    users = pc.if_else(hot, pa.scalar(3, pa.int64()), events["user_id"])
    events = events.set_column(events.schema.get_field_index("user_id"), "user_id", users)
    pq.write_table(events, f"{d}/events.parquet")
    pq.write_table(pq.read_table(f"{SRC}/pages.parquet"), f"{d}/pages.parquet")
    return str(d)


@pytest.mark.parametrize("name", NAMES)
def test_answers_under_a_hot_visitor(spark, skewed_dir, name):
    con = duck(skewed_dir)
    df = E.queries()[name](spark, skewed_dir)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    orows = cur.fetchall()
    ocols = [c[0] for c in cur.description]
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)


def test_first_seen_join_is_salted(spark, skewed_dir):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = E.queries()["pv_gap_600000s"](spark, skewed_dir)._jdf.queryExecution().executedPlan().toString()
        assert "__salt" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_the_visitor_really_is_hot(skewed_dir):
    n = duck(skewed_dir).execute("SELECT avg(CASE WHEN user_id = 3 THEN 1 ELSE 0 END) FROM events").fetchone()[0]
    assert n > 0.33
