"""Every registered answer against its DuckDB oracle on the smallest tables."""

import math
import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from pagetrail.plans import clustering, fixtures  # noqa: E402
from pagetrail.plans.registry import QUERIES  # noqa: E402
from oracle_compare import digest, duck  # noqa: E402

SF = os.environ.get("PAGETRAIL_TEST_SF", "/root/testdata/sf0.001")
DUCK_TYPE = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "date": "DATE", "double": "DOUBLE",
             "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def check_fit(spark, con, name, rows):
    """The seeded fit has no SQL: its centres are near a fixpoint, and every point is with its nearest centre."""
    n = con.execute("SELECT count(*) FROM lineitem").fetchone()[0]
    if name == "kmeans_certificate":
        assert [r["cluster"] for r in sorted(rows, key=lambda r: r["cluster"])] == [0, 1, 2]
        assert sum(r["n"] for r in rows) == n and sum(r["moved"] for r in rows) <= 0.05 * n and max(r["shift"] for r in rows) < 0.5
        return
    centres = [(r.x, r.y) for r in E.queries()["kmeans_centers"](spark, SF).orderBy("cluster").collect()]
    if name == "kmeans_centers":
        assert [(r["x"], r["y"]) for r in sorted(rows, key=lambda r: r["cluster"])] == centres
        settled, _ = clustering.settle(fixtures.points(spark, SF), centres)
        assert max(math.dist(a, b) for a, b in zip(centres, settled)) < 1
        return
    assert name == "kmeans_assign" and len(rows) == n
    for r in rows:
        far = [math.dist((r["x"], r["y"]), c) for c in centres]
        assert far[r["prediction"]] <= min(far) + 1e-9


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(name)
    if sql is None:
        check_fit(spark, con, name, [r.asDict() for r in df.collect()])
        return
    rel = con.sql(sql)
    spark_types = {f.name: DUCK_TYPE.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    assert spark_types == {c: str(t) for c, t in zip(rel.columns, rel.types)}
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["guid", "timeCreate", "path", "access_count", "rank"]
    assert df.count() > 0
