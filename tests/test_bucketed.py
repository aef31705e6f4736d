"""Merges of bucketed tables."""

import os
import uuid

import pytest

from pagetrail import sinks


@pytest.fixture()
def table(spark, tmp_dir):
    name = f"t_{uuid.uuid4().hex}"
    rows = spark.range(0, 5000, 1, 3).selectExpr("concat('k', id) AS row_key", "CAST(id AS INT) AS a", "id AS b")
    sinks.write_bucketed(rows, name, os.path.join(tmp_dir, "first"), 6)
    return name


BATCH = [("k7", -1, None, "x"), ("new", 5, 6, None), (None, 1, 1, "z"), ("k8", None, -8, None)]


def batch_of(spark):
    return spark.createDataFrame(BATCH, "row_key string, a long, b long, c string")


def test_merge_is_last_writer_wins_per_cell(spark, tmp_dir, table):
    before = {r.row_key: tuple(r) for r in spark.table(table).collect()}
    into = f"{table}_merged"
    sinks.merge_bucketed(batch_of(spark), table, into, os.path.join(tmp_dir, "merged"))
    got = {r.row_key: (r.a, r.b, r.c) for r in spark.table(into).collect()}
    want = {f"k{i}": (i, i, None) for i in range(5000)} | {"k7": (-1, 7, "x"), "new": (5, 6, None), "k8": (8, -8, None)}
    assert got == want and spark.table(into).schema["a"].dataType.simpleString() == "int"
    assert {r.row_key: tuple(r) for r in spark.table(table).collect()} == before
    assert len([f for f in os.listdir(os.path.join(tmp_dir, "merged")) if f.startswith("part-")]) == 6
    again = f"{into}_again"  # the result is bucketed in its turn
    sinks.merge_bucketed(batch_of(spark), into, again, os.path.join(tmp_dir, "again"))
    assert {r.row_key: (r.a, r.b, r.c) for r in spark.table(again).collect()} == want
    sinks.merge_bucketed(batch_of(spark).limit(0), into, f"{into}_same", os.path.join(tmp_dir, "same"))
    assert spark.table(f"{into}_same").count() == len(want)


def test_the_target_is_not_shuffled(spark, table):
    merged = sinks.bucketed_merge(batch_of(spark), table)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    assert not any("Exchange" in line for line in lines[join:scan])
    assert plan.count("Exchange") == 1  # that of the batch
