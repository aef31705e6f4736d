"""The store of keyed tables: merges, crashes, pruned look-ups."""

import os
import random

import pytest
from pyspark.sql import functions as F

from pagetrail import sinks
from pagetrail.sinks import store as store_module


def keyed(spark, rows, schema="row_key string, a int, b int"):
    return spark.createDataFrame(rows, schema)


def numbers(n):
    return [(f"k{i:04d}", i, i) for i in range(n)]


def content(spark, path):
    return {r[0]: tuple(r)[1:] for r in sinks.open_store(spark, path).read().collect()}


@pytest.fixture()
def path(spark, tmp_dir):
    out = os.path.join(tmp_dir, "store")
    sinks.create_store(keyed(spark, numbers(1000)), out, ranges=16)
    return out


def test_ranges_are_whole_and_sorted(spark, path):
    store = sinks.open_store(spark, path)
    assert len(store.files) >= 16 and sum(store.rows) == 1000 and store.firsts[0] is None
    assert list(store.firsts[1:]) == sorted(store.firsts[1:])
    for i, (first, n) in enumerate(zip(store.firsts, store.rows)):
        keys = [r[0] for r in store.read([i]).select("row_key").collect()]
        assert len(keys) == n and keys == sorted(keys) and (first is None or keys[0] == first)
    found = store.read().select("row_key", store.range_of(F.col("row_key")).alias("i")).collect()
    assert {r.row_key for r in found if r.i == 3} == {r.row_key for r in store.read([3]).collect()}


def test_merge_rewrites_touched_ranges_only(spark, path):
    before = sinks.open_store(spark, path)
    # a stored row loses a to the batch and keeps b; two keys are new, one cell is new, a null key is not stored
    batch = keyed(spark, [("k0007", -1, None, "x"), ("new", 5, 6, None), ("a", 1, 2, None), (None, 1, 1, "z")], "row_key string, a int, b int, c string")
    touched = sinks.merge_store(batch, path)
    after = sinks.open_store(spark, path)
    assert touched == 2 and after.version == before.version + 1
    assert len(set(before.files) - set(after.files)) == 2 and after.firsts == before.firsts
    want = {k: (a, b, None) for k, a, b in numbers(1000)} | {"k0007": (-1, 7, "x"), "new": (5, 6, None), "a": (1, 2, None)}
    assert content(spark, path) == want
    assert sinks.merge_store(batch.limit(0), path) == 0 and sinks.open_store(spark, path).files == after.files
    sinks.merge_store(batch, path)  # a repeated merge gives the same table
    assert content(spark, path) == want
    assert {r[0]: tuple(r)[1:] for r in before.read().collect()} == {k: (a, b) for k, a, b in numbers(1000)}  # an old version stays readable


@pytest.mark.parametrize("step", ["_write_ranges", "_commit"])
def test_a_merge_cut_short_leaves_the_old_table(spark, path, monkeypatch, step):
    own = getattr(store_module, step)

    def cut(*args):
        if step == "_write_ranges":
            own(*args)  # all files are there, nothing names them
        raise KeyboardInterrupt

    batch = keyed(spark, [(f"k{i:04d}", -i, None) for i in range(0, 1000, 50)] + [("zz", 1, 1)])
    monkeypatch.setattr(store_module, step, cut)
    with pytest.raises(KeyboardInterrupt):
        sinks.merge_store(batch, path)
    assert content(spark, path) == {k: (a, b) for k, a, b in numbers(1000)}
    monkeypatch.undo()
    sinks.merge_store(batch, path)
    assert content(spark, path) == {k: (-a if a % 50 == 0 else a, b) for k, a, b in numbers(1000)} | {"zz": (1, 1)}


def test_two_merges_at_a_time_do_not_overwrite_each_other(spark, path, monkeypatch):
    own, one, two = store_module._write_ranges, keyed(spark, [("k0001", 1, 9)]), keyed(spark, [("k0002", 2, 9)])

    def meanwhile(*args):
        monkeypatch.undo()
        sinks.merge_store(two, path)
        return own(*args)

    monkeypatch.setattr(store_module, "_write_ranges", meanwhile)
    with pytest.raises(RuntimeError, match="meanwhile"):
        sinks.merge_store(one, path)
    sinks.merge_store(one, path)
    got = content(spark, path)
    assert got["k0001"] == (1, 9) and got["k0002"] == (2, 9)
    store = sinks.open_store(spark, path)
    store_module._commit(store)  # a second manifest of one version
    with pytest.raises(RuntimeError, match="same time"):
        sinks.open_store(spark, path)


def test_a_grown_range_is_split(spark, path):
    before = sinks.open_store(spark, path)
    batch = keyed(spark, [(f"k0500{i:05d}", i, i) for i in range(2000)])
    assert sinks.merge_store(batch, path) == 1
    after = sinks.open_store(spark, path)
    assert len(after.files) > len(before.files) + 10 and max(after.rows) <= 2 * before.rows_per_range
    assert list(after.firsts[1:]) == sorted(set(after.firsts[1:])) and set(before.firsts) <= set(after.firsts)
    assert content(spark, path) == {k: (a, b) for k, a, b in numbers(1000)} | {f"k0500{i:05d}": (i, i) for i in range(2000)}


def test_look_ups_open_the_ranges_they_need(spark, path):
    sinks.merge_store(keyed(spark, [("k0100", -1, None), ("k0900", -2, None)]), path)
    store = sinks.open_store(spark, path)
    few = ["k0100", "k0101", "k0900", "k0100", None, "k0100x"]
    got = store.get(few)
    assert sorted(map(tuple, got.collect())) == [("k0100", -1, 100), ("k0101", 101, 101), ("k0900", -2, 900)]
    assert len(got.inputFiles()) == 2
    assert "In(row_key" in got._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in store.get(["k0100x"], ["b"], keep_missing=True).collect()] == [("k0100x", None)]
    keys = spark.createDataFrame([(k, 1) for k in few], "row_key string, a int")
    with_keys = store.get(keys, ["b"])
    assert sorted(map(tuple, with_keys.collect())) == [("k0100", 100), ("k0100", 100), ("k0101", 101), ("k0900", 900)]
    assert len([f for f in with_keys.inputFiles() if "/data/" in f]) == 2
    assert store.get(keys, ["b"], keep_missing=True).count() == 6
    for start, stop in [("k0100", "k0105"), (None, "k0003"), ("k0998", None), ("a", "b"), ("k0500", "k0500"), ("z", None)]:
        scan = store.scan(start, stop)
        want = [k for k, _, _ in numbers(1000) if (start is None or k >= start) and (stop is None or k < stop)]
        assert sorted(r.row_key for r in scan.collect()) == want and len(scan.inputFiles()) <= 2
    assert store.prefix("k01").count() == 100


def test_range_of_any_number_of_ranges(spark, tmp_dir):
    rng = random.Random(1)
    keys = sorted(rng.sample(range(-500, 500), 300))
    for n in (1, 2, 3, 7, 8, 9):
        path = os.path.join(tmp_dir, f"s{n}")
        store = sinks.create_store(spark.createDataFrame([(k, k) for k in keys], "row_key long, v long"), path, ranges=n)
        got = spark.range(-510, 510).select("id", store.range_of(F.col("id")).alias("i")).collect()
        assert all(r.i == sum(f <= r.id for f in store.firsts[1:]) for r in got)


def test_empty_tables_and_other_keys(spark, tmp_dir):
    path = os.path.join(tmp_dir, "empty")
    none = spark.createDataFrame([], "day date, v int")
    store = sinks.create_store(none, path, key="day")
    assert sinks.is_store(spark, path) and store.read().collect() == [] and store.get([], ["v"]).collect() == []
    batch = spark.sql("SELECT DATE'2024-01-01' + CAST(id AS INT) AS day, id AS v FROM range(10)")
    assert sinks.merge_store(batch, path) == 1
    got = sinks.read_keyed_table(spark, path)
    assert got.count() == 10 and got.schema["v"].dataType.simpleString() == "int"  # the stored type stays
    sinks.create_store(batch.limit(3), path, key="day")  # replaces the table
    assert sinks.open_store(spark, path).version == 3 and sinks.read_keyed_table(spark, path).count() == 3
    assert not sinks.is_store(spark, tmp_dir)
