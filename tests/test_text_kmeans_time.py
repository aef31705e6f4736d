import math

from pyspark.sql import functions as F

from pagetrail.functions.time import epoch_millis, epoch_seconds, hour_floor
from pagetrail.plans import clustering, text


def test_word_count(spark):
    df = spark.createDataFrame([("The cat, the HAT! 42x",), ("",), (None,), ("é the",)], "text string")
    got = {r.word: r["count"] for r in text.word_count(df).collect()}
    assert got == {"the": 3, "cat": 1, "hat": 1, "42x": 1}


def test_kmeans_prediction_is_nearest_centre(spark):
    pts = [(float(x), float(y)) for x in range(3) for y in range(3)] + [
        (100.0 + x, 100.0 + y) for x in range(3) for y in range(3)
    ] + [(0.0, 100.0 + y) for y in range(3)]
    points = spark.createDataFrame(pts, "x double, y double").coalesce(1)
    model = clustering.fit(points, 3)
    centres = sorted(tuple(c) for c in model.clusterCenters())
    assert len(clustering.centers(model, spark).collect()) == 3
    for r in clustering.assign(model, points).collect():
        d = [math.dist((r.x, r.y), c) for c in centres]
        assert d[r.prediction] == min(d)


def test_kmeans_centres_do_not_depend_on_the_partitions(spark):
    pts = [(float(x + 40 * (x % 3)), float(y)) for x in range(30) for y in range(5)]
    points = spark.createDataFrame(pts, "x double, y double")
    got = [[(r.cluster, round(r.x, 6), round(r.y, 6)) for r in clustering.kmeans_centers(points.repartition(n), 3).collect()] for n in (2, 4)]
    for rows in got:
        assert [r[1:] for r in rows] == sorted(r[1:] for r in rows)
    assert len(got[0]) == len(got[1]) == 3


def _lloyd(pts, centres):
    """Plain Python steps until nothing moves."""
    while True:
        near = [min(range(len(centres)), key=lambda i: ((p[0] - centres[i][0]) ** 2 + (p[1] - centres[i][1]) ** 2, i)) for p in pts]
        after = []
        for i, c in enumerate(centres):
            own = [p for p, n in zip(pts, near) if n == i]
            after.append(tuple(round(sum(p[d] for p in own) / len(own), 6) for d in (0, 1)) if own else c)
        if after == centres:
            return centres, near
        centres = after


def test_settled_centres_are_a_fixpoint(spark):
    pts = [(float(x * x % 37), float(x % 11)) for x in range(200)]
    points = spark.createDataFrame([*pts, (None, 1.0)], "x double, y double")
    start = [(0.0, 0.0), (1.0, 1.0), (2.0, 2.0), (900.0, 900.0)]  # the last is nearest to nothing
    want, near = _lloyd(pts, start)
    got, steps = clustering.settle(points, start)
    assert got == want and steps > 1
    rows = {r.cluster: (r.n, r.x, r.y) for r in clustering.fit_from(points, start).collect()}
    assert rows == {i: (near.count(i), *want[i]) for i in set(near)}
    sure = clustering.certificate(points, got).orderBy("cluster").collect()
    assert [(r.cluster, r.n, r.moved, r.shift) for r in sure] == [(i, near.count(i), 0, 0.0) for i in range(4)]
    assert sum(r.moved for r in clustering.certificate(points, start).collect()) > 0


def test_the_fit_has_converged(spark):
    rows = clustering.kmeans_certificate(spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").selectExpr("l_quantity AS x", "l_discount AS y"), 3).collect()
    n = sum(r.n for r in rows)
    assert len(rows) == 3 and n > 5000 and all(r.shift < 0.5 for r in rows) and sum(r.moved for r in rows) <= 0.05 * n


def test_ntz_epoch_functions_ignore_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        res = []
        for tz in ["UTC", "America/Los_Angeles"]:
            spark.conf.set("spark.sql.session.timeZone", tz)
            df = spark.sql("select timestamp_ntz'2024-07-05 10:30:07.179575' as ts")
            t = df.schema["ts"].dataType
            res.append(tuple(df.select(epoch_millis("ts", t), epoch_seconds("ts", t), hour_floor("ts", t)).first()))
        assert res[0] == res[1]
        assert res[0][0] == 1720175407179 and res[0][1] == 1720175407
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
