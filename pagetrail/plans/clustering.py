"""k-means over 2-D points with Spark ML (distributed Lloyd iterations)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The seed of the clustering.
KMEANS_SEED = 1


def assemble(points: DataFrame) -> DataFrame:
    """Add the ``features`` vector built from ``x`` and ``y``.

    Points with a missing coordinate cannot be placed and are rejected by the
    assembler, so they are left out of fitting and assignment.
    """
    clean = points.where(F.col("x").isNotNull() & F.col("y").isNotNull())
    return VectorAssembler(inputCols=["x", "y"], outputCol="features").transform(clean)


def fit(points: DataFrame, k: int, seed: int = KMEANS_SEED, max_iter: int = 20) -> KMeansModel:
    """Fit k-means (k-means|| initialisation, other settings default).

    Every iteration is a distributed pass over the points (partial sums per
    task; only k centres per task reach the driver). The feature vectors —
    the only column the iterations read — are kept in memory (spilling to
    disk) for the iterations, then released; a lost cached block is
    recomputed from its lineage.
    """
    features = assemble(points).select("features").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="features").fit(features)
    finally:
        features.unpersist()


def _order(model: KMeansModel) -> list[int]:
    """Positions of the model's centres, sorted by their coordinates: the fit's own numbering is not stable."""
    found = [tuple(map(float, c)) for c in model.clusterCenters()]
    return sorted(range(len(found)), key=lambda i: found[i])


def centers(model: KMeansModel, spark) -> DataFrame:
    """Cluster centres as rows (cluster, x, y) — k rows, numbered in order of (x, y)."""
    found = model.clusterCenters()
    rows = [(n, float(found[i][0]), float(found[i][1])) for n, i in enumerate(_order(model))]
    schema = T.StructType(
        [
            T.StructField("cluster", T.IntegerType(), False),
            T.StructField("x", T.DoubleType(), False),
            T.StructField("y", T.DoubleType(), False),
        ]
    )
    return spark.createDataFrame(rows, schema)


def assign(model: KMeansModel, points: DataFrame) -> DataFrame:
    """Every point with its cluster, numbered as in ``centers``: x, y, features (as array<double>), prediction."""
    out = model.transform(assemble(points))
    number = {i: n for n, i in enumerate(_order(model))}
    named = F.element_at(F.array(*[F.lit(number[i]) for i in range(len(number))]), F.col("prediction") + 1)
    return out.select("x", "y", vector_to_array("features").alias("features"), named.alias("prediction"))


def assign_given(points: DataFrame, given: list[tuple[float, float]], keep: Sequence[str] = ()) -> DataFrame:
    """Every point with the nearest of given centres (x, y, columns to ``keep``, prediction); the first of equally near ones."""
    clean = points.where(F.col("x").isNotNull() & F.col("y").isNotNull())
    x, y = F.col("x").cast("double"), F.col("y").cast("double")
    far = [(x - a) * (x - a) + (y - b) * (y - b) for a, b in given]
    least = F.least(*far) if len(far) > 1 else far[0]
    nearest = F.coalesce(*[F.when(f == least, F.lit(i)) for i, f in enumerate(far)])
    return clean.select("x", "y", *keep, nearest.alias("prediction"))


def step(points: DataFrame, given: list[tuple[float, float]]) -> DataFrame:
    """One update of given centres: (cluster, n, x, y), the means of each centre's points to 6 digits."""
    return assign_given(points, given).groupBy(F.col("prediction").alias("cluster")).agg(
        F.count("*").alias("n"), F.round(F.avg("x"), 6).alias("x"), F.round(F.avg("y"), 6).alias("y")
    )


def settle(points: DataFrame, start: list[tuple[float, float]], max_steps: int = 100) -> tuple[list[tuple[float, float]], int]:
    """Centres that one more ``step`` leaves as they are, from ``start`` on, and the steps taken.

    Each step is one aggregation of the points, and only the k centres reach
    the driver. A centre that is nearest to no point stays where it is.
    """
    now = [(float(x), float(y)) for x, y in start]
    kept = points.select(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for taken in range(max_steps):
            moved = {r.cluster: (r.x, r.y) for r in step(kept, now).collect()}
            after = [moved.get(i, c) for i, c in enumerate(now)]
            if after == now:
                return now, taken
            now = after
    finally:
        kept.unpersist()
    raise RuntimeError(f"the centres have not settled in {max_steps} steps")


def fit_from(points: DataFrame, start: list[tuple[float, float]]) -> DataFrame:
    """k-means from given first centres until nothing moves: (cluster, n, x, y), as ``step`` gives for the settled centres."""
    return step(points, settle(points, start)[0])


def certificate(points: DataFrame, given: list[tuple[float, float]]) -> DataFrame:
    """What one more step would do to given centres: (cluster, n, moved, shift), a row for each, zeros included.

    ``n`` points are nearest to the centre, ``moved`` of them would be nearest to
    another after the step, and the centre would go as far as ``shift``. A
    fit has converged when ``moved`` is 0 and ``shift`` within the fit's tolerance.
    """
    means = {r.cluster: (r.x, r.y) for r in step(points, given).collect()}
    after = [means.get(i, c) for i, c in enumerate(given)]
    both = assign_given(points, given).select("x", "y", F.col("prediction").alias("cluster"))
    again = assign_given(both.select("x", "y", "cluster"), after, keep=["cluster"])
    shift = F.coalesce(*[F.when(F.col("cluster") == i, F.lit(math.dist(a, b))) for i, (a, b) in enumerate(zip(given, after, strict=True))])
    counts = again.groupBy("cluster").agg(F.count("*").alias("n"), F.count_if(F.col("prediction") != F.col("cluster")).alias("moved"))
    every = points.sparkSession.range(len(given)).select(F.col("id").cast("int").alias("cluster"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return every.join(counts, "cluster", "left").select("cluster", zero("n"), zero("moved"), shift.alias("shift"))


def kmeans_certificate(points: DataFrame, k: int, seed: int = KMEANS_SEED) -> DataFrame:
    """``certificate`` of the centres that ``fit`` finds, numbered as in ``centers``."""
    model = fit(points, k, seed)
    return certificate(points, sorted(tuple(map(float, c)) for c in model.clusterCenters()))


def kmeans_centers(points: DataFrame, k: int, seed: int = KMEANS_SEED) -> DataFrame:
    return centers(fit(points, k, seed), points.sparkSession)


def kmeans_assign(points: DataFrame, k: int, seed: int = KMEANS_SEED) -> DataFrame:
    return assign(fit(points, k, seed), points)
