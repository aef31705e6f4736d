"""Connected components by large-star and small-star rounds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetrail.llm.shared import stored

MAX_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star round over edges (a, b) with a > b.

    Large: every node's larger neighbours move to the smallest node around
    it. Small: every node and its smaller neighbours move to the smallest of
    them. The smallest nodes are pre-aggregated and stored, so a hub's edges
    meet them in a join of plain shuffles, which may be split.
    """
    around = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        around = around.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = stored(around.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "star-least")
    moved = around.join(least, "u")
    if large:
        moved = moved.where("v > u AND v > m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = moved.where("v > m").select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.where("a > b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b); root is the smallest node reachable.

    Loops and rows with a null are left out; direction and repeats do not
    matter. Each round is a stored table, so a lost executor costs a task.
    """
    clean = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current = stored(clean, "edges")
    measure = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    before = measure(current)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        current = stored(_star(stored(_star(current, large=True), "edges"), large=False), "edges")
        after = measure(current)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components have not settled in {MAX_ROUNDS} rounds")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n rows the least row that links (i, j) connect it with."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, i, root[j])
        np.minimum.at(low, j, root[i])
        low = np.minimum(low, low[low])
        if (low == root).all():
            return root
        root = low
