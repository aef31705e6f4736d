"""Top-k and top-n-per-group with a total order.

Orders are lists of ``(column, "asc" | "desc")``. Ascending puts nulls first
and descending puts them last (Spark's defaults), and every caller passes
tie-breakers so results do not depend on partitioning.

* ``top_k`` — ``orderBy(...).limit(n)``, planned as TakeOrderedAndProject:
  each task keeps its own n best rows and one task merges
  ``n * partitions`` rows, bounded by n.
* ``top_per_group`` — ``row_number()`` over a window with ``rank <= n``.
  Spark plans it with a *partial* WindowGroupLimit before the shuffle: each
  task sorts its own rows and keeps only the best n per group, so a group
  that owns a third of all rows crosses the shuffle as n rows per task and
  the final window never buffers more than that.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Order = Sequence[tuple[str, str]]


def order_columns(order: Order) -> list[Column]:
    cols = []
    for name, direction in order:
        d = direction.lower()
        if d not in ("asc", "desc"):
            raise ValueError(f"bad direction {direction!r}")
        cols.append(F.col(name).asc_nulls_first() if d == "asc" else F.col(name).desc_nulls_last())
    return cols


def top_k(df: DataFrame, order: Order, n: int) -> DataFrame:
    """The first ``n`` rows of ``df`` under ``order``."""
    return df.orderBy(*order_columns(order)).limit(n)


def top_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Order,
    n: int = 1,
    rank_col: str | None = "rank",
) -> DataFrame:
    """Best ``n`` rows per group of ``keys`` under ``order``.

    ``rank_col`` (1-based row number within the group) is added when given.
    """
    w = Window.partitionBy(*keys).orderBy(*order_columns(order))
    rn = rank_col or "__rank"
    out = df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) <= n)
    return out if rank_col else out.drop(rn)
