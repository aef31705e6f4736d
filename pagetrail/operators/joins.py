"""Join helpers.

No join is forced: the planner broadcasts a side whose size in bytes is below
``spark.sql.autoBroadcastJoinThreshold``, and adaptive execution does the same
with the sizes that it has measured.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Parts into which the rows of one key are dealt.
SALTS = 16


def salted_join(rows: DataFrame, lookup: DataFrame, key: str, spread_by: Sequence[str], salts: int = SALTS) -> DataFrame:
    """Inner join of many ``rows`` with ``lookup`` on ``key``; a key's rows go to ``salts`` tasks.

    For a ``lookup`` that is the result of an aggregation: adaptive execution
    does not split a skewed join on top of one, so a key that owns a third of
    the rows would be one task. ``lookup`` is repeated ``salts`` times, and a
    row's part follows from its ``spread_by`` columns, so that a task that is
    run again deals its rows alike.
    """
    left = rows.withColumn("__salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    right = lookup.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [key, "__salt"], "inner").drop("__salt")
