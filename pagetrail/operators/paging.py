"""Pages of a total order, without sorting everything in one task.

The rows are sorted once into range partitions and stored with their place
in their partition. The partitions' row counts are summed up (k numbers), so
a page is known to lie at certain places of certain partitions, and only those
are read.
"""

from __future__ import annotations

import uuid
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetrail.functions.time import q
from pagetrail.session import checkpoint_dir

_PART, _PLACE = "__part", "__place"


@dataclass(frozen=True)
class Paged:
    """A table stored in order. ``ends[i]`` is the number of rows in the partitions up to ``parts[i]``."""

    rows: DataFrame = field(repr=False)
    columns: Sequence[str]
    parts: Sequence[int]
    ends: Sequence[int]

    def __len__(self) -> int:
        return self.ends[-1] if self.ends else 0

    def slice(self, offset: int, limit: int) -> DataFrame:
        """Rows ``offset`` to ``offset + limit - 1`` of the order, in order; fewer at the end of the table."""
        if offset < 0 or limit < 0:
            raise ValueError("offset and limit are not negative")
        stop = min(offset + limit, len(self))
        within = F.lit(False)
        at = bisect_right(self.ends, offset)
        while at < len(self.parts) and (begin := self.ends[at - 1] if at else 0) < stop:
            of_part = F.col(_PART) == self.parts[at]
            within = within | (of_part & (F.col(_PLACE) >= offset - begin) & (F.col(_PLACE) < stop - begin))
            at += 1
        return self.rows.where(within).orderBy(_PART, _PLACE).select(*map(q, self.columns))

    def page(self, number: int, size: int) -> DataFrame:
        """Page ``number`` (from 0) of pages of ``size`` rows."""
        return self.slice(number * size, size)

    def pages(self, size: int) -> Iterator[DataFrame]:
        """All pages, one after another; each row is in just one of them."""
        for number in range(-(-len(self) // size)):
            yield self.page(number, size)


def paged(df: DataFrame, order: Sequence[str], num_partitions: int | None = None) -> Paged:
    """Sort ``df`` into pages' order by the columns ``order`` (ascending, null first) and store it.

    Rows alike in ``order`` are in the order in which they were stored, so
    pages do not overlap; name columns that order the rows totally for pages that
    are the same each time. What reaches the driver is a number per partition.
    """
    spark = df.sparkSession
    parts = int(num_partitions or spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{checkpoint_dir(spark).rstrip('/')}/paged-{uuid.uuid4().hex}"
    # the place is the row number within the task: the low bits of Spark's increasing id
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ordered = df.repartitionByRange(parts, *map(q, order)).sortWithinPartitions(*map(q, order))
    ordered.withColumn(_PART, F.spark_partition_id()).withColumn(_PLACE, place).write.partitionBy(_PART).parquet(path)
    schema = T.StructType([*df.schema.fields, T.StructField(_PLACE, T.LongType()), T.StructField(_PART, T.IntegerType())])
    rows = spark.read.schema(schema).parquet(path)
    counts = sorted((r[0], r[1]) for r in rows.groupBy(_PART).count().collect())
    return Paged(rows, df.columns, [p for p, _ in counts], list(accumulate(n for _, n in counts)))
