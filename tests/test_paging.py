"""Pages of a total order."""

import random

import pytest
from pyspark.sql import functions as F

from pagetrail.operators import paged


@pytest.fixture()
def rows(spark):
    rng = random.Random(4)
    data = [(rng.choice([None, *range(40)]), i, f"t{i}") for i in range(1000)]
    rng.shuffle(data)
    return data, spark.createDataFrame(data, "k int, id long, text string")


def by_hand(data):
    return sorted(data, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def test_pages_are_limit_and_offset(rows):
    data, df = rows
    want, table = by_hand(data), paged(df.repartition(5), ["k", "id"], 7)
    assert len(table) == 1000
    for offset, limit in [(0, 10), (0, 1000), (137, 200), (995, 10), (1000, 5), (2000, 5), (5, 0), (499, 1)]:
        assert [tuple(r) for r in table.slice(offset, limit).collect()] == want[offset : offset + limit]
    assert [tuple(r) for page in table.pages(130) for r in page.collect()] == want
    with pytest.raises(ValueError):
        table.slice(-1, 5)


def test_a_hot_value_is_in_each_page_once(spark):
    df = spark.range(900).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(-1)).alias("k"), "id")
    table = paged(df, ["k"], 6)
    found = [r.id for page in table.pages(100) for r in page.collect()]
    assert sorted(found) == list(range(900)) and len(list(table.pages(100))) == 9


def test_a_page_reads_its_partitions_only(rows):
    table = paged(rows[1], ["k", "id"], 8)
    page = table.slice(table.ends[3] + 1, 5)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "PartitionFilters: [isnotnull(__part" in plan.replace("PartitionFilters: [(", "PartitionFilters: [") or "__part#" in plan
    page.collect()
    scan = page.select(F.spark_partition_id()).distinct()
    assert scan.count() <= 2


def test_no_rows(spark):
    table = paged(spark.createDataFrame([], "k int"), ["k"])
    assert len(table) == 0 and table.page(0, 10).collect() == [] and list(table.pages(3)) == []
