import datetime as dt
import os

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from pagetrail import sinks
from pagetrail.operators.keyed import range_scan
from pagetrail.plans import pageviews as P
from pagetrail.schemas import PAGEVIEW_COLUMNS
from pagetrail.sources import (
    partitions_for,
    read_jdbc_auto,
    read_header_csv,
    read_pageview_parquet,
    read_pageview_tsv,
    read_points_text,
    split_predicates,
)


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_tsv_to_parquet_round_trip_with_bad_fields(spark, tmp_dir):
    good = "\t".join([
        "2024-01-05 10:20:00", "2024-01-05 10:00:00", "1", "v1", "2", "o1", "123", "4", "x.com", "5", "6",
        "/p", "ref", "77", "none", "1", "1920x1080", "24", "1", "2",
    ])
    bad = good.replace("2024-01-05 10:20:00", "not-a-time", 1).replace("\t123\t", "\tabc\t", 1)
    src = os.path.join(tmp_dir, "log.tsv")
    _write(src, good + "\n" + bad + "\n")
    log = read_pageview_tsv(spark, src)
    out = os.path.join(tmp_dir, "pv.parquet")
    sinks.write_parquet(log, out)
    sinks.write_parquet(log, out)  # overwrite replaces
    back = read_pageview_parquet(spark, out)
    assert back.columns == PAGEVIEW_COLUMNS
    rows = sorted(back.collect(), key=lambda r: r.timeCreate is None)
    assert len(rows) == 2
    assert rows[0].guid == 77 and rows[0].ip == 123 and rows[0].timeCreate == dt.datetime(2024, 1, 5, 10, 20)
    assert rows[1].timeCreate is None and rows[1].ip is None and rows[1].guid == 77
    # the parsed log feeds the jobs directly (zoned timestamps)
    assert [r.concatenated for r in P.gap_export(back).collect()] == ["77\tx.com\t/p\t2024-01-05 10:20:00"]


def test_text_export_fails_on_existing_path(spark, tmp_dir):
    df = spark.createDataFrame([Row(concatenated="a\tb")])
    out = os.path.join(tmp_dir, "result.dat")
    sinks.write_text(df, out)
    assert spark.read.text(out).collect()[0].value == "a\tb"
    with pytest.raises(Exception):
        sinks.write_text(df, out)


def test_points_text_parse(spark, tmp_dir):
    src = os.path.join(tmp_dir, "points.txt")
    _write(src, "1.5,2\n3,x\n4\n")
    got = [tuple(r) for r in read_points_text(spark, src).collect()]
    assert got == [(1.5, 2.0), (3.0, None), (4.0, None)]


def test_header_csv(spark, tmp_dir):
    src = os.path.join(tmp_dir, "test.csv")
    _write(src, "col1,col2\na,b\n")
    df = read_header_csv(spark, src)
    assert df.columns == ["col1", "col2"] and df.count() == 1 and tuple(df.first()) == ("a", "b")


def test_keyed_table_written_sorted_and_range_read(spark, tmp_dir):
    df = spark.createDataFrame([(f"k{i:04d}", i) for i in range(1000)], "row_key string, v int")
    out = os.path.join(tmp_dir, "keyed")
    sinks.write_keyed_table(df, out, num_partitions=4)
    back = spark.read.parquet(out)
    got = range_scan(back, "k0100", "k0105")
    assert [r.v for r in got.orderBy("row_key").collect()] == [100, 101, 102, 103, 104]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(row_key,k0100)" in plan and "LessThan(row_key,k0105)" in plan


def test_for_each_batch_of_rows_sizes(spark, tmp_dir):
    df = spark.range(0, 250, numPartitions=1)
    marker = os.path.join(tmp_dir, "batches")
    os.makedirs(marker)

    def handle(batch, _dir=marker):
        with open(os.path.join(_dir, f"{batch[0].id}.txt"), "w") as f:
            f.write(str(len(batch)))

    sinks.for_each_batch_of_rows(df, handle, batch_size=100)
    sizes = sorted(int(open(os.path.join(marker, n)).read()) for n in os.listdir(marker))
    assert sizes == [50, 100, 100]


def test_jdbc_auto_takes_plain_names_only(spark):
    for table, column in [("titles; x", "emp_no"), ("(select 1) t", "emp_no"), ("titles", "emp_no) FROM x"), ("", "emp_no")]:
        with pytest.raises(ValueError):
            read_jdbc_auto(spark, "jdbc:none:", table, column)


def test_jdbc_partition_count():
    assert partitions_for(0) == 1 and partitions_for(50_000) == 1 and partitions_for(50_001) == 2
    assert partitions_for(120_000, 50_000) == 3


@pytest.mark.parametrize("hot", [0, 1, 600])
def test_split_predicates_deal_each_row_once_and_evenly(spark, hot):
    """A value with a third of the rows is split by the second column, and nulls are not lost."""
    rows = [(i % 89 - 40, i) for i in range(1200)] + [(7, i) for i in range(hot)] + [(None, 1), (None, None), (7, None), (3, None)]
    keys = spark.createDataFrame(rows, "k int, s long").repartition(3)
    found = split_predicates(keys, "k", "s", rows_per_partition=100)
    counts = keys.select(*[F.count_if(F.coalesce(F.expr(p), F.lit(False))).alias(str(i)) for i, p in enumerate(found)]).first()
    matches = keys.select(sum(F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in found).alias("n")).distinct().collect()
    assert [r.n for r in matches] == [1] and sum(counts) == len(rows)
    assert max(counts) <= 200 and any("k = 7 AND" in p for p in found) == (hot > 1)
    assert split_predicates(keys.limit(0), "k", "s") == ["k IS NULL", "k IS NOT NULL"]
    with pytest.raises(ValueError):
        split_predicates(keys, "k; DROP", "s")
