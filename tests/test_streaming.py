import datetime as dt
import os

from helpers import pv_rows, view

from pagetrail.plans import keyed_pageviews as K
from pagetrail.streaming import read_keyed, start_pageview_load


def test_stream_load_matches_batch_load_and_later_batch_wins(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    put_log = os.path.join(tmp_dir, "puts")
    ckpt = os.path.join(tmp_dir, "ckpt")
    first = [
        view(1, "2024-01-05 10:00:00", cookie="2024-01-05 10:00:00", ip=1),
        view(2, "2024-01-05 10:05:00", cookie="2024-01-05 10:00:00", ip=2),
        view(3, "2024-01-05 11:00:00", cookie="2024-01-05 11:00:00", ip=3),
    ]
    pv_rows(spark, first, with_id=False).write.parquet(os.path.join(src, "batch1"))
    q = start_pageview_load(spark, os.path.join(src, "*"), put_log, ckpt)
    q.awaitTermination()
    got = sorted(tuple(r) for r in read_keyed(spark, put_log).select("row_key", "guid", "ip").collect())
    want = sorted(tuple(r) for r in K.load_pageviews(pv_rows(spark, first, with_id=False)).select("row_key", "guid", "ip").collect())
    assert got == want and len(got) == 2

    # a later batch with an *older* view time still wins (later put)
    late = [view(9, "2024-01-05 10:01:00", cookie="2024-01-05 10:00:00", ip=9)]
    pv_rows(spark, late, with_id=False).write.parquet(os.path.join(src, "batch2"))
    q = start_pageview_load(spark, os.path.join(src, "*"), put_log, ckpt)
    q.awaitTermination()
    rows = {r.row_key: r.guid for r in read_keyed(spark, put_log).collect()}
    key = int(dt.datetime(2024, 1, 5, 10, tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert rows[key] == 9 and len(rows) == 2


def test_replayed_batch_leaves_the_table_unchanged(spark, tmp_dir):
    from pagetrail.plans.keyed_pageviews import pageview_puts
    from pyspark.sql import functions as F

    log = pv_rows(spark, [view(g, f"2024-01-05 10:0{g}:00", cookie="2024-01-05 10:00:00", ip=g) for g in range(1, 4)],
                  with_id=False)
    puts = pageview_puts(log).withColumn("ingest_batch", F.lit(0).cast("long"))
    put_log = os.path.join(tmp_dir, "puts")
    puts.write.mode("append").parquet(put_log)
    once = sorted(read_keyed(spark, put_log).collect())
    puts.write.mode("append").parquet(put_log)  # the same micro-batch again
    assert sorted(read_keyed(spark, put_log).collect()) == once and len(once) == 1
