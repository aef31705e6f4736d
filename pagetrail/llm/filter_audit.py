"""Filter interaction audit: what each of several filters removes, in every order.

A row that fails the filters of a mask is removed by the first of them in an
order. All orders with that removal at that step begin alike, so in
lexicographic order (by Lehmer code) their ranks are an interval. The counts
of a mask are added at the start of each of its intervals and taken off at
its end; a prefix sum over the ranks gives the removals of every order and
step without going through the orders row by row.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import permutations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pagetrail.llm.shared import ship, stored, table

#: The filters (fixed values): A few words, B repeated words, C capitals, D odd characters, E text of a smaller id.
FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 2
ODD_CHARACTERS = b"#$%&*|"

CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bytes of UTF-8 that begin no code point.
CONTINUATION = bytes(range(0x80, 0xC0))
#: Bytes of a text that are taken apart at a time.
WINDOW = 1 << 20
#: More filters would have more than 40,320 orders.
MAX_FILTERS = 8


# ------------------------------------------------------------ the documents


def words_of(data: memoryview, window: int) -> Iterator[list[bytes]]:
    """The words of a text between ASCII white space, window by window; a word across windows is joined."""
    begun: list[bytes] = []
    for at in range(0, len(data), window):
        part = bytes(data[at : at + window])
        found = part.split()
        if begun and part[:1].isspace():
            yield [b"".join(begun)]
            begun = []
        if not found:
            continue
        if len(found) == 1 and len(found[0]) == len(part):
            begun.append(part)
            continue
        found[0] = b"".join([*begun, found[0]])
        begun = [] if part[-1:].isspace() else [found.pop()]
        yield found
    if begun:
        yield [b"".join(begun)]


def failed(data: memoryview, window: int = WINDOW) -> int:
    """Mask of the filters A to D that a text fails."""
    words, distinct = 0, set()
    for found in words_of(data, window):
        words += len(found)
        distinct.update(found)
    points = capitals = odd = 0
    for at in range(0, len(data), window):
        part = bytes(data[at : at + window])
        points += len(part.translate(None, CONTINUATION))
        capitals += len(part) - len(part.translate(None, CAPITALS))
        odd += len(part) - len(part.translate(None, ODD_CHARACTERS))
    few, repeated = words < MIN_WORDS, 100 * len(distinct) < MIN_DISTINCT_PERCENT * words
    return few + 2 * repeated + 4 * (100 * capitals > MAX_CAPITAL_PERCENT * points) + 8 * (odd > 0)


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic) of every row of ``docs`` (doc_id, text, source).

    Bit k of the mask is set if the row fails filter k. Null texts are empty,
    a null source is the part ``''``. A row fails E if a row of a smaller id
    has its text (equal by SHA-256); a null id is neither smaller nor larger.
    A document is good or toxic if any row of ``labels`` for its id says so.
    A text is taken apart in windows; what is held of it besides are its
    distinct words.
    """
    ship(docs.sparkSession)
    named = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    window = WINDOW

    def facts_of(batches):
        for batch in batches:
            ids, parts, texts = batch.columns
            raw = [t.as_buffer() if t.is_valid else b"" for t in texts]
            found = pa.array([failed(memoryview(t), window) for t in raw], pa.int32())
            digests = pa.array([hashlib.sha256(t).digest() for t in raw], pa.binary())
            yield pa.RecordBatch.from_arrays([ids, parts, found, digests], names=["doc_id", "part", "mask", "digest"])

    facts = stored(named.mapInArrow(facts_of, f"doc_id {id_type}, part string, mask int, digest binary"), "audit-facts")
    ends = facts.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    firsts = stored(ends.where("first < last").select("digest", "first"), "audit-firsts")
    says = lambda c: F.coalesce(F.max(F.col(c) == 1), F.lit(False)).alias(c)
    labelled = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(says("quality"), says("toxic"))
    known = stored(labelled.where("quality OR toxic"), "audit-labels")
    later = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    joined = facts.join(firsts, "digest", "left").join(known, "doc_id", "left")
    flag = lambda c: F.coalesce(c, F.lit(False))
    return joined.select("part", F.when(later, F.col("mask") + 16).otherwise(F.col("mask")).alias("mask"), flag("quality").alias("good"), flag("toxic").alias("toxic"))


# ---------------------------------------------------------------- the audit


def lehmer_rank(prefix: tuple[int, ...], n: int) -> int:
    """Rank of the first permutation of 0 to n - 1 that begins with ``prefix``, in lexicographic order."""
    code = [sum(later < x for later in set(range(n)) - set(prefix[: i + 1])) for i, x in enumerate(prefix)]
    return sum(c * math.factorial(n - 1 - i) for i, c in enumerate(code))


def intervals(n: int) -> list[tuple[int, int, int, int]]:
    """(mask, step, start, stop): orders of ranks start to stop - 1 remove a row of the mask at the step.

    They begin with filters outside the mask and then, at the step, one of it.
    """
    found = []
    for step in range(1, n + 1):
        for prefix in permutations(range(n), step):
            free = sorted(set(range(n)) - set(prefix))
            start = lehmer_rank(prefix, n)
            for subset in range(1 << len(free)):
                mask = 1 << prefix[-1] | sum(1 << f for i, f in enumerate(free) if subset >> i & 1)
                found.append((mask, step, start, start + math.factorial(n - step)))
    return found


def interaction_audit(rows: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Counts of every part, order of the filters and step, zeros included.

    ``rows`` has part, mask (bit k: fails the k-th of ``filters``, one letter
    each, at most ``MAX_FILTERS``), good and toxic. They are counted by part
    and mask at first, so what follows grows with the number of parts alone.
    The intervals and the orders are fixed tables by rule (for five filters
    840 and 600 rows) and may be broadcast.
    """
    n, spark = len(filters), rows.sparkSession
    if not 1 <= n <= MAX_FILTERS or len(set(filters)) != n:
        raise ValueError(f"an audit needs 1 to {MAX_FILTERS} different filters")
    amounts = ["n", "good", "toxic"]
    counts = rows.groupBy("part", "mask").agg(
        F.count("*").alias("n"), F.sum(F.col("good").cast("long")).alias("good"), F.sum(F.col("toxic").cast("long")).alias("toxic")
    )
    counts = stored(counts, "audit-counts")
    fixed = spark.createDataFrame(intervals(n), "mask int, step int, start int, stop int")
    ends = F.explode(F.array(F.struct(F.col("start").alias("rank"), F.lit(1).alias("sign")), F.struct(F.col("stop").alias("rank"), F.lit(-1).alias("sign"))))
    steps = counts.join(F.broadcast(fixed), "mask").withColumn("end", ends)
    changes = steps.groupBy("part", "step", F.col("end.rank").alias("rank")).agg(*[F.sum(F.col("end.sign") * F.col(a)).alias(a) for a in amounts])

    orders = [
        (rank, "".join(filters[f] for f in order), step + 1, filters[order[step]])
        for rank, order in enumerate(permutations(range(n)))
        for step in range(n)
    ]
    of_order = spark.createDataFrame(orders, "rank int, filter_order string, step int, filter string")
    letter = F.explode(F.array(*[F.struct(F.lit(f).alias("filter"), F.lit(1 << k).alias("bit")) for k, f in enumerate(filters)]))
    by_filter = counts.withColumn("f", letter).groupBy("part", F.col("f.filter").alias("filter")).agg(
        F.sum("n").alias("total"),
        F.sum(F.when(F.col("mask").bitwiseAND(F.col("f.bit")) != 0, F.col("n")).otherwise(0)).alias("fails"),
        F.sum(F.when(F.col("mask") == F.col("f.bit"), F.col("n")).otherwise(0)).alias("unique_fails"),
    )  # every part with every filter, so with every order and step through the filter's places in the orders
    grid = by_filter.join(F.broadcast(of_order), "filter").join(changes, ["part", "step", "rank"], "left")
    along = Window.partitionBy("part", "step").orderBy("rank")
    summed = grid.withColumns({a: F.sum(F.coalesce(F.col(a), F.lit(0))).over(along) for a in amounts})
    before = Window.partitionBy("part", "rank").orderBy("step")
    return summed.withColumn("kept", F.col("total") - F.sum("n").over(before)).select(
        "part", "filter_order", "step", "kept", F.col("n").alias("removed"), (F.col("fails") - F.col("n")).alias("redundant"),
        "unique_fails", F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"),
        F.sum("n").over(Window.partitionBy("part", "filter")).alias("shapley"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of the five filters over all documents, by source."""
    return interaction_audit(masks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


OP12_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t-\\r]+'), lambda w: w <> '') AS w,
    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first FROM documents
), l AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), f AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, [
    len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t),
    regexp_matches(t, '[#$%&*|]'), coalesce(d.doc_id > first, false)] AS fails
  FROM d LEFT JOIN l ON l.doc_id = d.doc_id
), c AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY part, fails
), x AS (SELECT unnest([1, 2, 3, 4, 5]) AS i), o AS (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS p FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5
), r AS (
  SELECT c.*, p, list_position(list_transform(p, lambda k: fails[k]), true) AS gone FROM c, o
), s AS (
  SELECT part, p, step.i AS step, p[step.i] AS k,
    sum(CASE WHEN gone IS NULL OR gone > step.i THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN gone = step.i THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN fails[p[step.i]] AND gone < step.i THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails[p[step.i]] AND len(list_filter(fails, lambda z: z)) = 1 THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN gone = step.i THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN gone = step.i THEN toxic ELSE 0 END) AS toxic_lost
  FROM r, x step GROUP BY part, p, step.i
)
SELECT part, array_to_string(list_transform(p, lambda k: substr('ABCDE', k, 1)), '') AS filter_order, step,
  CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, k) AS BIGINT) AS shapley
FROM s
"""
