"""Near-duplicate documents by min-max hashing.

Each permutation of the shingle hashes gives two signature values, its
minimum and its maximum, so a signature of 2K values costs K evaluations per
shingle. Bands of values select candidates; every link is confirmed on the
full shingle sets.

Documents with equal sets are one class first. Each class is compared with
the pivot of each of its buckets, so a group of thousands of near copies
costs a star and not all its pairs, and the confirmed links give components.
Two members of a star may still be linked across components. Stars with
members of several components are therefore compared in blocks, by what each
member has outside its pivot and lacks of it: that gives the exact common
size of any two. A task compares two blocks and returns a spanning forest of
the links, never the pairs, so no link between components is left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.llm.components import components, forest
from pagetrail.llm.shared import mix64, stored, table, text_slices

#: A pair of similarity 0.85 shares no band with probability 1e-9, one of 0.8 with 5e-7.
BANDS, ROWS = 28, 4
#: Members of a star's block.
BLOCK = 512
SPREAD = np.uint64(0x9E3779B97F4A7C15)


class Words(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def words_of(text: str | None) -> list[bytes]:
    """Words between white space (blank and \\x09-\\x0D) with A-Z in lower case."""
    return (text or "").encode().lower().split()


def shingles(words: list[bytes], n: int, hashes: Words) -> np.ndarray:
    """Distinct hashes of the ``n``-word shingles, sorted; fewer words are one shingle."""
    if not words:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = min(n, len(w))
    h = np.full(len(w) - n + 1, n, np.uint64)
    for i in range(n):
        h = mix64(h * SPREAD + w[i : len(w) - n + 1 + i])
    return np.unique(h)


class MinMax:
    """Band keys of a set: hashes of ``ROWS`` values each of its min-max signature."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)
        k = -(-bands * rows // 2)
        self.bands, self.rows = bands, rows
        self.times = rng.integers(0, 2**63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.plus = rng.integers(0, 2**63, k, dtype=np.uint64)

    def keys(self, sets: list[np.ndarray]) -> np.ndarray:
        """One row of band keys per set; sets must not be empty."""
        flat = np.concatenate(sets)
        starts = np.cumsum([0, *map(len, sets[:-1])])
        values = np.empty((len(sets), 2 * len(self.times)), np.uint64)
        for i, (a, b) in enumerate(zip(self.times, self.plus, strict=True)):
            p = flat * a + b
            p ^= p >> np.uint64(32)
            values[:, 2 * i] = np.minimum.reduceat(p, starts)
            values[:, 2 * i + 1] = np.maximum.reduceat(p, starts)
        keys = np.zeros((len(sets), self.bands), np.uint64)
        for band in range(self.bands):
            for j in range(self.rows):  # values of one permutation go to different bands
                keys[:, band] = mix64(keys[:, band] * SPREAD + values[:, band + j * self.bands])
            keys[:, band] = mix64(keys[:, band] + np.uint64(band))
        return keys


def signatures(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, n_shingles, set_key, bands) of every whole text.

    ``set_key`` is the digest of the full set, null for an empty one;
    ``text_key`` tells the texts of a repeated id apart.
    """
    schema = "doc_id long, text_key long, n_shingles long, set_key binary, bands array<long>"

    def run(batches):
        minmax, hashes = MinMax(), Words()
        for batch in batches:
            ids, keys, texts = batch.column(0), batch.column(1), [t or "" for t in batch.column(2).to_pylist()]
            for start, stop in text_slices(texts):
                sets = [shingles(words_of(t), words, hashes) for t in texts[start:stop]]
                full = [i for i, s in enumerate(sets) if len(s)]
                bands: list = [None] * len(sets)
                if full:
                    for i, row in zip(full, minmax.keys([sets[i] for i in full]).view(np.int64), strict=True):
                        bands[i] = row
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(start, stop - start),
                        keys.slice(start, stop - start),
                        pa.array(map(len, sets), pa.int64()),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                        pa.array(bands, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "text_key", "n_shingles", "set_key", "bands"],
                )

    return _keyed(docs, id_col, text_col).mapInArrow(run, schema)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_key"), F.col(text_col).alias("text"))


def _compared(pairs: DataFrame, texts: DataFrame, words: int, sets: bool = False) -> DataFrame:
    """(a, b, n_a, n_b, both) of pairs (a, b): sizes of the full sets and of what they share.

    With ``sets`` also ``added`` and ``missing``: what a has outside b, and
    lacks of it. Pairs come sorted by b within a task, so that the set of a
    pivot is made once for its run of pairs.
    """
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b")
    names = ["a", "b", "n_a", "n_b", "both", *["added", "missing"][: 2 * sets]]
    kinds = [pa.int64()] * 5 + [pa.list_(pa.int64())] * 2 * sets

    def run(batches):
        hashes, last, last_set = Words(), None, None
        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                a, b = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                if b != last:
                    last, last_set = b, shingles(words_of(batch.column(3)[i].as_py()), words, hashes)
                own = shingles(words_of(batch.column(2)[i].as_py()), words, hashes)
                both = np.intersect1d(own, last_set, assume_unique=True)
                row = (a, b, len(own), len(last_set), len(both))
                if sets:
                    row += tuple(np.setdiff1d(x, both, assume_unique=True).view(np.int64) for x in (own, last_set))
                out.append(row)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(map(list, zip(*out, strict=True)), kinds, strict=True)], names=names)

    return rows.mapInArrow(run, "a long, b long, n_a long, n_b long, both long" + ", added array<long>, missing array<long>" * sets)


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Common sizes of every two of sorted sets, one of each list."""
    flat = np.concatenate([*left, *right])
    owner = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in (*left, *right)])
    values, at, n = np.unique(flat, return_inverse=True, return_counts=True)
    column = np.full(len(values), -1)
    column[n > 1] = np.arange((n > 1).sum())
    owner, at = owner[column[at] >= 0], column[at][column[at] >= 0]
    total = np.zeros((len(left), len(right)), np.float32)
    for low in range(0, int((n > 1).sum()), 4096):
        here = (at >= low) & (at < low + 4096)
        has = np.zeros((len(left) + len(right), 4096), np.float32)
        has[owner[here], at[here] - low] = 1
        total += has[: len(left)] @ has[len(left) :].T
    return total.astype(np.int64)


def near_duplicates(docs: DataFrame, words: int, percent: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    Documents are linked if 100 * intersection >= percent * union of their
    ``words``-word shingle sets. Empty sets are linked with nothing. Repeated
    rows get equal results; rows of one id with different texts are linked
    only by their texts. A row with a null id is linked with nothing, has
    a null component and is not kept. Other columns are ignored.
    """
    signed = stored(signatures(docs, words, id_col, text_col), "signatures")
    usable = signed.where("doc_id IS NOT NULL AND set_key IS NOT NULL")
    classes = usable.groupBy("set_key").agg(
        F.min("doc_id").alias("rep"), F.min_by("text_key", "doc_id").alias("text_key"), F.first("bands").alias("bands")
    )
    # an id may stand for several classes, so each has a number of its own, which storing makes final
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    members = classes.select("node", "rep", "text_key", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.count("*").alias("size"), F.min_by("node", "rep").alias("pivot")).where("size > 1")
    shared = stored(shared.select("bucket", "pivot"), "buckets")
    members = stored(members.join(shared, "bucket").select("node", "rep", "text_key", "pivot"), "members")
    needed = members.select(F.col("rep").alias("doc_id"), "text_key", "node").distinct()
    # repeated ids may differ in text: the class's own text is that of one of its rows
    texts = _keyed(docs, id_col, text_col).join(needed, ["doc_id", "text_key"]).dropDuplicates(["doc_id", "text_key"])
    texts = stored(texts.select("node", "text"), "texts")

    pairs = members.where("node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    linked = F.col("both") * 100 >= percent * (F.col("n_a") + F.col("n_b") - F.col("both"))
    star = stored(_compared(pairs, texts, words).withColumn("linked", linked), "star")
    links = star.where("linked").select("a", "b")
    roots = components(links)
    more = stored(_across(star, roots, texts, words, percent), "across")
    if more.limit(1).count():
        roots = components(links.unionByName(more))
    of_class = classes.select("set_key", "rep", "node").join(roots, "node", "left")
    of_class = stored(of_class.select("set_key", "rep", F.coalesce("root", "node").alias("root")), "roots")
    names = stored(of_class.groupBy("root").agg(F.min("rep").alias("name")), "names")
    of_class = stored(of_class.join(names, "root").select("set_key", "name"), "named")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("name", "doc_id"))
    return signed.join(of_class, "set_key", "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"),
    )


def _across(star: DataFrame, roots: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) of members of one star that lie in different components: a spanning forest of each two blocks."""
    named = star.join(roots.select(F.col("node").alias("a"), "root"), "a", "left").select("a", "b", F.coalesce("root", "a").alias("root"))
    mixed = named.groupBy("b").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    mixed = stored(mixed.select("b", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "mixed")
    few = stored(named.join(mixed, "b"), "few")
    sets = _compared(few.select("a", "b"), texts, words, sets=True).join(few, ["a", "b"])
    held = sets.withColumn("block", F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int"))
    dealt = held.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))

    def run(block: pa.Table) -> pa.Table:
        own = block["block"].to_numpy()
        left = np.flatnonzero(own == block["low"][0].as_py())
        right = np.flatnonzero(own == block["high"][0].as_py())
        a, n, root = (block[c].to_numpy() for c in ("a", "n_a", "root"))
        pivot = block["n_b"][0].as_py()
        added, missing = ([np.array(x, np.int64) for x in block[c].to_pylist()] for c in ("added", "missing"))
        lacks = np.array([len(x) for x in missing])
        pick = lambda sets, at: [sets[i] for i in at]
        both = pivot - lacks[left][:, None] - lacks[right][None, :]
        both += _shared(pick(missing, left), pick(missing, right)) + _shared(pick(added, left), pick(added, right))
        link = 100 * both >= percent * (n[left][:, None] + n[right][None, :] - both)
        i, j = np.nonzero(link & (root[left][:, None] != root[right][None, :]))
        top = forest(len(a), left[i], right[j])
        got = np.flatnonzero(top != np.arange(len(a)))
        return pa.Table.from_arrays([pa.array(a[got], pa.int64()), pa.array(a[top[got]], pa.int64())], names=["a", "b"])

    columns = ["b", "low", "high", "block", "a", "n_a", "n_b", "root", "added", "missing"]
    found = dealt.select(F.col("b").alias("pivot"), *columns[1:]).groupBy("pivot", "low", "high").applyInArrow(run, "a long, b long")
    return found.distinct()


def op4_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


OP4_SQL = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS rn, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), sets AS (
  SELECT rn, doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i : ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2])) END AS s
  FROM w
), ex AS (SELECT rn, doc_id, len(s) AS n, unnest(s) AS g FROM sets),
rare AS (SELECT g FROM ex GROUP BY g HAVING count(*) > 1),
pairs AS (
  SELECT a.rn AS a, b.rn AS b, a.doc_id AS da, b.doc_id AS db
  FROM ex a JOIN rare USING (g) JOIN ex b USING (g)
  WHERE a.rn <> b.rn AND a.n * 100 >= b.n * 85 AND b.n * 100 >= a.n * 85
  GROUP BY ALL HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))
), reach AS (
  SELECT rn AS node, doc_id AS root FROM sets
  UNION
  SELECT p.b, r.root FROM reach r JOIN pairs p ON p.a = r.node
), c AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN c ON rn = node
"""
