"""Near-duplicate embeddings by randomised-rotation binary codes.

A unit vector, rotated at random, is coded by the signs of its components.
Its correction factor f is the inner product of the vector and its code; the
code's inner product with another unit vector, divided by f, estimates the
cosine without bias, and can be off by sqrt(1/f^2 - 1) * sqrt(1 - cos^2) at
most. Pairs whose estimate lies below the threshold by more than that cannot
link; all others are computed anew in double precision. What is shuffled to find
them are the codes and the rotated vectors in 8-bit steps, whose loss is
known and added to the bound; the vectors themselves are fetched only for rows that are in
an open pair.

Pairs are met in tables of random-hyperplane buckets. The number of bits
grows with the largest label, so that buckets stay of one size, and the
number of tables follows from the bits, so that a pair at the threshold is
missed with the same small probability at any scale. With few rows there
are no bits and the search is exhaustive within a label. Buckets are cut into
blocks, and a task compares two blocks, so no bucket is in one task as a
whole. Equal vectors are one class before all this.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.llm.components import components, forest
from pagetrail.llm.shared import stored, table

COSINE = 0.98
#: A pair at the threshold is in no common bucket with this probability at most.
MISS = 1e-6
#: Rows of a bucket that are aimed at, and of a block.
BLOCK = 512
MAX_BITS = 24


def tables_for(largest: int, cosine: float = COSINE) -> tuple[int, int]:
    """(bits of a bucket key, number of tables) for the largest label."""
    bits = min(MAX_BITS, max(0, math.ceil(math.log2(max(largest, 1) / BLOCK))))
    agree = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, 1 if bits == 0 else math.ceil(math.log(MISS) / math.log1p(-agree))


def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def unit(vector) -> np.ndarray | None:
    """The vector at length 1 in double precision; None if it can't be compared."""
    if vector is None or not len(vector) or any(x is None for x in vector):
        return None
    v = np.asarray(vector, np.float64)
    size = np.linalg.norm(v)
    return v / size if np.isfinite(v).all() and np.isfinite(size) and size > 0 else None


def arrays_of(vectors: pa.Array) -> list[np.ndarray | None]:
    """The vectors of a list column; None for null ones and those with null components."""
    flat = vectors.values.to_numpy(zero_copy_only=False)  # null components are NaN, and told apart below
    bad = np.flatnonzero(vectors.values.is_null().to_numpy(zero_copy_only=False)) if vectors.values.null_count else np.empty(0, int)
    ends = vectors.offsets.to_numpy()
    hurt = np.searchsorted(bad, ends[:-1]) < np.searchsorted(bad, ends[1:])
    known = vectors.is_valid().to_numpy(zero_copy_only=False) & ~hurt
    return [flat[a:b] if ok else None for a, b, ok in zip(ends[:-1], ends[1:], known, strict=True)]


def keyed(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec_id, class_key): digest of label and vector; null for rows that link with nothing."""

    def run(batches):
        for batch in batches:
            keys = []
            for vec_id, vector, label in zip(batch.column(0).to_pylist(), arrays_of(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                usable = vec_id is not None and label is not None and vector is not None and unit(vector) is not None
                raw = repr(label).encode() + b"\0" + (np.asarray(vector, np.float64) + 0.0).tobytes() if usable else b""
                keys.append(hashlib.blake2b(raw, digest_size=16).digest() if usable else None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], names=["vec_id", "vector", "label", "class_key"])

    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(label_col).alias("label"))
    schema = rows.select("*").schema.add("class_key", "binary")  # a copy, as add() changes it
    return rows.mapInArrow(run, schema)


CODED = "rep long, n long, label string, dim int, unit binary, keys array<long>, packed binary, code binary, factor double, rough binary, scale double, lost double"


def coded(classes: DataFrame, bits: int, tables: int) -> DataFrame:
    """The codes of (rep, n, label, vector).

    ``unit`` is the vector at length 1 (doubles), ``keys`` its buckets in all tables and
    ``packed`` the same as 32-bit integers; ``code`` and ``factor`` are the signs of the rotated vector and
    its inner product with them; ``rough`` is the rotated vector itself in 8-bit
    steps of ``scale``, which leave out a rest of length ``lost``.
    """
    names = [c.split()[0] for c in CODED.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.float64(), pa.binary(), pa.float64(), pa.float64()]

    def run(batches):
        planes: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            found = arrays_of(batch.column(3))
            dims = np.array([len(v) for v in found], int)
            for dim in np.unique(dims):
                own = np.flatnonzero(dims == dim)
                u = np.stack([found[i] for i in own]).astype(np.float64)
                u /= np.linalg.norm(u, axis=1, keepdims=True)
                if dim not in planes:
                    planes[dim] = rotation(dim), np.random.default_rng(dim + 1).standard_normal((dim, max(bits, 1) * tables))
                turn, cut = planes[dim]
                side = (u @ cut > 0).reshape(len(u), tables, -1) if bits else np.zeros((len(u), tables, 1), bool)
                keys = side @ (1 << np.arange(side.shape[2], dtype=np.int64))
                turned = u @ turn
                signs = turned > 0
                factor = np.abs(turned).sum(axis=1) / math.sqrt(dim)
                scale = np.abs(turned).max(axis=1) / 127
                rough = np.rint(turned / scale[:, None]).astype(np.int8)
                lost = np.linalg.norm(turned - rough * scale[:, None], axis=1)
                raw = lambda rows: [r.tobytes() for r in rows]
                picked = batch.take(pa.array(own))
                columns = [
                    picked.column(0), picked.column(1), picked.column(2), np.full(len(u), dim, np.int32), raw(u), keys.tolist(), raw(keys.astype(np.uint32)),
                    raw(np.packbits(signs, axis=1)), factor, raw(rough), scale, lost,
                ]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return classes.mapInArrow(run, CODED)


def _stacked(column: pa.ChunkedArray, kind) -> np.ndarray:
    """Binary values of one length as the rows of a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _sides(block: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the two blocks; the same twice for a block with itself. Empty where the other block has no rows."""
    own, low, high = block["block"].to_numpy(), block["low"][0].as_py(), block["high"][0].as_py()
    left = np.flatnonzero(own == low)
    return left, left if low == high else np.flatnonzero(own == high)


def _met_first(packed: np.ndarray, i: np.ndarray, j: np.ndarray, table_no: int) -> np.ndarray:
    """Whether the pairs' first common bucket is in this table."""
    step = 1 << 16
    return np.concatenate([(packed[i[k : k + step]] == packed[j[k : k + step]]).argmax(axis=1) == table_no for k in range(0, len(i), step)] or [np.empty(0, bool)])


def _each_once(left: np.ndarray, right: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    i, j = left[a], right[b]
    return (i[a < b], j[a < b]) if right is left else (i, j)


def open_pairs(block: pa.Table, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs (i, j) of a pair of blocks, met in no earlier table, that may link for all that their codes say.

    The code of i estimates the cosine from the rough vector of j. The estimate is off
    by the code's own bound, and by what is lost in the rough vector, at most.
    """
    left, right = _sides(block)
    if not len(left) or not len(right):
        return np.empty(0, int), np.empty(0, int)
    rough = _stacked(block["rough"], np.int8)
    dim = rough.shape[1]
    signs = np.unpackbits(_stacked(block["code"], np.uint8), axis=1, count=dim).astype(np.float32) * 2 - 1
    factor = np.maximum(block["factor"].to_numpy(), 1e-6)[left]
    scale, lost = block["scale"].to_numpy()[right], block["lost"].to_numpy()[right]
    # whole numbers below 2^24 at up to 2^17 components, so float sums are exact
    estimate = (signs[left] @ rough[right].astype(np.float32).T) * scale / math.sqrt(dim) / factor[:, None]
    off = np.sqrt(np.maximum(0, 1 / factor**2 - 1) * (1 - cosine**2))
    a, b = np.nonzero(estimate >= cosine - off[:, None] - lost / factor[:, None] - 1e-6)
    i, j = _each_once(left, right, a, b)
    first = _met_first(_stacked(block["packed"], np.uint32), i, j, block["table"][0].as_py())
    return i[first], j[first]


def linked_in(block: pa.Table, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Row pairs (i, j) of a pair of blocks, met in no earlier table, whose cosine in double precision reaches the threshold."""
    left, right = _sides(block)
    if not len(left) or not len(right):
        return np.empty(0, int), np.empty(0, int)
    x = _stacked(block["unit"], np.float64)
    i, j = _each_once(left, right, *np.nonzero(x[left] @ x[right].T >= cosine - 1e-9))
    exact = np.concatenate([np.einsum("nd,nd->n", x[i[k : k + 65536]], x[j[k : k + 65536]]) for k in range(0, len(i), 65536)] or [np.empty(0)])
    i, j = i[exact >= cosine], j[exact >= cosine]
    first = _met_first(_stacked(block["packed"], np.uint32), i, j, block["table"][0].as_py())
    return i[first], j[first]


def compare_blocks(codes: DataFrame, cosine: float) -> DataFrame:
    """(rep, n_links, root) sums and edges of each pair of blocks with a link.

    Codes are dealt to the pairs of blocks first, not vectors. A pair of blocks
    gives the rows that are in a pair which the codes leave open; only those
    rows' vectors are fetched, and compared exactly. A task gives one row per
    vector, whatever the number of its links: how many rows its partners
    stand for, and the least vector it is connected with there.
    """
    members = codes.select("rep", "label", "dim", "packed", "code", "factor", "rough", "scale", "lost", F.posexplode("keys").alias("table", "bucket"))
    place = ["label", "dim", "table", "bucket"]
    sizes = members.groupBy(place).agg(F.count("*").alias("size")).where("size > 1")
    numbered = sizes.select(*place, F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"), F.monotonically_increasing_id().alias("place"))
    held = members.join(stored(numbered, "buckets"), place).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pair = [F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")]
    dealt = held.select("*", others).select("place", *pair, "table", "block", "rep", "packed", "code", "factor", "rough", "scale", "lost")

    def survey(block: pa.Table) -> pa.Table:
        i, j = open_pairs(block, cosine)
        return block.select(["place", "low", "high", "table", "block", "rep"]).take(pa.array(np.union1d(i, j)))

    rows = "place long, low int, high int, table int, block int, rep long"
    named = stored(dealt.groupBy("place", "low", "high").applyInArrow(survey, rows), "open")

    def run(block: pa.Table) -> pa.Table:
        names, kinds = ["rep", "n_links", "root"], [pa.int64()] * 3
        i, j = linked_in(block, cosine)
        rep, n = block["rep"].to_numpy(), block["n"].to_numpy()
        links = np.zeros(len(rep), np.int64)
        np.add.at(links, i, n[j])
        np.add.at(links, j, n[i])
        got = np.flatnonzero(links)
        root = rep[forest(len(rep), i, j)]
        return pa.Table.from_arrays([pa.array(c[got], k) for c, k in zip((rep, links, root), kinds, strict=True)], names=names)

    fetched = named.join(codes.select("rep", "n", "unit", "packed"), "rep")
    wanted = ["place", "low", "high", "table", "block", "rep", "n", "unit", "packed"]
    return fetched.select(wanted).groupBy("place", "low", "high").applyInArrow(run, "rep long, n_links long, root long")


def near_duplicates(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Rows link if their labels are equal and not null, their vectors have one
    length and cosine at least ``cosine``. Null, empty and zero vectors, and
    those with null or non-finite components, link with nothing, and rows
    with a null id neither (their component is null, and they are not kept).
    Repeated rows are rows of their own, which link. Other columns are ignored.
    """
    rows = stored(keyed(vectors, id_col, vector_col, label_col), "vectors")
    classes = rows.where("class_key IS NOT NULL").groupBy("class_key").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("label").cast("string").alias("label"), F.first("vector").alias("vector")
    )
    classes = stored(classes, "classes")
    largest = classes.groupBy("label", F.size("vector")).count().agg(F.max("count")).first()[0] or 0
    codes = stored(coded(classes.select("rep", "n", "label", "vector"), *tables_for(largest, cosine)), "codes")
    met = stored(compare_blocks(codes, cosine), "met")
    roots = components(met.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    counted = met.groupBy("rep").agg(F.sum("n_links").alias("links"))
    of_class = classes.select("class_key", "rep", "n").join(counted, "rep", "left").join(roots, F.col("rep") == F.col("node"), "left")
    of_class = stored(
        of_class.select("class_key", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("root", "rep").alias("root")), "of-class"
    )
    component = F.coalesce("root", "vec_id")
    return rows.select("vec_id", "class_key").join(of_class, "class_key", "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, components and kept vectors of the whole table, within labels."""
    return near_duplicates(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")


OP7_SQL = """
WITH RECURSIVE e AS (
  SELECT row_number() OVER () AS rn, vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), ok AS (
  SELECT * FROM e WHERE vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL AND len(v) > 0
    AND len(list_filter(v, lambda x : x IS NULL OR NOT isfinite(x))) = 0 AND list_sum(list_transform(v, lambda x : x * x)) > 0
), pairs AS (
  SELECT a.rn AS a, b.rn AS b, a.vec_id AS da, b.vec_id AS db FROM ok a JOIN ok b ON a.label = b.label AND len(a.v) = len(b.v) AND a.rn <> b.rn
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reach AS (
  SELECT rn AS node, vec_id AS root FROM e
  UNION
  SELECT p.b, r.root FROM reach r JOIN pairs p ON p.a = r.node
), c AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node),
n AS (SELECT a AS node, count(*) AS k FROM pairs GROUP BY a)
SELECT vec_id, coalesce(k, 0) AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM e JOIN c ON c.node = rn LEFT JOIN n ON n.node = rn
"""
