"""Exact de-duplication by deterministic block naming, with built-in functions only.

A text without its white space is cut into blocks of a fixed size. The
distinct blocks are sorted, and their places are their integer names; then
the distinct pairs of adjacent names are sorted and named in turn, and so on
until one name is left of each text. Two texts have the same name at the same
level if and only if they are the same, as every name stands for one content.

Text crosses one shuffle, pre-aggregated: the one that finds the distinct
blocks. All else are integers: a block is looked up by two 64-bit hashes of
it. They are only a look-up key: it is checked that no two distinct blocks
share it, and other seeds are taken if any do.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.llm.shared import stored

#: Bytes of a block.
BLOCK = 4096
#: White space that does not count (fixed values).
SPACES = " \t\n\x0b\f\r"
#: Pairs of seeds of the look-up key that are tried.
MAX_SEEDS = 8
#: Stands for the missing second name of a pair; names are not negative.
NO_NAME = -1


def normalised(text: Column) -> Column:
    """The text without white space; null is empty."""
    out = F.coalesce(text, F.lit(""))
    for space in SPACES:
        out = F.replace(out, F.lit(space), F.lit(""))
    return out


def blocks_of(text: Column) -> Column:
    """The UTF-8 bytes of a text in blocks of ``BLOCK`` bytes; an empty text is one empty block."""
    raw = text.cast("binary")
    last = F.floor(F.greatest(F.octet_length(raw) - 1, F.lit(0)) / BLOCK).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.substring(raw, i * BLOCK + 1, F.lit(BLOCK)))


def _key(block: Column, seed: int) -> Column:
    return F.struct(F.xxhash64(F.lit(2 * seed), block).alias("k1"), F.xxhash64(F.lit(2 * seed + 1), block).alias("k2"))


def _named(things: DataFrame, by: list[str]) -> DataFrame:
    """The distinct values of ``by`` with integer names: their places in sorted partitions.

    A partition holds the same values whenever it is made, so a task that
    runs again gives the same names.
    """
    return things.select(*by).distinct().sortWithinPartitions(*by).withColumn("name", F.monotonically_increasing_id())


def _block_names(texts: DataFrame) -> tuple[DataFrame, int]:
    """(k1, k2, name) of every distinct block of ``text``, and the seed whose keys tell them all apart."""
    blocks = texts.select(F.explode(blocks_of(F.col("text"))).alias("block"))
    for seed in range(MAX_SEEDS):
        names = stored(_named(blocks, ["block"]).select(_key(F.col("block"), seed).alias("key"), "name").select("key.*", "name"), "block-names")
        if names.groupBy("k1", "k2").count().where("count > 1").isEmpty():
            return names, seed
    raise RuntimeError(f"different blocks share their keys under each of {MAX_SEEDS} seeds")


def _identities(rows: DataFrame, names: DataFrame) -> DataFrame:
    """(row, level, name) of each of ``rows`` (row, keys of its blocks).

    A sequence of m names is done when m is 1; of the others the names at
    places 2 i and 2 i + 1 become the one at i. All tables are stored, so a
    content that a third of the rows share is a skewed join of plain
    shuffles, which adaptive execution splits.
    """
    longest = rows.agg(F.max(F.size("keys"))).first()[0] or 0
    placed = rows.select("row", F.size("keys").alias("m"), F.posexplode("keys").alias("place", "key")).select("row", "m", "place", "key.*")
    current = stored(placed.join(names, ["k1", "k2"]).select("row", "m", "place", "name"), "block-sequences")
    done, level = current.where("m = 1"), 0
    done = done.select("row", F.lit(level).alias("level"), "name")
    while longest > 1:
        side = lambda k: F.max(F.when(F.col("place") % 2 == k, F.col("name")))
        halves = current.where("m > 1").groupBy("row", "m", F.expr("CAST(place DIV 2 AS INT)").alias("half"))
        pairs = stored(halves.agg(side(0).alias("a"), F.coalesce(side(1), F.lit(NO_NAME)).alias("b")), "pairs")
        pair_names = stored(_named(pairs, ["a", "b"]), "pair-names")
        joined = pairs.join(pair_names, ["a", "b"])
        current = stored(joined.select("row", F.expr("CAST((m + 1) DIV 2 AS INT)").alias("m"), F.col("half").alias("place"), "name"), "sequences")
        longest, level = (longest + 1) // 2, level + 1
        done = done.unionByName(current.where("m = 1").select("row", F.lit(level).alias("level"), "name"))
    return done


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, level, name (and ``carried``).

    Texts are equal when they are the same but for white space; null is
    empty, and empty texts are equal to each other. ``level`` and ``name``
    together name the text. Of a group the row of most code points stays, then that of
    the smallest id (null last), then any one of rows alike in both: just one row
    of each group is ``kept``. The digest is that of the text without white
    space. ``carry`` names columns of ``docs`` to be returned in the struct
    ``carried``; no other columns are read, whatever their names.
    """
    text = F.col(text_col)
    facts = [F.col(id_col).alias("doc_id"), F.char_length(F.coalesce(text, F.lit(""))).alias("points"), normalised(text).alias("text")]
    extra = [F.struct(*[F.col(c) for c in carry]).alias("carried")] if carry else []
    read = docs.select(*facts, *extra)
    names, seed = _block_names(read)
    keys = F.transform(blocks_of(F.col("text")), lambda b: _key(b, seed))
    kept_columns = ["doc_id", "points", F.sha2("text", 256).alias("text_sha256"), keys.alias("keys"), *["carried"][: len(extra)]]
    rows = stored(read.select(F.monotonically_increasing_id().alias("row"), *kept_columns), "exact-rows")
    members = stored(rows.drop("keys").join(_identities(rows, names), "row"), "exact-members")
    first = F.min(F.struct(-F.col("points"), F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    groups = stored(members.groupBy("level", "name").agg(F.count("*").alias("group_size"), first), "exact-groups")
    decided = members.join(groups, ["level", "name"])
    return decided.select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("first.row")).alias("kept"),
        "text_sha256", "level", "name", *["carried"][: len(extra)],
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    return exact_duplicates(docs, id_col, text_col, carry=docs.columns).where("kept").select("carried.*")


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row that stays of its group of equal texts, by names of blocks and pairs."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return exact_duplicates(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP11_SQL = """
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[ \\t-\\r]', '', 'g') AS norm FROM documents
)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  row_number() OVER best = 1 AS kept, sha256(norm) AS text_sha256
FROM d WINDOW best AS (PARTITION BY norm ORDER BY points DESC, doc_id ASC NULLS LAST)
"""
