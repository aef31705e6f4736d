"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are partitioned by size: a class holds items of up to u shingles,
u a power of two. Documents are read in blocks of u shingles, and each two
neighbouring blocks are a window, so a passage of up to u shingles lies in
some window of twice its class, however long the document. A window that
shares a MinHash value with an item is a candidate; candidates are confirmed
by the exact containment of the item's shingle set in the document's. Items
of fewer than ``WHOLE`` shingles are looked up by one of them instead, which
misses none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.llm.minhash_dedup import SPREAD
from pagetrail.llm.shared import mix64, stored, table, text_slices

SHINGLE, CONTAINMENT = 5, 0.8
#: A window shares at least 0.19 of its shingles with an item that it holds to 0.8: all 64 values miss with probability 1e-6.
HASHES = 64
#: An item of fewer shingles is held to 0.8 only if all of them are (0.8 * 4 > 3), so any one of them finds it.
WHOLE = 5
#: Items are searched in blocks of so many characters, which bounds what is sent to the workers.
BLOCK_CHARS = 16 << 20
WORD = re.compile(r"[^\W_]+")


class Hashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def shingle_run(text: str | None, hashes: Hashes) -> np.ndarray:
    """Hashes of the 5-word shingles in order; words are runs of letters and digits in lower case."""
    words = WORD.findall((text or "").lower())
    if len(words) < SHINGLE:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    h = np.zeros(len(w) - SHINGLE + 1, np.uint64)
    for i in range(SHINGLE):
        h = mix64(h * SPREAD + w[i : len(w) - SHINGLE + 1 + i])
    return h


class Index:
    """MinHash values of the items of a block, by size class; one shingle each of the smallest."""

    def __init__(self, items: list[tuple[int, str]], seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        self.times = rng.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.plus = rng.integers(0, 2**63, HASHES, dtype=np.uint64)
        hashes = Hashes()
        self.items = [(i, s) for i, t in items if len(s := np.unique(shingle_run(t, hashes)))]
        #: u -> for each permutation (values in order, positions of their items, small table of low bits)
        self.classes: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
        sizes = np.array([1 << (len(s) - 1).bit_length() if len(s) >= WHOLE else 0 for _, s in self.items], int)
        own = np.flatnonzero(sizes == 0)
        values = np.array([self.items[i][1][0] for i in own], np.uint64)
        order = np.argsort(values)
        #: shingles in order, positions of their items
        self.small = values[order], own[order]
        for u in sorted(set(sizes[sizes > 0].tolist())):
            own = np.flatnonzero(sizes == u)
            self.classes[u] = []
            for k in range(HASHES):
                values = np.array([self.permuted(self.items[i][1], k).min() for i in own], np.uint64)
                order = np.argsort(values)
                seen = np.zeros(1 << 16, bool)
                seen[(values & np.uint64(0xFFFF)).astype(np.int64)] = True
                self.classes[u].append((values[order], own[order], seen))

    def permuted(self, h: np.ndarray, k: int) -> np.ndarray:
        p = h * self.times[k] + self.plus[k]
        return p ^ (p >> np.uint64(32))

    def candidates(self, runs: list[np.ndarray]) -> set[tuple[int, int]]:
        """(run, item) positions with a common MinHash value in some window, or the shingle of a small item. Runs must not be empty."""
        flat, found = np.concatenate(runs), set()
        values, owners = self.small
        if len(values):
            low, high = np.searchsorted(values, flat, "left"), np.searchsorted(values, flat, "right")
            hit, ends = np.flatnonzero(low < high), np.cumsum([len(r) for r in runs])
            for run, a, b in zip(np.searchsorted(ends, hit, "right"), low[hit], high[hit], strict=True):
                found.update((int(run), int(i)) for i in owners[a:b])
        levels, starts, lengths = [], np.cumsum([0, *map(len, runs)])[:-1], np.array([len(r) for r in runs])
        size = 1
        for u in self.classes:  # from small to large: the minima of larger blocks come from those of smaller ones
            step = u // size
            n = -(-lengths // step)
            of = np.repeat(np.arange(len(runs)), n)
            inner = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            levels.append((u, starts[of] + inner * step, of))
            starts, lengths, size = np.cumsum(n) - n, n, u
        for k in range(HASHES):
            least = self.permuted(flat, k)
            for u, cut, of in levels:
                least = np.minimum.reduceat(least, cut)
                window = least.copy()
                same = of[1:] == of[:-1]
                window[:-1][same] = np.minimum(least[:-1], least[1:])[same]
                values, owners, seen = self.classes[u][k]
                hit = np.flatnonzero(seen[(window & np.uint64(0xFFFF)).astype(np.int64)])
                if len(hit):
                    low, high = np.searchsorted(values, window[hit], "left"), np.searchsorted(values, window[hit], "right")
                    for h, a, b in zip(hit[low < high], low[low < high], high[low < high], strict=True):
                        found.update((int(of[h]), int(i)) for i in owners[a:b])
        return found

    def search(self, texts: list[str | None], hashes: Hashes) -> list[tuple[int, int, int, int]]:
        """(text, item id, shingles of the item, of them in the text) of confirmed pairs."""
        runs = [shingle_run(t, hashes) for t in texts]
        full = [i for i, r in enumerate(runs) if len(r)]
        if not full or not self.items:
            return []
        out, at, own = [], -1, None
        for i, item in sorted(self.candidates([runs[i] for i in full])):
            if i != at:
                at, own = i, np.unique(runs[full[i]])
            item_id, wanted = self.items[item]
            place = np.searchsorted(own, wanted)
            place[place == len(own)] = 0
            both = int((own[place] == wanted).sum())
            if both * 10 >= len(wanted) * 10 * CONTAINMENT:
                out.append((full[i], item_id, len(wanted), both))
        return out


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """Items in blocks of bounded size, one at a time on the driver."""
    block, size = [], 0
    for row in benchmark.where("text IS NOT NULL AND item_id IS NOT NULL").select("item_id", "text").distinct().toLocalIterator():
        block.append((row.item_id, row.text))
        size += len(row.text)
        if size >= BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared) for items of which a document holds 0.8 or more.

    Texts are searched whole. Items and texts of fewer than five words and
    null texts match nothing. Repeated rows give repeated pairs, rows with a
    null id too. An item id with several texts is several items. Other
    columns are ignored.
    """
    spark = docs.sparkSession
    schema = docs.select(F.col(id_col).alias("doc_id")).schema.add("item_id", "long").add("n_shingles", "long").add("n_shared", "long")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def scan(index) -> DataFrame:
        def run(batches):
            hashes = Hashes()
            for batch in batches:
                bodies = [t or "" for t in batch.column(1).to_pylist()]
                for start, stop in text_slices(bodies, 1 << 19):
                    got = index.value.search(bodies[start:stop], hashes)
                    if got:
                        ids = batch.column(0).take(pa.array([start + g[0] for g in got]))
                        rest = [pa.array([g[i] for g in got], pa.int64()) for i in (1, 2, 3)]
                        yield pa.RecordBatch.from_arrays([ids, *rest], names=schema.names)

        return texts.mapInArrow(run, schema)

    total: DataFrame | None = None
    for block in _blocks(benchmark):
        index = spark.sparkContext.broadcast(Index(block))
        part = scan(index)
        if total is not None or sum(len(t) for _, t in block) >= BLOCK_CHARS:
            part = stored(part, "contaminated")  # so that one block is with the workers at a time
            index.unpersist()
        total = part if total is None else total.unionByName(part)
    return total if total is not None else spark.createDataFrame([], schema)


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows, as they are, that hold no item to 0.8 or more.

    A benchmark of one block is searched as the rows pass by. With more, the
    digests of contaminated texts are found block by block and their rows
    dropped by a join, so that one block is with the workers at a time.
    """
    context, at = docs.sparkSession.sparkContext, docs.columns.index(text_col)

    def without(index):
        def run(batches):
            hashes = Hashes()
            for batch in batches:
                bodies = [t or "" for t in batch.column(at).to_pylist()]
                for start, stop in text_slices(bodies, 1 << 19):
                    hit = {g[0] for g in index.value.search(bodies[start:stop], hashes)}
                    yield batch.slice(start, stop - start).filter(pa.array([i not in hit for i in range(stop - start)], pa.bool_()))

        return run

    blocks = _blocks(benchmark)
    block = next(blocks, None)
    if block is None:
        return docs
    if next(blocks, None) is None:
        return docs.mapInArrow(without(context.broadcast(Index(block))), docs.schema)
    digest = F.sha2(docs[text_col], 256)
    found = contaminated(docs.select(digest.alias("digest"), docs[text_col].alias("text")), benchmark, "digest")
    found = stored(found.select(F.col("doc_id").alias("digest")).distinct(), "contaminated-texts")
    return docs.join(found, digest == found["digest"], "left_anti")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of a document and a benchmark item that it contains."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP8_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rn, doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
b AS (SELECT row_number() OVER () AS bn, item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w
  FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE text IS NOT NULL)),
ds AS (SELECT DISTINCT rn, doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i : array_to_string(w[i:i+4], ' '))) AS g FROM d WHERE len(w) >= 5),
bs AS (SELECT bn, item_id, g, count(*) OVER (PARTITION BY bn) AS n FROM (
  SELECT DISTINCT bn, item_id, unnest(list_transform(range(1, len(w) - 3), lambda i : array_to_string(w[i:i+4], ' '))) AS g FROM b WHERE len(w) >= 5))
SELECT doc_id, item_id, CAST(any_value(n) AS BIGINT) AS n_shingles, count(*) AS n_shared
FROM ds JOIN bs USING (g) GROUP BY rn, doc_id, bn, item_id HAVING count(*) * 10 >= any_value(n) * 8
"""
