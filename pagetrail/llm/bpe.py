"""Byte-level BPE encoding and decoding with a given rank file.

Encoding looks up in two tiers. A minimal perfect hash over the vocabulary
resolves pre-tokens that are tokens as they stand; the stored key confirms
the hit. Any other pre-token is merged from its bytes: linked bytes and a
heap of the adjacent pairs, lowest rank and then leftmost first.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagetrail.llm.shared import mix64, table, text_slices

RANKS = "byte_bpe_50k.tiktoken"
#: A vocabulary is held whole by each worker, so its entries are bounded.
MAX_TOKENS = 2_000_000
#: A worker remembers the ids of so many chunks of up to CACHED_CHARS each.
CACHE, CACHED_CHARS = 300_000, 48
STEP = np.uint64(0x9E3779B97F4A7C15)


class PerfectHash:
    """Minimal perfect hash by hash and displace.

    Keys fall into buckets by their hash; the largest buckets first, each
    takes the first displacement that puts its keys on free slots. The
    displacement of a bucket of one key names its slot, as -1 - slot.
    """

    def __init__(self, keys: list[bytes]) -> None:
        n = len(keys)
        self.slots, self.buckets = max(n, 1), max(n // 4, 1)
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, n)
        if len(np.unique(hashes)) < n:
            raise ValueError("two keys share a 64-bit hash")
        self.displace = np.zeros(self.buckets, np.int64)
        bucket = (hashes % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        starts = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        sizes = np.diff(starts)
        free, place = np.ones(self.slots, bool), np.full(n, -1, np.int64)
        for b in np.argsort(-sizes, kind="stable"):
            members = order[starts[b] : starts[b + 1]]
            if len(members) < 2:
                break
            first, block = 0, 16
            while True:
                tried = np.arange(first, first + block, dtype=np.uint64)
                at = np.sort(self._slot(hashes[members][None, :], tried[:, None]), axis=1)
                good = free[at].all(axis=1) & (at[:, 1:] != at[:, :-1]).all(axis=1)
                if good.any():
                    d = int(tried[good.argmax()])
                    break
                first, block = first + block, min(block * 4, 4096)
            self.displace[b] = d
            place[members] = self._slot(hashes[members], np.uint64(d))
            free[place[members]] = False
        single = np.flatnonzero(sizes == 1)
        left = np.flatnonzero(free)[: len(single)]
        self.displace[single] = -1 - left
        place[order[starts[single]]] = left
        self.place = place

    def _slot(self, hashes: np.ndarray, d) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (mix64(hashes + d * STEP) % np.uint64(self.slots)).astype(np.int64)

    def find(self, keys: list[bytes]) -> np.ndarray:
        """The one slot in which each key can be."""
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))
        d = self.displace[(hashes % np.uint64(self.buckets)).astype(np.int64)]
        return np.where(d < 0, -1 - d, self._slot(hashes, np.maximum(d, 0).astype(np.uint64)))


class Vocabulary:
    """Tokens and ranks of a rank file, with the perfect hash over them."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            pairs = [line.split() for line in file if line.strip()]
        if len(pairs) > MAX_TOKENS:
            raise ValueError(f"{len(pairs)} tokens; at most {MAX_TOKENS} are held by a worker")
        keys, ranks = [base64.b64decode(a) for a, _ in pairs], [int(b) for _, b in pairs]
        self.token = dict(zip(ranks, keys, strict=True))
        if missing := [b for b in range(256) if bytes([b]) not in set(keys)]:
            raise ValueError(f"bytes without a token: {missing}")
        self.hash = PerfectHash(keys)
        self.key_at: list[bytes] = [b""] * len(keys)
        self.rank_at = np.zeros(len(keys), np.int64)
        for key, rank, slot in zip(keys, ranks, self.hash.place, strict=True):
            self.key_at[slot], self.rank_at[slot] = key, rank
        del self.hash.place


#: Two white spaces in a row, or one at the start: such texts are matched whole.
UNEVEN = re.compile(r"^\s|\s\s")


class Codec:
    """Encodes and decodes in one worker.

    With ``public_tokenizers.PATTERN`` a single space between two other
    characters always begins a pre-token, and a single line feed is one. So
    a text without two white spaces in a row is cut there at once, and the
    pattern runs only over distinct chunks (a word and its punctuation).
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v, self.pattern = vocabulary, regex.compile(public_tokenizers.PATTERN)
        self.rank = {token: rank for rank, token in vocabulary.token.items()}  # of the pairs in a merge
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.line_feed = self.resolve(["\n"])[0]

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a piece that is no token: heap over linked bytes."""
        n, rank = len(piece), self.rank.get
        end = list(range(1, n + 1))  # of the part that starts at i; 0 once it is gone
        before = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            _, i, stop = pop(heap)
            j = end[i]
            if not j or j >= n or end[j] != stop:
                continue  # one of the two parts has grown or gone meanwhile
            end[j], end[i] = 0, stop
            if stop < n:
                before[stop] = i
                if (r := rank(piece[i : end[stop]])) is not None:
                    push(heap, (r, i, end[stop]))
            if (h := before[i]) >= 0 and (r := rank(piece[h:stop])) is not None:
                push(heap, (r, h, stop))
        out, i = [], 0
        while i < n:
            out.append(rank(piece[i : end[i]]))
            i = end[i]
        return out

    def resolve(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pre-tokens, as little-endian 32-bit integers."""
        raw = [p.encode() for p in pieces]
        slots = self.v.hash.find(raw)
        ids, keys = self.v.rank_at[slots].astype("<u4").tobytes(), self.v.key_at
        return [
            ids[4 * i : 4 * i + 4] if keys[s] == key else np.array(self.merge(key), "<u4").tobytes()
            for i, (key, s) in enumerate(zip(raw, slots.tolist(), strict=True))
        ]

    def learn(self, chunks: list[str]) -> None:
        """Remember the ids of chunks: as they stand after a line feed, else after a space."""
        split = [self.pattern.findall(c if c[:1] == "\n" else f" {c}") for c in chunks]
        pieces = list(set().union(*split))
        get = dict(zip(pieces, self.resolve(pieces), strict=True)).__getitem__
        self.known.update((c, b"".join(map(get, p))) for c, p in zip(chunks, split, strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. The last ``CACHE`` to 2 ``CACHE`` chunks are remembered."""
        found: list[bytes] = []
        for start, stop in text_slices(texts):
            if len(self.known) > CACHE:
                self.known, self.older = {}, self.known
            even = [None if UNEVEN.search(t) else f"\n{t}".replace("\n", " \n").split(" ")[1:] for t in texts[start:stop]]
            absent = set().union(*filter(None, even)) - self.known.keys()
            again = absent & self.older.keys()
            self.known.update((c, self.older[c]) for c in again)
            self.learn(new := list(absent - again))
            get = self.known.__getitem__
            for text, chunks in zip(texts[start:stop], even, strict=True):
                if chunks is None:
                    pieces = self.pattern.findall(text)
                    own = list(set(pieces))
                    found.append(b"".join(map(dict(zip(own, self.resolve(own), strict=True)).__getitem__, pieces)))
                else:  # without the line feed put before the text
                    found.append(b"".join(map(get, chunks))[len(self.line_feed) :])
            for long in (c for c in new if len(c) > CACHED_CHARS):
                del self.known[long]
        return found

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.v.token.__getitem__, ids.tolist()))


def _codec(shared) -> Codec:
    """One codec per worker process, as workers serve many tasks."""
    global _CACHED
    if _CACHED is None or _CACHED[0] != shared.value[0]:
        _CACHED = (shared.value[0], Codec(shared.value[1]))
    return _CACHED[1]


_CACHED: tuple[str, Codec] | None = None


def vocabulary(spark: SparkSession, path: str | None = None):
    """The vocabulary at ``path``, sent to the workers once (size-checked)."""
    path = path or public_tokenizers.path(RANKS)
    return spark.sparkContext.broadcast((path, Vocabulary(path)))


def encode(docs: DataFrame, vocab, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and ``ids`` (array of int) of every whole text.

    Null texts are empty texts: no ids. Rows stay as they are, repeated ones
    too; a failed task is simply run again.
    """
    schema = docs.select(*keep).schema.add("ids", T.ArrayType(T.IntegerType()))

    def run(batches):
        codec = _codec(vocab)
        for batch in batches:
            texts = [t or "" for t in batch.column(len(keep)).to_pylist()]
            for start, stop in text_slices(texts, 8 << 20):
                ids = codec.encode(texts[start:stop])
                ends = np.cumsum([0, *(len(x) // 4 for x in ids)]).astype(np.int32)
                flat = pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32))
                part = [batch.column(i).slice(start, stop - start) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*part, pa.ListArray.from_arrays(pa.array(ends), flat)], names=schema.names)

    return docs.select(*keep, text_col).mapInArrow(run, schema)


def decode(encoded: DataFrame, vocab, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns, n_tokens, ids_sha256 and the decoded ``bytes``."""
    schema = encoded.select(*keep).schema.add("n_tokens", "long").add("ids_sha256", "string").add("bytes", "binary")

    def run(batches):
        codec = _codec(vocab)
        for batch in batches:
            ids = batch.column(len(keep))
            flat, ends = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
            size = 256
            for at in range(0, batch.num_rows, size):
                each = [flat[ends[i] : ends[i + 1]] for i in range(at, min(at + size, batch.num_rows))]
                columns = [batch.column(i).slice(at, size) for i in range(len(keep))] + [
                    pa.array([len(x) for x in each], pa.int64()),
                    pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in each]),
                    pa.array([codec.decode(x) for x in each], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return encoded.select(*keep, "ids").mapInArrow(run, schema)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocab = vocabulary(spark)
    decoded = decode(encode(table(spark, sf_dir, "documents"), vocab), vocab)
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("bytes", 256).alias("decoded_sha256"))
