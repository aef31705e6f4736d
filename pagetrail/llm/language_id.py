"""Language identification by nearest centroid.

A text is a vector of TF-IDF weights of its 1- to 3-character n-grams
(letters in lower case, anything else one blank), hashed into ``BUCKETS``.
Each language has several centroids, found by spherical k-means over a
bounded sample of labelled rows. The nearest centroid by cosine names the
language; a text too far from it for a text of its length is rejected.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.llm.shared import excerpt, mix64, sampled, table, text_slices

BUCKETS = 1 << 13
CENTROIDS = 3
#: The fit uses at most so many rows of each language, those with the least hash of their id.
SAMPLE_ROWS = 250
#: Of each it uses at most so many code points, spread evenly over the text.
SAMPLE_CHARS = 1 << 14
#: A table with more different languages has labels that name none.
MAX_LANGUAGES = 500
#: A text is rejected below this share of the least cosine that sample texts of its length have.
REJECT_SHARE = 0.6
UNKNOWN = "und"


def letters_of(text: str) -> np.ndarray:
    """Code points in lower case, each run of other characters one blank (0)."""
    low = text.lower()
    points = np.frombuffer(low.encode("utf-32-le", "replace"), np.uint32)
    ascii_ = (points >= 97) & (points <= 122)
    other = np.flatnonzero(points >= 128)
    if len(other):
        kinds, of = np.unique(points[other], return_inverse=True)
        ascii_[other] = np.array([chr(c).isalpha() for c in kinds.tolist()])[of]
    kept = np.where(ascii_, points, 0)
    kept = np.concatenate([[0], kept, [0]])
    keep = np.ones(len(kept), bool)
    keep[1:] = (kept[1:] != 0) | (kept[:-1] != 0)
    kept = kept[keep]
    return np.append(kept, 0).astype(np.uint64) if kept[-1] else kept.astype(np.uint64)


def counts_of(points: np.ndarray) -> np.ndarray:
    """Hashed n-gram counts of the code points of ``letters_of``."""
    total = np.zeros(BUCKETS, np.float32)
    code = np.zeros(len(points), np.uint64)
    for n in range(1, 4):
        if len(points) < n:
            break
        code = (code[: len(points) - n + 1] << np.uint64(21)) | points[n - 1 :]
        keys = mix64(code + np.uint64(n << 60)) & np.uint64(BUCKETS - 1)
        total += np.bincount(keys.astype(np.int64), minlength=BUCKETS)
    return total


def normalised(rows: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(size > 0, size, 1)


class Model:
    """Centroids of the languages, the n-gram weights and the least cosines."""

    def __init__(self, samples: list[tuple[str, str]], seed: int = 5) -> None:
        self.langs = sorted({lang for _, lang in samples})
        points = [letters_of(t) for t, _ in samples]
        useful = [i for i, p in enumerate(points) if p.any()]
        points, langs = [points[i] for i in useful], [samples[i][1] for i in useful]
        counts = np.stack([counts_of(p) for p in points]) if points else np.zeros((0, BUCKETS), np.float32)
        self.idf = (np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))) + 1).astype(np.float32)
        vectors = self.weigh(counts)
        centroids, self.of = [], []
        for k, lang in enumerate(self.langs):
            own = vectors[[i for i, x in enumerate(langs) if x == lang]]
            for c in self._clusters(own, seed):
                centroids.append(c)
                self.of.append(k)
        self.centroids = np.stack(centroids) if centroids else np.zeros((0, BUCKETS), np.float32)
        self._fit_limits(points)

    def weigh(self, counts: np.ndarray) -> np.ndarray:
        return normalised(np.log1p(counts) * self.idf)

    @staticmethod
    def _clusters(own: np.ndarray, seed: int) -> np.ndarray:
        """Spherical k-means; the first centres are rows spread over the sample."""
        if not len(own):
            return own
        centres = own[np.unique(np.linspace(0, len(own) - 1, min(CENTROIDS, len(own))).astype(int))]
        for _ in range(8):
            nearest = (own @ centres.T).argmax(axis=1)
            centres = normalised(np.stack([own[nearest == k].mean(axis=0) if (nearest == k).any() else c for k, c in enumerate(centres)]))
        return centres

    def _fit_limits(self, points: list[np.ndarray]) -> None:
        """Least cosine by the logarithm of the length, from two pieces of every sample text that is long enough."""
        self.limits = np.zeros(24)
        if not len(self.centroids):
            return
        for size in range(24):
            pieces = [p[i : i + (1 << size)] for p in points if len(p) >= 1 << size for i in (0, len(p) // 2) if len(p) - i >= 1 << size]
            if len(pieces) < 20:
                break
            best = [self._nearest(pieces[at : at + 64]).max(axis=1).min() for at in range(0, len(pieces), 64)]
            self.limits[size:] = REJECT_SHARE * min(best)

    def _nearest(self, points: list[np.ndarray]) -> np.ndarray:
        """Cosines of each text with each centroid."""
        return self.weigh(np.stack([counts_of(p) for p in points])) @ self.centroids.T

    def predict(self, texts: list[str]) -> list[tuple[str, float, bool]]:
        """(language, cosine, rejected); no letters: (und, 0, true)."""
        out: list[tuple[str, float, bool]] = []
        for at in range(0, len(texts), 64):
            points = [letters_of(t) for t in texts[at : at + 64]]
            if not len(self.centroids):
                out += [(UNKNOWN, 0.0, True)] * len(points)
                continue
            near = self._nearest(points)
            for p, row in zip(points, near, strict=True):
                k = int(row.argmax())
                if not p.any():
                    out.append((UNKNOWN, 0.0, True))
                else:
                    score = float(min(max(row[k], 0.0), 1.0))
                    out.append((self.langs[self.of[k]], score, score < self.limits[min(len(p).bit_length() - 1, 23)]))
        return out


def fit(labelled: DataFrame) -> Model:
    """Model of rows (text, lang, id); the bounded sample is ``SAMPLE_ROWS`` rows of each language.

    Rows without text or language are left out. The rows of a language are
    taken by the hash of their id, then of their text, so the sample is the
    same at each run; equal rows count once. Of a long text ``SAMPLE_CHARS``
    code points are used. More than ``MAX_LANGUAGES`` different languages are an error.
    """
    rows = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang", F.xxhash64("id").alias("h"))
    if rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"the labelled rows have more than {MAX_LANGUAGES} different languages")
    few = sampled(rows, "lang", SAMPLE_ROWS).groupBy("lang", "r").agg(F.min(excerpt(F.col("text"), SAMPLE_CHARS)).alias("text"))
    return Model([(r.text, r.lang) for r in few.orderBy("lang", "r").collect()])


def identify(docs: DataFrame, model: Model, keep: list[str], text_col: str = "text") -> DataFrame:
    """The ``keep`` columns with lang_pred, score and rejected for every whole text.

    Null texts and texts without letters get ``und``, 0 and rejected. The
    model (a few hundred KB) goes to the workers once.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["lang_pred", "score", "rejected"]
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(len(keep)).to_pylist()]
            got = []
            for start, stop in text_slices(texts):
                got += shared.value.predict(texts[start:stop])
            extra = [pa.array([g[i] for g in got], k) for i, k in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *extra], names=[*keep, *names])

    return docs.select(*keep, F.col(text_col).alias("_text")).mapInArrow(run, schema)


def accepted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows, as they are, whose text is not rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(at).to_pylist()]
            for start, stop in text_slices(texts):
                stays = [not rejected for _, _, rejected in shared.value.predict(texts[start:stop])]
                yield batch.slice(start, stop - start).filter(pa.array(stays, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def trainable(docs: DataFrame) -> DataFrame:
    """Labelled rows outside the held-out quarter."""
    bucket = F.crc32(F.col("doc_id").cast("string")) % 4
    return docs.where(bucket != 2).select("text", "lang", F.col("doc_id").alias("id"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, and whether it is too far from all languages (``rejected``)."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    return identify(docs, fit(trainable(docs)), ["doc_id"]).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")
