"""Quality scores by compression.

Two zstandard dictionaries are built from good and from bad labelled text. A
text is cut into pieces, each compressed with either dictionary; the
difference of the summed sizes, per byte of text, is what the good
dictionary saves more than the bad one. A logistic curve, fitted on other
labelled rows, turns it into the probability of label 1.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.llm.shared import excerpt, table

#: Labelled rows used of each label at most: those with the least hash of their id.
SAMPLE_ROWS = 1200
#: Every third sampled row calibrates, the others build the dictionaries.
CALIBRATE_EACH = 3
DICTIONARY_BYTES, RUN_BYTES = 192 << 10, 120
#: Of a sampled text at most so many code points are used, spread evenly over it.
SAMPLE_CHARS = 1 << 14
PIECE_BYTES, LEVEL = 1024, 9
THRESHOLD = 0.3


def pieces_of(text: str) -> list[bytes]:
    """The whole text in pieces, cut between code points or not: they are only measured."""
    raw = text.encode("utf-8", "replace")
    return [raw[i : i + PIECE_BYTES] for i in range(0, len(raw), PIECE_BYTES)]


def dictionary(texts: list[str]) -> bytes:
    """Dictionary content of ``DICTIONARY_BYTES`` at most: an equal share of every text, from pieces spread over its length.

    What short texts leave of their shares goes to the others.
    """
    raws = sorted((t.encode("utf-8", "replace") for t in texts if t), key=len)
    left, chosen = DICTIONARY_BYTES, []
    for i, raw in enumerate(raws):  # from the shortest on
        share = left // (len(raws) - i)
        chosen.append(spread(raw, share))
        left -= len(chosen[-1])
    return b"".join(chosen)


def spread(raw: bytes, share: int) -> bytes:
    """``share`` bytes of ``raw`` in runs of about ``RUN_BYTES``, spread evenly from its start to its end."""
    if len(raw) <= share:
        return raw
    runs = max(1, share // RUN_BYTES)
    size = share // runs
    starts = [round(k * (len(raw) - size) / max(1, runs - 1)) for k in range(runs)] if runs > 1 else [(len(raw) - size) // 2]
    return b"".join(raw[a : a + size] for a in starts)


class Scorer:
    """Compressors with the two dictionaries, and the calibration."""

    def __init__(self, good: bytes, bad: bytes, curve: tuple[float, float] = (1.0, 0.0)) -> None:
        self.good, self.bad, self.curve = good, bad, curve

    def __getstate__(self):
        return {"good": self.good, "bad": self.bad, "curve": self.curve}

    def _packers(self):
        if not hasattr(self, "packers"):
            made = []
            for content in (self.good, self.bad):
                if len(content) < 8:  # too short to be a dictionary
                    made.append(zstandard.ZstdCompressor(level=LEVEL, write_content_size=False))
                    continue
                held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                held.precompute_compress(level=LEVEL)
                made.append(zstandard.ZstdCompressor(dict_data=held, write_content_size=False))
            self.packers = made
        return self.packers

    def difference(self, text: str) -> float:
        """(size by bad - size by good) per byte of text; 0 for an empty text."""
        good, bad = self._packers()
        saved = size = 0
        for piece in pieces_of(text):
            saved += len(bad.compress(piece)) - len(good.compress(piece))
            size += len(piece)
        return saved / size if size else 0.0

    def score(self, text: str) -> float:
        w, c = self.curve
        return float(1 / (1 + np.exp(-np.clip(w * self.difference(text) + c, -30, 30))))


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and intercept by Newton's method, with a weak prior on the slope."""
    design = np.stack([x, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    prior = np.array([1e-3, 1e-6])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (p - y) + prior * w
        hessian = (design * (p * (1 - p))[:, None]).T @ design + np.diag(prior + 1e-9)
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -50, 50)
        if abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


def fit(good: list[str], bad: list[str]) -> Scorer:
    """Scorer of labelled texts; without texts of a label, its constant share."""
    train = lambda xs: [x for i, x in enumerate(xs) if i % CALIBRATE_EACH]
    scorer = Scorer(dictionary(train(good)), dictionary(train(bad)))
    rest = [(t, y) for xs, y in ((good, 1), (bad, 0)) for t in xs[::CALIBRATE_EACH]]
    if len({y for _, y in rest}) < 2:
        scorer.curve = (0.0, 30.0 if good else -30.0 if bad else 0.0)
        return scorer
    scorer.curve = logistic(np.array([scorer.difference(t) for t, _ in rest]), np.array([y for _, y in rest], float))
    return scorer


def sample(docs: DataFrame, labels: DataFrame) -> tuple[list[str], list[str]]:
    """Texts of a bounded sample of labelled rows: good, bad.

    Ids with both labels, null ids and null labels are left out. The ids are
    taken from the labels alone, so the join is with a bounded table, which
    goes to every worker. An id is one text (of several that with the least
    hash), of which ``SAMPLE_CHARS`` code points are used at most.
    """
    spark = docs.sparkSession
    clean = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("quality").alias("q2"))
    clean = clean.where("q = q2").select("doc_id", "q", F.xxhash64("doc_id").alias("h"))
    ids = [r for q in (0, 1) for r in clean.where(F.col("q") == q).orderBy("h", "doc_id").limit(SAMPLE_ROWS).collect()]
    if not ids:
        return [], []
    few = spark.createDataFrame([(r.doc_id, r.q, r.h) for r in ids], "doc_id long, q int, h long")
    text = excerpt(F.col("text"), SAMPLE_CHARS)
    found = docs.where("text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64("text").alias("t"))
    found = found.join(F.broadcast(few), "doc_id").groupBy("doc_id", "h", "q").agg(F.min_by("text", "t").alias("text"))
    rows = sorted((r.h, r.doc_id, r.text, r.q) for r in found.collect())
    return [r[2] for r in rows if r[3] == 1], [r[2] for r in rows if r[3] == 0]


def scored(docs: DataFrame, scorer: Scorer, keep: list[str], text_col: str = "text") -> DataFrame:
    """The ``keep`` columns and ``score`` of every whole text; null texts are empty."""
    shared = docs.sparkSession.sparkContext.broadcast(scorer)
    schema = docs.select(*keep).schema.add("score", "double")

    def run(batches):
        for batch in batches:
            got = [shared.value.score(t.as_py() or "") for t in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(got, pa.float64())], names=[*keep, "score"])

    return docs.select(*keep, F.col(text_col).alias("_text")).mapInArrow(run, schema)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and predicted label of every document, learned from labelled rows outside the held-out fifth."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    bucket = F.crc32(F.col("doc_id").cast("string")) % 5
    scorer = fit(*sample(docs, labels.where(bucket != 0)))
    return scored(docs, scorer, ["doc_id"]).select(
        "doc_id",
        F.coalesce(bucket == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
