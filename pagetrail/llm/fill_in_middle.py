"""Fill-in-the-middle transformation, assembled by a secondary sort.

Every document is cut into lines. Chunks of whole lines are emitted as pieces
keyed by document and place in the output; repartitioning and sorting within
partitions brings the pieces of a document together in the order of its
output, so a task streams them, piece after piece, into texts or incremental
digests. The exact text comes back from the output and its form alone: the
output is read as a stream, cut at its markers, keyed by place in the text and
sorted again, within the same partitions, so no piece is shuffled twice.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import groupby

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from pagetrail.llm.shared import ship, table

#: Fixed values of the transformation.
SALT = "7:"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
FIM_PERCENT, SPM_PERCENT = 100, 50
PLAIN, PSM, SPM = "plain", "psm", "spm"
ORDER = {PLAIN: (), PSM: (PREFIX, SUFFIX, MIDDLE), SPM: (SUFFIX, PREFIX, MIDDLE)}
#: Places of the parts in the text.
PLACE = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}

#: Code points of a piece. It ends with a line, unless the line is longer.
PIECE = 1 << 16
#: Bytes of a record batch, and what a row is taken to need besides its texts.
BATCH_BYTES, ROW_BYTES = 1 << 23, 128
ROWS_AT_ONCE = 256
#: Sorts before all pieces of a document: what is known of it besides.
HEAD = -1


# -------------------------------------------------------------- one document


def _offset(text: str, units: int) -> int:
    """Where the first ``units`` lines of the text end; the last needs no line feed."""
    at = 0
    for _ in range(units):
        at = text.find("\n", at) + 1
        if not at:
            return len(text)
    return at


def split(doc_id: int | None, text: str) -> tuple[int, str, int, int]:
    """(number of lines, form, end of the prefix, end of the middle). A null id has the digits of none."""
    n = text.count("\n") + (text != "" and not text.endswith("\n"))
    digest = hashlib.sha256(f"{SALT}{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in range(0, 32, 8))
    if not text or any(mark in text for mark in PLACE) or h3 % 100 >= FIM_PERCENT:
        return n, PLAIN, 0, 0
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    start = _offset(text, low)
    return n, SPM if h4 % 100 < SPM_PERCENT else PSM, start, start + _offset(text[start:], high - low)


def pieces_of(text: str, start: int, stop: int, size: int) -> Iterator[str]:
    """The text between two offsets in pieces of whole lines, of at most ``size`` code points; a longer line is cut."""
    while start < stop:
        end = min(start + size, stop)
        if end < stop:
            end = text.rfind("\n", start, end) + 1 or end
        yield text[start:end]
        start = end


def output_pieces(text: str, form: str, low: int, high: int, size: int) -> Iterator[tuple[int, int, bytes]]:
    """(slot, number, bytes) of the output's pieces, in the order of the text; slot and number order them in the output."""
    if form == PLAIN:
        ranges = {0: (0, len(text))}
    else:
        at = {PREFIX: (0, low), MIDDLE: (low, high), SUFFIX: (high, len(text))}
        slot = {mark: 2 * i for i, mark in enumerate(ORDER[form])}
        yield from ((s, 0, mark.encode()) for mark, s in slot.items())
        ranges = {slot[mark] + 1: at[mark] for mark in (PREFIX, MIDDLE, SUFFIX)}
    for s, (start, stop) in ranges.items():
        for i, piece in enumerate(pieces_of(text, start, stop, size)):
            yield s, i, piece.encode("utf-8", "surrogatepass")


def text_pieces(chunks: Iterator[bytes], form: str) -> Iterator[tuple[int, int, bytes]]:
    """(place, number, bytes) of the text's pieces, from an output's bytes and its form.

    The markers are looked for in the stream, across its chunks; an output
    that lacks one is no output of the form.
    """
    marks, place, number, rest = [m.encode() for m in ORDER[form]], 0 if form == PLAIN else None, 0, b""
    for chunk in chunks:
        rest += chunk
        while marks and (at := rest.find(marks[0])) >= 0:
            if at:
                if place is None:
                    break
                yield place, number, rest[:at]
            mark = marks.pop(0)
            place, number, rest = PLACE[mark.decode()], number + 1, rest[at + len(mark) :]
        done = len(rest) - (len(PREFIX) - 1 if marks else 0)  # a marker may have begun
        if done > 0:
            if place is None:
                raise ValueError(f"no output of the form {form}: it begins without its marker")
            yield place, number, rest[:done]
            number, rest = number + 1, rest[done:]
    if marks:
        raise ValueError(f"no output of the form {form}: a marker is missing")
    if rest:
        yield place, number, rest


# -------------------------------------------------------------- the documents


class Batches:
    """Rows in record batches of bounded size."""

    def __init__(self, schema: pa.Schema) -> None:
        self.schema = schema

    def of(self, rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        some, held = [], 0
        for row in rows:
            some.append(row)
            held += ROW_BYTES + sum(len(v) for v in row if isinstance(v, (str, bytes)))
            if held >= BATCH_BYTES:
                yield self._batch(some)
                some, held = [], 0
        if some:
            yield self._batch(some)

    def _batch(self, rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of record batches, one after another; some at a time are Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            some = batch.slice(at, ROWS_AT_ONCE)
            yield from zip(*(column.to_pylist() for column in some.columns), strict=True)


def _map(df: DataFrame, rows_of: Callable[[Iterator[tuple]], Iterator[tuple]], ddl: str) -> DataFrame:
    """``df`` with its rows streamed through ``rows_of`` in each task."""
    schema = df.sparkSession.createDataFrame([], ddl).schema
    batches = Batches(to_arrow_schema(schema))
    return df.mapInArrow(lambda found: batches.of(rows_of(_rows(found))), schema)


def _named_rows(rows: Iterator[tuple]) -> Iterator[tuple[str, tuple, str]]:
    """(name, row, text) of rows (id, text, ..., number of their task).

    A name is made of the id, the task and the row's number among those alike in the task.
    It does not depend on the order of the rows, so a task that runs again
    on the same rows in another order gives the same pieces, and rows alike
    have names of their own.
    """
    seen: Counter = Counter()
    for row in rows:
        text = row[1] or ""
        alike = (row[0], zlib.crc32(text.encode("utf-8", "surrogatepass")), len(text))
        seen[alike] += 1
        yield ":".join(map(str, (*alike, row[-1], seen[alike]))), row, text


def _secondary_sort(pieces: DataFrame) -> DataFrame:
    """Pieces brought together by document, and sorted by place in each task: RDDs' ``repartitionAndSortWithinPartitions``."""
    tasks = int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return _resorted(pieces.repartition(tasks, "name"))


def _resorted(pieces: DataFrame) -> DataFrame:
    """Pieces that lie together by document, sorted where they are."""
    return pieces.sortWithinPartitions("name", "place", "number")


def _documents(rows: Iterator[tuple]) -> Iterator[tuple[str, tuple, Iterator[bytes]]]:
    """(name, facts, chunks) of each document of sorted pieces (name, place, number, piece, *facts); the facts come first."""
    unpack = zstandard.ZstdDecompressor()
    for name, found in groupby(rows, lambda row: row[0]):
        yield name, next(found)[4:], (unpack.decompress(row[3]) for row in found)


def _id_type(df: DataFrame, id_col: str) -> str:
    return df.schema[id_col].dataType.simpleString()


FACTS = "n long, form string, prefix_chars long, middle_chars long"
PLACED = "name string, place int, number int, piece binary"


def _assembled(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The pieces of all outputs, sorted."""
    ship(docs.sparkSession)
    size = PIECE

    def emit(rows: Iterator[tuple]) -> Iterator[tuple]:
        pack = zstandard.ZstdCompressor(level=3)
        for name, row, text in _named_rows(rows):
            n, form, low, high = split(row[0], text)
            chars = (None, None) if form == PLAIN else (low, high - low)
            yield (name, HEAD, 0, None, row[0], n, form, *chars)
            for slot, number, piece in output_pieces(text, form, low, high, size):
                yield (name, slot, number, pack.compress(piece), None, None, None, None, None)

    read = docs.select(F.col(id_col), F.col(text_col), F.spark_partition_id())
    return _secondary_sort(_map(read, emit, f"{PLACED}, doc_id {_id_type(docs, id_col)}, {FACTS}"))


def transformed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row, the output as text.

    Null texts are empty, and empty ones plain; other columns are not read.
    Repeated rows come out as often as they come in.
    """

    def join(rows: Iterator[tuple]) -> Iterator[tuple]:
        for _, facts, chunks in _documents(rows):
            yield (*facts, b"".join(chunks).decode("utf-8", "surrogatepass"))

    return _map(_assembled(docs, id_col, text_col), join, f"doc_id {_id_type(docs, id_col)}, {FACTS}, output string")


def restored(outputs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, text) of rows (doc_id, output, form), from output and form alone."""
    ship(outputs.sparkSession)
    id_type, size = _id_type(outputs, id_col), PIECE

    def emit(rows: Iterator[tuple]) -> Iterator[tuple]:
        pack = zstandard.ZstdCompressor(level=3)
        for name, row, output in _named_rows(rows):
            yield name, HEAD, 0, None, row[0]
            chunks = (p.encode("utf-8", "surrogatepass") for p in pieces_of(output, 0, len(output), size))
            for place, number, piece in text_pieces(chunks, row[2]):
                yield name, place, number, pack.compress(piece), None

    def join(rows: Iterator[tuple]) -> Iterator[tuple]:
        for _, facts, chunks in _documents(rows):
            yield facts[0], b"".join(chunks).decode("utf-8", "surrogatepass")

    read = outputs.select(F.col(id_col), "output", "form", F.spark_partition_id())
    return _map(_secondary_sort(_map(read, emit, f"{PLACED}, doc_id {id_type}")), join, f"doc_id {id_type}, text string")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """As ``transformed``, but with the digests of the output and of the text rebuilt from it.

    No task holds an output or a rebuilt text whole; its pieces are sorted,
    on disk where they do not fit, and streamed.
    """
    id_type = _id_type(docs, id_col)

    def digest_and_cut(rows: Iterator[tuple]) -> Iterator[tuple]:
        pack = zstandard.ZstdCompressor(level=3)
        for name, facts, chunks in _documents(rows):
            digest = hashlib.sha256()
            for place, number, piece in text_pieces(_through(chunks, digest.update), facts[2]):
                yield (name, place, number, pack.compress(piece), *[None] * 6)
            yield (name, HEAD, 0, None, *facts, digest.hexdigest())

    def digest_text(rows: Iterator[tuple]) -> Iterator[tuple]:
        for _, facts, chunks in _documents(rows):
            digest = hashlib.sha256()
            for chunk in chunks:
                digest.update(chunk)
            yield (*facts, digest.hexdigest())

    known = f"doc_id {id_type}, {FACTS}, output_sha256 string"
    again = _resorted(_map(_assembled(docs, id_col, text_col), digest_and_cut, f"{PLACED}, {known}"))
    return _map(again, digest_text, f"{known}, restored_sha256 string")


def _through(chunks: Iterator[bytes], use: Callable[[bytes], None]) -> Iterator[bytes]:
    for chunk in chunks:
        use(chunk)
        yield chunk


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Form, sizes and digests of every document's output, and of the text rebuilt from it."""
    return digests(table(spark, sf_dir, "documents").withColumn("doc_id", F.col("doc_id").cast("long")))


OP13_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u,
    sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents
), h AS (
  SELECT *, len(u) AS n, list_transform([1, 9, 17, 25], lambda k: CAST('0x' || substr(x, k, 8) AS UBIGINT)) AS h FROM d
), f AS (
  SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 100 THEN 'plain'
      WHEN h[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h
), p AS (
  SELECT *, array_to_string(u[1:a], '') AS prefix, array_to_string(u[a + 1:b], '') AS middle, array_to_string(u[b + 1:n], '') AS suffix FROM f
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""
