"""Per-partition writes into a store of one's own, each row once.

``for_each_batch_of_rows`` hands batches to a function whose effects stand even if
the task fails and runs again. Here a task puts its batches into an
attempt of its own, and only the attempts that Spark has accepted are made
visible, by the driver, when all tasks are done. It is a Python data source,
so Spark's commit protocol decides between attempts.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import batched
from typing import Protocol

from pyspark.sql import DataFrame, Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage


class Puts(Protocol):
    """A store that can hold back what an attempt has put. Objects are sent to the executors."""

    def begin(self) -> object:
        """On an executor: a new attempt."""

    def put(self, attempt: object, rows: list[Row]) -> None:
        """On an executor: add a batch to the attempt."""

    def finish(self, attempt: object) -> str:
        """On an executor: close the attempt, and name it."""

    def commit(self, names: list[str]) -> None:
        """On the driver: make these attempts visible."""

    def abort(self, names: list[str]) -> None:
        """On the driver: undo finished attempts of a failed write."""


@dataclass
class _Finished(WriterCommitMessage):
    name: str


class _Writer(DataSourceWriter):
    def __init__(self, puts: Puts, batch_size: int) -> None:
        self.puts, self.batch_size = puts, batch_size

    def write(self, iterator: Iterator[Row]) -> _Finished:
        attempt = self.puts.begin()
        for rows in batched(iterator, self.batch_size):
            self.puts.put(attempt, list(rows))
        return _Finished(self.puts.finish(attempt))

    def commit(self, messages: list[_Finished | None]) -> None:
        self.puts.commit([m.name for m in messages if m])

    def abort(self, messages: list[_Finished | None]) -> None:
        self.puts.abort([m.name for m in messages if m])


def put_once(df: DataFrame, puts: Puts, batch_size: int = 100) -> None:
    """Write ``df`` by batches per partition; a task that runs again writes its rows once, and a failed job none."""
    name = f"puts_{uuid.uuid4().hex}"

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def writer(self, schema, overwrite):
            return _Writer(puts, batch_size)

    df.sparkSession.dataSource.register(Source)
    df.write.format(name).mode("append").save()


class JsonLines:
    """Puts as lines of JSON in files of a folder that driver and executors share as a mounted path.

    Attempts are hidden files (a leading dot); a commit renames those accepted.
    It may be cut short and repeated: a file is there under one name or the other.
    What failed attempts leave is hidden, and ``sweep`` removes it when no write is going on.
    """

    def __init__(self, path: str) -> None:
        self.path = path

    def begin(self):
        os.makedirs(self.path, exist_ok=True)
        return open(os.path.join(self.path, f".{uuid.uuid4().hex}.jsonl"), "w", encoding="utf-8")

    def put(self, attempt, rows: list[Row]) -> None:
        attempt.writelines(json.dumps(row.asDict(recursive=True), default=str, ensure_ascii=False) + "\n" for row in rows)

    def finish(self, attempt) -> str:
        attempt.flush()
        os.fsync(attempt.fileno())
        attempt.close()
        return os.path.basename(attempt.name)

    def commit(self, names: list[str]) -> None:
        for name in names:
            hidden = os.path.join(self.path, name)
            if os.path.exists(hidden):
                os.rename(hidden, os.path.join(self.path, name.removeprefix(".")))

    def abort(self, names: list[str]) -> None:
        for name in names:
            for left in (name, name.removeprefix(".")):
                if os.path.exists(os.path.join(self.path, left)):
                    os.remove(os.path.join(self.path, left))

    def sweep(self) -> None:
        self.abort([n for n in os.listdir(self.path) if n.startswith(".") and n.endswith(".jsonl")])
