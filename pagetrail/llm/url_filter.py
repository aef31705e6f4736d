"""URL filters over a sorted digest array.

Every rule is one string, host + path. The 64-bit xxhash of all rule strings,
sorted, is a file that each worker maps into memory, so workers of a machine
share its pages. A url's candidates are each host suffix joined with each
path prefix of a length that some rule has; all candidates of a batch are
probed by one binary search, and a hit counts only if the stored string is
the same.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import weakref
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.llm.shared import table

#: (verdict, host, path) of the registered query (fixed values).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Rules are kept by the driver while it writes the array, so their number is bounded.
MAX_RULES = 5_000_000


def write_index(rules: Iterable[tuple[str, str, str]], folder: str) -> str:
    """Write the sorted digests and, in the same order, the rules; returns the path.

    The file holds: number of rules, digests, offsets, then the strings
    ``verdict\\thost\\tpath``. Of rules with the same host and path the one
    that blocks wins.
    """
    best: dict[tuple[str, str], str] = {}
    for verdict, host, path in rules:
        if verdict not in ("allow", "block") or not host or not path.startswith("/"):
            raise ValueError(f"not a rule: {(verdict, host, path)}")
        key = (host.lower(), path)
        best[key] = "block" if "block" in (verdict, best.get(key)) else "allow"
    if len(best) > MAX_RULES:
        raise ValueError(f"{len(best)} rules; at most {MAX_RULES} fit one index")
    entries = sorted((xxhash.xxh64_intdigest(h + p), v, h, p) for (h, p), v in best.items())
    texts = [f"{v}\t{h}\t{p}".encode() for _, v, h, p in entries]
    offsets = np.cumsum([0, *map(len, texts)]).astype(np.uint64)
    content = b"".join([
        np.uint64(len(entries)).tobytes(), np.array([e[0] for e in entries], np.uint64).tobytes(), offsets.tobytes(), *texts
    ])
    path = os.path.join(folder, f"url-rules-{hashlib.sha256(content).hexdigest()[:24]}.bin")
    with open(path, "wb") as file:
        file.write(content)
    return path


class Index:
    """The mapped index file."""

    def __init__(self, path: str) -> None:
        self.bytes = np.memmap(path, np.uint8, "r")
        n = int(self.bytes[:8].view(np.uint64)[0])
        self.digests = self.bytes[8 : 8 + 8 * n].view(np.uint64)
        self.offsets = self.bytes[8 + 8 * n : 16 + 16 * n].view(np.uint64)
        self.texts = self.bytes[16 + 16 * n :]
        #: Path lengths that rules have: a bounded list, as rules are.
        self.lengths = sorted({len(self.rule(i)[2]) for i in range(n)})

    def rule(self, i: int) -> tuple[str, str, str]:
        return tuple(self.texts[int(self.offsets[i]) : int(self.offsets[i + 1])].tobytes().decode().split("\t", 2))

    def judge(self, hosts: list[str], paths: list[str]) -> list[tuple[str | None, str | None]]:
        """(rule, verdict) of the longest rule that fits each url, or nulls.

        Longest: host and path together; then the longer host.
        """
        made: list[str] = []
        of: list[int] = []
        sizes: list[int] = []
        for i, (host, path) in enumerate(zip(hosts, paths, strict=True)):
            prefixes = [path[:n] for n in self.lengths if n <= len(path)]
            suffix = host
            while suffix and prefixes:
                for p in prefixes:
                    made.append(suffix + p)
                    of.append(i)
                    sizes.append(len(suffix))
                _, _, suffix = suffix.partition(".")
        found: list[tuple[int, int, str | None, str | None]] = [(-1, -1, None, None)] * len(hosts)
        if made and len(self.digests):
            keys = np.fromiter(map(xxhash.xxh64_intdigest, made), np.uint64, len(made))
            at = np.searchsorted(self.digests, keys)
            at[at == len(self.digests)] = 0
            for k in np.flatnonzero(self.digests[at] == keys):
                slot = int(at[k])
                while slot < len(self.digests) and self.digests[slot] == keys[k]:
                    verdict, host, path = self.rule(slot)
                    if host + path == made[k] and len(host) == sizes[k]:  # else a collision, or the host ends elsewhere
                        found[of[k]] = max(found[of[k]], (len(made[k]), len(host), host + path, verdict), key=lambda x: x[:2])
                    slot += 1
        return [x[2:] for x in found]


_SENT: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def split_url(url_col: str):
    """(host, path) columns: by the first ``://``; both empty without one."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    after = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(after, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def filter_urls(pages: DataFrame, id_col: str, url_col: str, rules: Iterable[tuple[str, str, str]], default: str = "allow") -> DataFrame:
    """(id, host, path, rule, verdict) of every row; ``default`` where no rule fits.

    Null urls and urls without ``://`` have empty host and path and fit no
    rule. Repeated rows are judged alike; other columns are ignored.
    """
    spark = pages.sparkSession
    path = write_index(rules, tempfile.mkdtemp(prefix="pagetrail-rules-"))
    name = os.path.basename(path)  # follows from the rules, so equal rules are sent once
    sent = _SENT.setdefault(spark.sparkContext, set())
    if name not in sent:
        spark.sparkContext.addFile(path)  # each machine fetches the bounded file once
        sent.add(name)
    host_col, path_col = split_url(url_col)
    parts = pages.select(F.col(id_col).alias(id_col), host_col.alias("host"), path_col.alias("path"))
    schema = f"{id_col} {pages.schema[id_col].dataType.simpleString()}, host string, path string, rule string, verdict string"

    def judge(batches):
        index = Index(SparkFiles.get(name))
        for batch in batches:
            got = index.judge(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            rule = pa.array([r for r, _ in got], pa.string())
            verdict = pa.array([v or default for _, v in got], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, rule, verdict], names=[id_col, "host", "path", "rule", "verdict"])

    return parts.mapInArrow(judge, schema)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), "page_id", "url", RULES)


OP9_SQL = r"""
WITH parts AS (
  SELECT page_id, translate(regexp_extract(a, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(a, '^[^/?#]*([^?#]*)', 1) AS path
  FROM (SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS a FROM pages)
), rules(verdict, h, p) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), fits AS (
  SELECT page_id, max_by(h || p, length(h || p)) AS rule, max_by(verdict, length(h || p)) AS verdict
  FROM (SELECT DISTINCT page_id, host, path FROM parts) JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id
)
SELECT parts.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN fits USING (page_id)
"""
