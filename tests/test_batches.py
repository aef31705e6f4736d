"""Per-partition writes that are made visible once."""

import json
import os
import subprocess
import sys

import pytest

from pagetrail import sinks

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


FAILING = """
def failing(path, bad, once=None):
    \"\"\"Puts that fail after some batches: always in one partition, or only in its first attempt.\"\"\"
    import os
    from pagetrail import sinks

    class Failing(sinks.JsonLines):
        def put(self, attempt, rows):
            super().put(attempt, rows)
            if any(r["id"] == bad for r in rows) and not (once and os.path.exists(once)):
                if once:
                    open(once, "w").close()
                raise OSError("the store has gone away")

    return Failing(path)
"""
exec(FAILING)  # a class of a function is sent to the workers as it is


def ids(path):
    names = [n for n in os.listdir(path) if n.endswith(".jsonl") and not n.startswith(".")]
    return sorted(json.loads(line)["id"] for n in names for line in open(os.path.join(path, n)))


def test_rows_are_put_once_and_a_failed_write_shows_nothing(spark, tmp_dir):
    out, df = os.path.join(tmp_dir, "out"), spark.range(1000).repartition(4)
    with pytest.raises(Exception, match="gone away"):
        sinks.put_once(df, failing(out, 500), batch_size=10)  # noqa: F821
    assert ids(out) == []
    sinks.put_once(df, sinks.JsonLines(out), batch_size=10)
    assert ids(out) == list(range(1000))
    sinks.JsonLines(out).sweep()
    assert not [n for n in os.listdir(out) if n.startswith(".") and n.endswith(".jsonl")] and ids(out) == list(range(1000))
    sinks.put_once(spark.range(0), sinks.JsonLines(os.path.join(tmp_dir, "none")))


def test_a_commit_may_be_repeated(tmp_dir):
    puts = sinks.JsonLines(tmp_dir)
    attempt = puts.begin()
    name = puts.finish(attempt)
    puts.commit([name])
    puts.commit([name])
    assert os.listdir(tmp_dir) == [name.removeprefix(".")]


SCRIPT = FAILING + """
from pagetrail.session import build_session
from pagetrail.sinks import put_once
spark = build_session(master="local[2,3]")
put_once(spark.range(1000).repartition(4), failing({out!r}, 700, once={once!r}), batch_size=10)
spark.stop()
"""


def test_a_task_that_fails_after_half_its_rows_writes_once(tmp_dir):
    out, once = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "failed")
    script = SCRIPT.format(out=out, once=once)
    env = dict(os.environ, PYTHONPATH=ROOT)
    subprocess.run([sys.executable, "-c", script], check=True, env=env, timeout=300, capture_output=True)
    assert os.path.exists(once)  # the first attempt has failed
    assert ids(out) == list(range(1000))
