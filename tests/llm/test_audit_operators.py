"""Exact de-duplication, filter audit and fill-in-middle."""

import hashlib
import random
import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from pagetrail.llm import exact_dedup, fill_in_middle, filter_audit
from pagetrail.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
CLASHES = "name string, level string, kept string, row string, part string, mask string, digest string, n string, form string"


@pytest.mark.parametrize("name", ["op11_exact_dedup", "op12_filter_audit", "op13_fill_in_middle"])
def test_equals_sql(spark, against_sql, name):
    assert against_sql(QUERIES[name](spark, SF), ORACLE_SQL[name], SF) > 0


def documents(spark, rows, extra=CLASHES):
    """Rows (doc_id, text, source) with further columns that clash with the operators' own."""
    names = extra.count(",") + 1
    return spark.createDataFrame([(*r, *["x"] * names) for r in rows], f"doc_id long, text string, source string, {extra}")


# ------------------------------------------------------------ exact dedup


def squeezed(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def exact_by_hand(rows):
    """Counter of (doc_id, keep_id, group_size, digest), and the texts and ids of the rows kept."""
    groups = {}
    for i, (doc_id, text, _) in enumerate(rows):
        groups.setdefault(squeezed(text), []).append((-len(text or ""), doc_id is None, doc_id or 0, i, doc_id))
    out, kept = Counter(), Counter()
    for key, members in groups.items():
        best = min(members)
        kept[(best[4], key)] += 1
        for m in members:
            out[(m[4], best[4], len(members), hashlib.sha256(key.encode()).hexdigest())] += 1
    return out, kept


def exact_rows():
    rng = random.Random(2)
    long = "".join(rng.choice("abé日🙂 \n") for _ in range(5000))
    rows = [(i, t, "s") for i, t in enumerate(["", None, " \n", "a b", "ab", "a\tb ", "a b", "abc", long, long.replace(" ", ""), long + "x", "x" + long, long[:-1] + "b"])]
    rows += [(100 + i, "ab" * k, None) for i, k in enumerate([1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 31, 32, 33, 4, 8, 32])]
    rows += [(7, "abc", "s"), (7, "abc", "s"), (None, "abc", "s"), (None, "only null", "s"), (None, "only  null", "s"), (3, "other text", "s")]
    rows += [(500 + i, "copy  of a group" if i % 3 else "copy of a group", "s") for i in range(200)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [4096, 4])
def test_exact_duplicates_by_hand(spark, monkeypatch, block):
    monkeypatch.setattr(exact_dedup, "BLOCK", block)
    rows = exact_rows()
    got = exact_dedup.exact_duplicates(documents(spark, rows)).collect()
    want, kept = exact_by_hand(rows)
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == sum(kept.values())
    assert len({(r.level, r.name) for r in got}) == len({squeezed(t) for _, t, _ in rows})
    left = exact_dedup.deduplicated(documents(spark, rows))
    assert left.columns[:3] == ["doc_id", "text", "source"] and "kept" in left.columns
    assert Counter((r.doc_id, squeezed(r.text)) for r in left.collect()) == kept


def test_names_survive_shared_keys(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BLOCK", 4)
    own = exact_dedup._key
    weak = lambda b, seed: own(b, seed) if seed > 1 else F.struct(F.octet_length(b).cast("long").alias("k1"), F.lit(seed).cast("long").alias("k2"))
    monkeypatch.setattr(exact_dedup, "_key", weak)
    rows = exact_rows()
    got = exact_dedup.exact_duplicates(documents(spark, rows)).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == exact_by_hand(rows)[0]
    monkeypatch.setattr(exact_dedup, "MAX_SEEDS", 2)
    with pytest.raises(RuntimeError, match="share their keys"):
        exact_dedup.exact_duplicates(documents(spark, rows))


def test_exact_dedup_stays_in_the_jvm(spark):
    plan = exact_dedup.exact_duplicates(documents(spark, exact_rows()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "ExistingRDD" not in plan


def test_exact_dedup_of_no_rows(spark):
    none = documents(spark, [])
    assert exact_dedup.exact_duplicates(none).collect() == [] and exact_dedup.deduplicated(none).collect() == []


# ------------------------------------------------------------ filter audit


def failed_by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return [
        len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
        bool(re.search(r"[#$%&*|]", text)),
    ]


def audit_by_hand(rows, labels, letters="ABCDE"):
    facts, out = [], {}
    for doc_id, text, source in rows:
        text = text or ""
        later = doc_id is not None and any(o[0] is not None and o[0] < doc_id and (o[1] or "") == text for o in rows)
        said = [x for x in labels if doc_id is not None and x[0] == doc_id]
        facts.append((source or "", [*failed_by_hand(text), later], any(x[1] == 1 for x in said), any(x[2] == 1 for x in said)))
    for part in {f[0] for f in facts}:
        own = [f for f in facts if f[0] == part]
        shapley = Counter()
        for order in permutations(range(5)):
            left = own
            for step, k in enumerate(order, 1):
                gone = [f for f in left if f[1][k]]
                left = [f for f in left if not f[1][k]]
                shapley[k] += len(gone)
                out[part, "".join(letters[x] for x in order), step] = [
                    len(left), len(gone), sum(f[1][k] for f in own) - len(gone), sum(f[1][k] and sum(f[1]) == 1 for f in own),
                    sum(f[2] for f in gone), sum(f[3] for f in gone), k,
                ]
        for (p, _, _), row in out.items():
            if p == part:
                row[-1] = shapley[row[-1]]
    return {k: tuple(v) for k, v in out.items()}


@pytest.mark.parametrize("window", [1 << 20, 7])
def test_audit_by_hand(spark, monkeypatch, window):
    monkeypatch.setattr(filter_audit, "WINDOW", window)
    rng = random.Random(5)
    words = ["ab", "Xy", "é", "日本", "a$b", "longer-word-than-a-window", "UP"] + [f"w{i}" for i in range(300)]
    rows = [(i, rng.choice([" ", "\n", "\x0b\t "]).join(rng.choices(words[: rng.choice([5, 60, 300])], k=rng.choice([3, 150, 230, 260]))), rng.choice(["a", "b", None, ""])) for i in range(60)]
    rows += [(100 + i, rows[i][1], "a") for i in range(0, 30, 2)] + [(None, rows[0][1], "b"), (None, None, None), (200, "", "c"), (201, None, "c"), rows[3], rows[3]]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 120, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (999, 1, 1)]
    marked = spark.createDataFrame([(*x, "z") for x in labels], "doc_id long, quality int, toxic int, part string")
    got = filter_audit.interaction_audit(filter_audit.masks(documents(spark, rows), marked)).collect()
    found = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in got}
    assert len(got) == len(found) and found == audit_by_hand(rows, labels)


def test_words_across_windows():
    rng = random.Random(6)
    for _ in range(300):
        data = bytes(rng.choices(b"ab \n\x1c\xa0", k=rng.randint(0, 30)))
        assert [w for found in filter_audit.words_of(memoryview(data), rng.randint(1, 6)) for w in found] == re.findall(rb"[^\x20\x09-\x0D]+", data)


def test_intervals_are_the_removals_of_every_order():
    for n in (1, 3, 5):
        found = Counter()
        for mask, step, start, stop in filter_audit.intervals(n):
            found.update((mask, step, rank) for rank in range(start, stop))
        want = Counter()
        for rank, order in enumerate(permutations(range(n))):
            for mask in range(1, 1 << n):
                want[mask, next(i for i, f in enumerate(order, 1) if mask >> f & 1), rank] += 1
        assert found == want


def test_audit_of_no_rows_and_other_filters(spark):
    none = filter_audit.masks(documents(spark, []), spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert filter_audit.interaction_audit(none).collect() == []
    rows = spark.createDataFrame([("p", 0, True, False), ("p", 3, True, True), ("p", 2, False, False)], "part string, mask int, good boolean, toxic boolean")
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.shapley) for r in filter_audit.interaction_audit(rows, "XY").collect()}
    assert got == {("XY", 1): (2, 1, 0, 0, 1, 1), ("XY", 2): (1, 1, 1, 1, 0, 3), ("YX", 1): (1, 2, 0, 1, 1, 3), ("YX", 2): (1, 0, 1, 0, 0, 1)}
    with pytest.raises(ValueError):
        filter_audit.interaction_audit(rows, "XX")


# ---------------------------------------------------------- fill in middle


def fim_by_hand(doc_id, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    x = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text):
        return n, "plain", None, None, text
    if h[3] % 100 < 50:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def fim_rows():
    rng = random.Random(8)
    rows = [(i, "".join(rng.choices(["a", "é", "🙂", "\n", "<", "<S", "P>", "\r", "word "], k=rng.randint(0, 40))), "s") for i in range(150)]
    rows += [(200, None, "s"), (201, "", "s"), (202, "\n", "s"), (203, "a<P>b\nc", "s"), (204, "one line " * 50, "s"), (None, "x\ny\nz", "s"), (None, None, "s")]
    return rows + [rows[5]] * 40 + [(5, "another text\nof the id", "s"), (205, "".join(f"line {i}\n" for i in range(4000)), None)]


@pytest.mark.parametrize("piece", [1 << 16, 5])
def test_fill_in_middle_by_hand(spark, monkeypatch, piece):
    monkeypatch.setattr(fill_in_middle, "PIECE", piece)
    rows = fim_rows()
    docs = documents(spark, rows).repartition(3)
    want = Counter((i, *fim_by_hand(i, t)) for i, t, _ in rows)
    outputs = fill_in_middle.transformed(docs)
    assert Counter(tuple(r) for r in outputs.collect()) == want
    assert Counter(tuple(r) for r in fill_in_middle.restored(outputs).collect()) == Counter((i, t or "") for i, t, _ in rows)
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    digests = Counter((*w[:5], sha(w[5]), sha(t)) for i, t, _ in rows for w in [(i, *fim_by_hand(i, t))])
    assert Counter(tuple(r) for r in fill_in_middle.digests(docs).collect()) == digests


def test_markers_across_chunks_and_faults():
    rng = random.Random(9)
    for _ in range(400):
        text = "".join(rng.choices(["a", "<", "<S", "\n", "P>"], k=rng.randint(1, 20)))
        if re.search("<[PSM]>", text):
            continue
        _, form, _, _, output = fim_by_hand(rng.randrange(99), text)
        raw, cuts = output.encode(), rng.randint(1, 4)
        chunks = [raw[i : i + cuts] for i in range(0, len(raw), cuts)]
        assert b"".join(p for _, _, p in sorted(fill_in_middle.text_pieces(iter(chunks), form))) == text.encode()
    for raw in (b"x<P>a<S>b<M>c", b"<P>a<S>b", b"<S>a<M>b", b""):
        with pytest.raises(ValueError):
            list(fill_in_middle.text_pieces(iter([raw]), "psm"))


def test_fill_in_middle_of_no_rows(spark):
    none = documents(spark, [])
    assert fill_in_middle.digests(none).collect() == [] and fill_in_middle.restored(fill_in_middle.transformed(none)).collect() == []


def test_texts_are_shuffled_once(spark):
    plan = fill_in_middle.digests(documents(spark, fim_rows()))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("MapInArrow") == 3 and "SinglePartition" not in plan
