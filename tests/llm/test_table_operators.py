import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from pagetrail.llm import embedding_dedup, minhash_dedup, url_filter, warc
from pagetrail.llm.components import components
from pagetrail.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op4_minhash_dedup", "op5_warc", "op7_embedding_dedup", "op9_url_filter"])
def test_equals_sql(spark, against_sql, name):
    assert against_sql(QUERIES[name](spark, SF), ORACLE_SQL[name], SF) > 0
    QUERIES[name](spark, SF).count()  # again in the same session


def least_reachable(ids, links):
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                changed = True
    return root


def test_components_of_chains_and_hubs(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 260)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    got = {r.node: r.root for r in components(spark.createDataFrame([*edges, (7, 7), (None, 3)], "a long, b long")).collect()}
    want = least_reachable({x for e in edges for x in e}, edges)
    assert got == {n: r for n, r in want.items() if any(n in e and e[0] != e[1] for e in edges)}


# ---------------------------------------------------------------- MinHash


@pytest.mark.parametrize("block", [512, 8])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(minhash_dedup, "BLOCK", block)
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(3000)}"
    base = [[word() for _ in range(150)] for _ in range(3)]
    rows = []
    for i in range(150):  # near copies around a few texts: some linked, some strays of their stars
        words = list(base[i % 3])
        for _ in range(rng.choice([0, 0, 1, 2, 4, 7])):
            words[rng.randrange(len(words))] = word()
        rows.append((1000 - i, " ".join(words).upper() if i % 2 else "\t".join(words)))
    rows += [(2000, None), (2001, ""), (2002, " \n "), (2003, "one"), (2004, "ONE"), (2005, "one two"), (None, rows[0][1]), rows[5], rows[5]]
    sets = [minhash_dedup.words_of(t) for _, t in rows]
    sets = [{tuple(w[i : i + min(3, len(w))]) for i in range(len(w) - min(3, len(w)) + 1)} if w else set() for w in sets]
    named = [(i, s) for (i, _), s in zip(rows, sets, strict=True) if i is not None and s]
    links = [(a, b) for a, x in named for b, y in named if a < b and 100 * len(x & y) >= 85 * len(x | y)]
    root = least_reachable({i for i, _ in rows if i is not None}, links)
    df = spark.createDataFrame([(i, t, "clash", True) for i, t in rows], "doc_id long, text string, component_id string, kept boolean")
    got = minhash_dedup.near_duplicates(df, 3, 85).collect()
    assert sorted(map(repr, got and [tuple(r) for r in got])) == sorted(
        repr((i, len(s), root.get(i), i is not None and root[i] == i)) for (i, _), s in zip(rows, sets, strict=True)
    )
    assert minhash_dedup.near_duplicates(df.limit(0), 5, 80).count() == 0


def test_an_id_with_two_texts_has_the_near_copies_of_both(spark):
    rng = random.Random(8)
    fresh = lambda: [f"w{rng.randrange(10**6)}" for _ in range(120)]
    rows, want = [], []
    for i in range(1, 400, 10):
        one, two = fresh(), fresh()
        rows += [(i, one), (i, two), (i + 1, [*one[:-1], "x"]), (i + 2, [*two[:-1], "y"])]
        want += [(i, 118, i, True)] * 2 + [(i + 1, 118, i, False), (i + 2, 118, i, False)]
        three = fresh()  # near copies of an id's second text do not move those of its first
        rows += [(i + 3, three), (i + 4, three[:-1]), (i + 4, one[::-1]), (i + 5, [*one[::-1], "z"])]
        want += [(i + 3, 118, i + 3, True), (i + 4, 117, i + 3, False), (i + 4, 118, i + 4, True), (i + 5, 119, i + 4, False)]
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string").repartition(5)
    assert sorted(map(tuple, minhash_dedup.near_duplicates(df, 3, 85).collect())) == sorted(want)


# ------------------------------------------------------------------- WARC


def test_salvage_goes_on_after_damage():
    made = [warc.record(i, f"http://h/{i} x", b"payload %d " % i * 20, hashlib.sha256(b"payload %d " % i * 20).hexdigest(), None, False) for i in range(5)]
    members = [warc.gzip_member(r) for r in made]
    damaged = bytearray(members[1])
    damaged[len(damaged) // 2] ^= 0xFF
    plain = made[3].replace(b"payload 3", b"pAyload 3", 1)  # its digest differs
    data = b"junk" + members[0] + bytes(damaged) + members[2] + plain + made[4] + b"\n"
    found = list(warc.salvage(data))
    kept = [f[3][0]["warc-record-id"] for f in found if f[0] == "record"]
    assert kept == ["<urn:page:0>", "<urn:page:2>", "<urn:page:4>"]
    gaps = [(a, b) for kind, a, b, _ in found if kind == "gap"]
    assert gaps[0] == (0, 4) and gaps[1] == (4 + len(members[0]), 4 + len(members[0]) + len(damaged)) and len(gaps) == 3
    assert [a for _, a, _, _ in found][1:] == [b for _, _, b, _ in found][:-1]
    assert list(warc.salvage(b"")) == [] and [f[0] for f in warc.salvage(b"nothing here")] == ["gap"]
    cut = members[0] + members[1][:-9]
    assert [f[0] for f in warc.salvage(cut)] == ["record", "gap"]
    assert zlib.decompress(members[0], 31) == made[0]


def test_salvage_of_members_with_several_records(spark, tmp_path):
    rng = random.Random(7)
    made = [warc.record(i, f"http://h/{i}", p := rng.randbytes(3000), hashlib.sha256(p).hexdigest(), None, False) for i in range(9)]
    ids = lambda found: [int(f[3][0]["warc-record-id"][10:-1]) for f in found if f[0] == "record"]
    wrong = bytearray(made[1])
    wrong[-50] ^= 1  # its digest differs
    short = made[3].replace(b"\nContent-Length: 3", b"\nContent-Length: 2", 1)
    member = warc.gzip_member(b"".join([made[0], bytes(wrong), made[2], short, b"junk", made[4]]))
    data = member + warc.gzip_member(made[5])
    found = list(warc.salvage(data))
    assert ids(found) == [0, 2, 4, 5] and [f[0] for f in found] == ["record", "gap", "record", "gap", "record", "record"]
    assert {f[1:3] for f in found[:5]} == {(0, len(member))} and found[5][1:3] == (len(member), len(data))
    assert found[1][3].startswith(f"bytes {len(made[0])} to {len(made[0]) + len(wrong)} of")
    whole = warc.gzip_member(b"".join(made[:5]))
    cut = whole[: len(whole) * 7 // 10]
    assert ids(warc.salvage(cut)) == [0, 1, 2] and ids(warc.salvage(cut + warc.gzip_member(made[8]))) == [0, 1, 2, 8]
    for at in (len(whole) // 2, len(whole) - 6):  # within a record's bytes, within the check sum
        bad = bytearray(whole)
        bad[at] ^= 0xFF
        got = list(warc.salvage(bytes(bad) + data))
        assert set(ids(got)) >= {0, 1, 0, 2, 4, 5} and ids(got)[-4:] == [0, 2, 4, 5] and ("gap", 0, len(whole)) in [f[:3] for f in got]
        assert all(f[3][1] in made[int(f[3][0]["warc-record-id"][10:-1])] for f in got if f[0] == "record")
    undigested = b"".join(made[:2]).replace(b"WARC-Block-Digest", b"X-Block-Digest")
    assert ids(warc.salvage(warc.gzip_member(undigested))) == [0, 1]
    assert ids(warc.salvage(warc.gzip_member(undigested)[:-8] + b"\0" * 8)) == []
    (tmp_path / "a.warc.gz").write_bytes(data)
    rows = warc.read_archives(spark, str(tmp_path)).collect()
    assert [r.record_id and int(r.record_id[10:-1]) for r in rows] == [0, None, 2, None, 4, 5]


def test_archives_of_odd_pages(spark, tmp_path):
    same = "é" * 60
    rows = [(3, "http://a/\r\nX: y", same), (1, None, same), (2, "u", same), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (7, "u", ""), (None, "u", same), (2, "u", same)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_archives(warc.with_revisits(pages), str(tmp_path / "w"))
    back = warc.read_archives(spark, str(tmp_path / "w")).collect()
    assert len(back) == len(rows) and not any(r.reason for r in back)
    kinds = sorted((r.record_id, r.record_type, r.refers_to or "", r.payload_bytes) for r in back)
    assert kinds == sorted(
        [("<urn:page:1>", "response", "", 120), *[(f"<urn:page:{i}>", "revisit", "<urn:page:1>", 120) for i in ("", 2, 2, 3)]]
        + [("<urn:page:4>", "response", "", 5), ("<urn:page:5>", "response", "", 5), ("<urn:page:6>", "response", "", 0), ("<urn:page:7>", "response", "", 0)]
    )
    assert [bytes(r.payload) for r in back if r.record_id == "<urn:page:1>"] == [same.encode()]
    warc.write_archives(warc.with_revisits(pages.limit(0)), str(tmp_path / "e"))
    assert warc.read_archives(spark, str(tmp_path / "e")).collect() == []


class CountingTape(warc.Tape):
    """Counts the bytes read, and the most that is held."""

    def __init__(self, data, chunk):
        super().__init__((data[i : i + chunk] for i in range(0, len(data), chunk)), len(data))
        self.read = self.most = 0

    def get(self, a, b):
        out = super().get(a, b)
        self.read += len(out)
        self.most = max(self.most, len(self.held))
        return out


@pytest.mark.parametrize("kind", ["members", "broken members", "plain", "broken plain", "junk marks"])
def test_salvage_is_linear_and_streams(kind):
    rng = random.Random(3)
    made = [warc.record(i, f"http://h/{i}", p := rng.randbytes(1500) + b"text " * 200, hashlib.sha256(p).hexdigest(), None, False) for i in range(1200)]

    def archive(n):
        if kind == "junk marks":
            return (b"WARC/1.0 \x1f\x8b\x08 " * 30 + b"WARC/1.1\r\nno end of it ") * n
        parts = [bytearray(r if "plain" in kind else warc.gzip_member(r)) for r in made[:n]]
        for part in parts if "broken" in kind else []:
            part[len(part) // 2] ^= 0x55
        return b"".join(parts)

    reads = []
    for n in (300, 1200):
        data = archive(n)
        tape = CountingTape(data, 5000)
        found = list(warc.salvage(tape))
        assert found == list(warc.salvage(data))
        assert sum(f[0] == "record" for f in found) == (n if kind in ("members", "plain") else 0)
        reads.append(tape.read / len(data))
        assert tape.most < warc.MAX_HEAD + 3 * warc.STEP
    assert reads[1] < 1.2 * reads[0] + 0.1 and reads[1] < 12


def test_salvage_bounds_what_a_wrong_length_makes_it_hold(monkeypatch):
    monkeypatch.setattr(warc, "MAX_CONTENT", 5000)
    big, small = b"x" * 9000, b"y" * 100
    record = lambda i, p: warc.record(i, "u", p, hashlib.sha256(p).hexdigest(), None, False)
    for data in (record(0, big) + record(1, small), warc.gzip_member(record(0, big)) + warc.gzip_member(record(1, small))):
        found = list(warc.salvage(data))
        assert [f[0] for f in found] == ["gap", "record"] and "more than 5000 bytes" in found[0][3]
    wrong = record(0, small).replace(b"\nContent-Length: ", b"\nContent-Length: 99", 1)
    assert [f[0] for f in warc.salvage(wrong + record(1, small))] == ["gap", "record"]


def test_archives_are_streamed_from_splits(spark, tmp_path):
    rng = random.Random(11)
    made = [warc.record(i, f"http://h/{i}", p := rng.randbytes(rng.randint(0, 4000)) + b"\r\n\n" * 9, hashlib.sha256(p).hexdigest(), None, False) for i in range(120)]
    members = [warc.gzip_member(r) if i % 3 else r for i, r in enumerate(made)]
    files = {"a.warc": b"".join(members[:70]) + b"\n", "b.warc": b"junk\n" + b"".join(members[70:]) + b"junk", "c.warc": b"", "d.warc": b"\n", "e.warc.gz": members[1]}
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = warc.read_archives(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    got = {name: [(r.start, r.end, r.reason, r.payload_digest) for r in rows if r.file.endswith("/" + name)] for name in files}
    for name, data in files.items():
        want = [(a, b, what if kind == "gap" else None, None if kind == "gap" else hashlib.sha256(what[1].partition(b"\r\n\r\n")[2]).hexdigest()) for kind, a, b, what in warc.salvage(data)]
        assert got[name] == want


# -------------------------------------------------------------- embeddings


@pytest.mark.parametrize("block", [512, 4])
def test_embeddings_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rng = np.random.default_rng(3)
    rows = []
    for i in range(120):
        v = rng.standard_normal(16) if i % 4 == 0 else np.array(rows[-1][1]) + rng.standard_normal(16) * rng.choice([0, 0.05, 0.2])
        rows.append((500 - i, [float(x) for x in v], i % 3 // 2))
    rows += [(600, None, 0), (601, [], 0), (602, [0.0] * 16, 0), (603, [1.0, None], 0), (604, [float("nan")] * 16, 0), (605, rows[0][1], None), (606, [1.0, 0.0], 0), (607, [2.0, 0.0], 0), (None, rows[0][1], 0), rows[8]]

    def ok(r):
        return r[0] is not None and r[2] is not None and embedding_dedup.unit(r[1]) is not None

    linked = [
        [j for j, b in enumerate(rows) if i != j and ok(a) and ok(b) and a[2] == b[2] and len(a[1]) == len(b[1]) and embedding_dedup.unit(a[1]) @ embedding_dedup.unit(b[1]) >= 0.98]
        for i, a in enumerate(rows)
    ]
    root = least_reachable({r[0] for r in rows if r[0] is not None}, [(rows[i][0], rows[j][0]) for i, x in enumerate(linked) for j in x])
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int, n_links int")
    got = embedding_dedup.near_duplicates(df, "vec_id", "embedding", "label").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(
        repr((r[0], len(linked[i]), root.get(r[0]), r[0] is not None and root[r[0]] == r[0])) for i, r in enumerate(rows)
    )
    assert embedding_dedup.near_duplicates(df.limit(0), "vec_id", "embedding", "label").count() == 0


def test_estimates_are_never_too_low_by_more_than_their_bound():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((300, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    y = x + rng.standard_normal((300, 64)) * rng.uniform(0, 0.05, (300, 1))
    y /= np.linalg.norm(y, axis=1)[:, None]
    turn = embedding_dedup.rotation(64)
    signs = np.where(x @ turn > 0, 1.0, -1.0)
    f = (signs * (x @ turn)).sum(axis=1) / 8
    cosine, estimate = (x * y).sum(axis=1), (signs * (y @ turn)).sum(axis=1) / 8 / f
    assert (np.abs(estimate - cosine) <= np.sqrt((1 / f**2 - 1) * np.maximum(0, 1 - cosine**2)) + 1e-9).all()


def near_vectors(n, dim, seed):
    """Random vectors, every third near an earlier one; cosines around the threshold."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim))
    for i in range(0, n, 3):
        x[i] = x[rng.integers(0, i + 1)] + rng.standard_normal(dim) * rng.choice([0.02, 0.1, 0.2, 0.3])
    return x / np.linalg.norm(x, axis=1)[:, None]


def test_codes_leave_every_link_open(spark):
    x = near_vectors(400, 48, 2)
    classes = spark.createDataFrame([(i, 1, "l", v.tolist()) for i, v in enumerate(x)], "rep long, n long, label string, vector array<double>")
    rows = embedding_dedup.coded(classes, 0, 1).orderBy("rep").toArrow()
    n = len(x)
    for split in (False, True):
        blocks = np.arange(n) % 2 if split else np.zeros(n, int)
        fixed = {"low": np.zeros(n, int), "high": np.full(n, int(split)), "table": np.zeros(n, int), "block": blocks}
        block = rows
        for name, values in fixed.items():
            block = block.append_column(name, pa.array(values))
        pairs = {(min(p), max(p)) for p in zip(*(k.tolist() for k in embedding_dedup.open_pairs(block, 0.98)), strict=True)}
        links = {(i, j) for i, j in zip(*np.nonzero(np.triu(x @ x.T >= 0.98, 1))) if not split or (i - j) % 2}
        assert links <= pairs and len(pairs) < 0.1 * n * n and len(links) > 30
        exact = {(min(p), max(p)) for p in zip(*(k.tolist() for k in embedding_dedup.linked_in(block, 0.98)), strict=True)}
        assert exact == links


def test_recall_in_many_tables(spark, monkeypatch):
    """Thousands of rows a label, so that buckets have bits and there are many tables."""
    monkeypatch.setattr(embedding_dedup, "BLOCK", 64)
    x = near_vectors(5000, 32, 3)
    assert embedding_dedup.tables_for(len(x) // 2)[0] >= 5
    df = spark.createDataFrame([(i, v.tolist(), i % 2) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: r.n_links for r in embedding_dedup.near_duplicates(df, "vec_id", "embedding", "label").collect()}
    same = (x @ x.T >= 0.98) & (np.arange(5000)[:, None] % 2 == np.arange(5000) % 2)
    np.fill_diagonal(same, False)
    want = same.sum(axis=1)
    assert want.sum() > 800 and all(got[i] == want[i] for i in range(5000))


def test_vectors_are_fetched_for_open_pairs_only(spark, monkeypatch):
    """What is dealt to the pairs of blocks holds no vector."""
    rows = near_vectors(50, 64, 4)
    classes = spark.createDataFrame([(i, 1, "l", v.tolist()) for i, v in enumerate(rows)], "rep long, n long, label string, vector array<double>")
    seen, own = [], embedding_dedup.stored
    monkeypatch.setattr(embedding_dedup, "stored", lambda df, name: (seen.append((name, df._jdf.queryExecution().optimizedPlan().toString())), own(df, name))[1])
    codes = own(embedding_dedup.coded(classes, 0, 1), "codes")
    embedding_dedup.compare_blocks(codes, 0.98)
    survey = next(plan for name, plan in seen if name == "open")
    assert "rough" in survey and "unit" not in survey.split("Relation")[0]


# ------------------------------------------------------------------- urls


def test_urls_equal_brute_force(spark):
    rng = random.Random(8)
    hosts = ["example.org", "Sub.Example.org", "badexample.org", "com", "x.com", "org", "a.b.net", ""]
    paths = ["/es/1", "/en/12", "/en/2", "/fr/", "/de/x", "/", "", "/es"]
    urls = [f"{rng.choice(['http', 'x'])}://{h}{p}{t}" for h in hosts for p in paths for t in ("", "?q=://z", "#f")] + [None, "", "no-scheme/de/", "a://b://c.com/de/"]
    want = []
    for u in urls:
        after = u.split("://", 1)[1] if u and "://" in u else ""
        cut = min([after.find(c) for c in "/?#" if c in after] or [len(after)])
        host, rest = after[:cut].lower(), after[cut:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
        fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        want.append((host, path, max(fits)[1] if fits else None, max(fits)[2] if fits else "allow"))
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(df, "page_id", "url", url_filter.RULES).collect()}
    assert [got[i] for i in range(len(urls))] == want
    assert url_filter.filter_urls(df, "page_id", "url", []).where("verdict = 'allow'").count() == len(urls)
