"""The pipeline against a brute-force version with the same trained models."""

import base64

import corpus_pipeline
import public_tokenizers
import tiktoken

from pagetrail.llm import bpe, language_id, secrets

SF = "/root/testdata/sf0.001"


def grams(words):
    n = min(5, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language_id.fit(docs.selectExpr("text", "lang", "doc_id AS id"))
    rows = sorted((r.doc_id, r.text or "") for r in docs.collect())
    rows = [(i, t) for i, t in rows if not model.predict([t])[0][2]]
    root, sets = {i: i for i, _ in rows}, {i: grams((t or "").encode().lower().split()) for i, t in rows}
    for _ in range(len(rows)):
        before = dict(root)
        for a, x in sets.items():
            for b, y in sets.items():
                if a < b and x and y and 100 * len(x & y) >= 80 * len(x | y):
                    root[a] = root[b] = min(root[a], root[b])
        if root == before:
            break
    rows = [(i, t) for i, t in rows if root[i] == i]
    words = lambda t: secrets.re.findall(r"[^\W_]+", t.lower())
    items = [g for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect() if len(words(r.text)) >= 5 and (g := grams(words(r.text)))]
    rows = [(i, t) for i, t in rows if not any(len(g & grams(words(t))) * 10 >= len(g) * 8 for g in items)]
    left = docs.join(spark.createDataFrame([(i,) for i, _ in rows], "doc_id long"), "doc_id")
    tagger = secrets.Tagger(secrets.fit(left))
    texts = [secrets.without(t, secrets.all_spans([t], tagger)[0], "<SECRET>") for _, t in rows]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path(bpe.RANKS), "rb"))}
    codec = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = [(i, codec.encode_ordinary(t)) for (i, _), t in zip(rows, texts, strict=True)]
    got = sorted((r.doc_id, list(r.ids)) for r in corpus_pipeline.run(spark, SF).collect())
    assert got == want and 100 < len(got) < docs.count()


def test_stages_take_odd_tables(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema.add("score", "string")
    odd = [(1, None, None, None, None, "x"), (None, "word word", "en", "s", 9, "y"), (2, "", "en", "s", 0, None), (3, "some words of text", "en", "s", 18, None), (3, "some words of text", "en", "s", 18, None)]
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = spark.createDataFrame(stage(spark, docs, SF).collect(), schema)
            assert docs.columns == schema.names
        assert corpus_pipeline.tokenize(spark, docs, SF).columns == ["doc_id", "n_tokens", "ids"]
