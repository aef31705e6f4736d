"""Secret scans: base patterns and a linear-chain conditional random field.

The field tags tokens as secret begin, inside or outside, from the token's
shape, the words around it and features of the whole text, and is decoded by
Viterbi. It is trained here, on windows of a bounded sample of documents that
the base patterns label, and on variants of them under other names and in
other alphabets, so that it finds secrets that the patterns miss.
"""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagetrail.llm.shared import sampled, ship, table, text_slices

#: The base patterns (fixed values) and what a match needs to count.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "crf")
#: The same for a first look by Spark; it only has to find texts that may match.
MAY_MATCH = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"""

#: Training: texts with and without base matches (each, at most), windows of each text, tokens of a window, rounds.
SAMPLE_TEXTS, WINDOWS, WINDOW, ROUNDS = 600, 3, 24, 60
#: So many variants are made of each kind: masked and planted, with secrets and with harmless values.
VARIANTS = 600
#: How often a token's own word and those around it are seen in training.
SEEN = {"own": 0.5, "before": 0.2, "second": 0.05, "after": 0.05}
#: What a missed secret token costs in training, in units of score.
MISS_COST = 3.0
#: A span of the field has at least so many code points and so much score above being outside.
MIN_SPAN, MARGIN = 8, 1.0

TOKEN = re.compile(r"\s*(?:[\w+/.\-]+|[^\w\s+/.\-]+)")
BEGIN, INSIDE, OUTSIDE = 0, 1, 2
LEXICAL, SHAPES, FILES = 4096, 160, 16


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base matches that count, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def token_features(token: str) -> tuple[int, int, int]:
    """Word, shape and variety of a token, as columns of the weight tables."""
    t = token.lstrip()
    n = len(t)
    length = min(7, n.bit_length() if n < 16 else 5 + (n >= 24) + (n >= 40))
    if t.isalpha():
        kind = 0 if t.islower() else 1 if t.isupper() else 2 if t[1:].islower() else 3
    elif t.isdecimal():
        kind = 4
    elif not any(map(str.isalnum, t)):
        kind = 5
    elif all(c in "0123456789abcdef" for c in t):
        kind = 6
    elif not any(map(str.isdecimal, t)):
        kind = 7
    else:
        kind = 8 if t == t.lower() or t == t.upper() else 9
    variety = min(3, 8 * len(set(t)) // n // 2) if n >= 8 else 0
    # Words and marks are known by themselves; a made-up string, new each time, by its length alone.
    word = xxhash.xxh32_intdigest(t.lower()) % (LEXICAL - 8) if n <= 24 and kind in (0, 1, 2, 5) else LEXICAL - 8 + length
    return word, LEXICAL + kind * 8 + length, LEXICAL + 80 + kind * 4 + variety


def file_feature(text: str) -> int:
    """Bucket of the whole text: share of digits and of marks among its characters."""
    n = max(len(text), 1)
    digits = sum(map(text.count, "0123456789")) / n
    marks = sum(map(text.count, "=:\"'{};_/")) / n
    grade = lambda x: 0 if x < 0.005 else 1 if x < 0.02 else 2 if x < 0.08 else 3
    return 4 * grade(digits) + grade(marks)


class Field:
    """Weights of the field: own, before, second before, after (by feature), file, and transitions."""

    TABLES = ("own", "before", "second", "after")

    def __init__(self) -> None:
        self.tables = {name: np.zeros((LEXICAL + SHAPES, 3)) for name in self.TABLES}
        self.files = np.zeros((FILES, 3))
        self.moves = np.zeros((3, 3))
        self.trained = False

    def train(self, feats: np.ndarray, labels: np.ndarray, files: np.ndarray) -> None:
        """Maximise the conditional likelihood of ``labels`` (-1: padding) by Adagrad, with a softmax margin.

        Secret tokens must win against being outside by ``MISS_COST``, as they are
        few among many, and a missed secret is worse than a word too many.

        ``feats`` is windows x tokens x 3. Forward and backward sums run over
        all windows at once.
        """
        n, length = labels.shape
        real = labels >= 0
        shifted = {"own": feats}
        for name, by in (("before", 1), ("second", 2), ("after", -1)):
            moved = np.roll(feats, by, axis=1)
            moved[:, (range(by) if by > 0 else [length - 1])] = -1
            shifted[name] = moved
        rng = np.random.default_rng(n)
        for name, f in shifted.items():
            f = f.copy()
            f[~real] = -1
            # words are hidden half of the time, and those around a token more often, so that shapes are learnt for words never seen too
            f[:, :, 0] = np.where(rng.random(labels.shape) < SEEN[name], f[:, :, 0], -1)
            if name != "own":
                f[:, :, 2] = -1
            shifted[name] = f
        truth = np.zeros((n, length, 3))
        truth[real, labels[real]] = 1
        last = real.sum(axis=1) - 1
        sums = {k: np.full_like(v, 1e-8) for k, v in self.tables.items()}
        sum_files, sum_moves = np.full_like(self.files, 1e-8), np.full_like(self.moves, 1e-8)
        pairs = real[:, 1:] & real[:, :-1]
        true_moves = np.einsum("nta,ntb->ab", truth[:, :-1] * pairs[..., None], truth[:, 1:])
        cost = np.zeros((n, length, 3))
        cost[..., OUTSIDE] = MISS_COST * (1 - truth[..., OUTSIDE]) * real
        for _ in range(ROUNDS):
            e = np.repeat(self.files[files][:, None, :], length, axis=1) + cost
            for name, f in shifted.items():
                weights = np.vstack([self.tables[name], np.zeros((1, 3))])
                for i in range(3):
                    e += weights[f[:, :, i]]
            forward = np.zeros((n, length, 3))
            backward = np.zeros((n, length, 3))
            forward[:, 0] = e[:, 0]
            for t in range(1, length):
                step = _sum_exp(forward[:, t - 1, :, None] + self.moves, axis=1) + e[:, t]
                forward[:, t] = np.where(real[:, t, None], step, forward[:, t - 1])
            for t in range(length - 2, -1, -1):
                step = _sum_exp(self.moves + (e[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
                backward[:, t] = np.where(real[:, t + 1, None], step, 0)
            total = _sum_exp(forward[np.arange(n), last], axis=1)
            likely = np.exp(forward + backward - total[:, None, None]) * real[..., None]
            both = forward[:, :-1, :, None] + self.moves + (e[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None]
            moves = (np.exp(np.minimum(both, 0)) * pairs[..., None, None]).sum(axis=(0, 1))
            miss = truth - likely
            for name, f in shifted.items():
                gradient = -1e-2 * self.tables[name]
                for i in range(3):
                    ok = f[:, :, i] >= 0
                    for y in range(3):
                        gradient[:, y] += np.bincount(f[:, :, i][ok], miss[..., y][ok], LEXICAL + SHAPES)
                sums[name] += gradient**2
                self.tables[name] += 0.3 * gradient / np.sqrt(sums[name])
            gradient = -1e-2 * self.files + np.stack([np.bincount(files, miss[..., y].sum(axis=1), FILES) for y in range(3)], axis=1)
            sum_files += gradient**2
            self.files += 0.3 * gradient / np.sqrt(sum_files)
            gradient = true_moves - moves - 1e-2 * self.moves
            sum_moves += gradient**2
            self.moves += 0.3 * gradient / np.sqrt(sum_moves)
        self.trained = True


def _sum_exp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis)
    return top + np.log(np.exp(x - np.expand_dims(top, axis)).sum(axis=axis))


class Tagger:
    """Tags whole texts in one worker; scores of known tokens are remembered up to a bound."""

    KNOWN = 200_000

    def __init__(self, field: Field) -> None:
        self.field = field
        self.reset()
        m = field.moves
        # What a token can gain at most by not being outside, through the moves around it.
        gains = [m[a, x] + m[x, b] - m[a, OUTSIDE] - m[OUTSIDE, b] for x in (BEGIN, INSIDE) for a in range(3) for b in range(3)]
        ends = [m[a, x] - m[a, OUTSIDE] for x in (BEGIN, INSIDE) for a in range(3)] + [m[x, b] - m[OUTSIDE, b] for x in (BEGIN, INSIDE) for b in range(3)]
        self.slack = max(0.0, *gains, *ends)

    def reset(self) -> None:
        self.row = {"": 0}
        self.scores = np.zeros((4, 1, 3))

    def rows(self, tokens: list[str]) -> np.ndarray:
        new = list(set(tokens) - self.row.keys())
        if new:
            f = np.array([token_features(t) for t in new])
            t = self.field.tables
            near = f[:, :2]
            made = np.stack([t["own"][f].sum(axis=1), t["before"][near].sum(axis=1), t["second"][near].sum(axis=1), t["after"][near].sum(axis=1)])
            at = self.scores.shape[1]
            self.scores = np.concatenate([self.scores, made], axis=1)
            self.row.update((token, at + i) for i, token in enumerate(new))
        return np.fromiter(map(self.row.__getitem__, tokens), np.int64, len(tokens))

    def spans(self, texts: list[str]) -> list[list[tuple[int, int]]]:
        """(start, end) of tagged spans for each text. Neighbouring texts do not touch: two empty tokens are between them."""
        if not self.field.trained:
            return [[] for _ in texts]
        if len(self.row) > self.KNOWN:
            self.reset()
        tokens = [TOKEN.findall(t) for t in texts]
        flat: list[str] = ["", ""]
        for each in tokens:
            flat += each
            flat += ["", ""]
        r = self.rows(flat)
        own, before, second, after = self.scores
        e = own[r]
        e[1:] += before[r[:-1]]
        e[2:] += second[r[:-2]]
        e[:-1] += after[r[1:]]
        sizes = np.array([len(x) + 2 for x in tokens])
        files = np.array([file_feature(t) for t in texts])
        e[2:] += np.repeat(self.field.files[files], sizes, axis=0)
        # Outside for certain: no path can win by another tag here. Viterbi runs over what is between.
        open_ = (np.maximum(e[:, BEGIN], e[:, INSIDE]) + self.slack >= e[:, OUTSIDE]) & (r > 0)
        out: list[list[tuple[int, int]]] = [[] for _ in texts]
        at = np.flatnonzero(open_)
        if not len(at):
            return out
        firsts = np.cumsum([2, *sizes])  # of each text's tokens
        breaks = np.flatnonzero(np.diff(at) > 1)
        ends_of: dict[int, np.ndarray] = {}
        for a, b in zip(at[np.r_[0, breaks + 1]], at[np.r_[breaks, len(at) - 1]] + 1, strict=True):
            tags = self.viterbi(e[a:b], r[a - 1] > 0, r[b] > 0)
            k = int(np.searchsorted(firsts, a, "right")) - 1
            if k not in ends_of:
                ends_of[k] = np.cumsum([len(t) for t in tokens[k]])
            for i, j in tagged_runs(tags):
                if sum(float(e[a + t, tags[t]] - e[a + t, OUTSIDE]) for t in range(i, j)) < MARGIN:
                    continue
                first, end = int(a) + i - int(firsts[k]), int(ends_of[k][int(a) + j - 1 - int(firsts[k])])
                start = int(ends_of[k][first]) - len(tokens[k][first].lstrip())
                if end - start >= MIN_SPAN:
                    out[k].append((start, end))
        return out

    def viterbi(self, e: np.ndarray, left: bool, right: bool) -> list[int]:
        """Best tags of a stretch whose neighbours, if there are any, are outside."""
        m = self.field.moves
        best = e[0] + (m[OUTSIDE] if left else 0)
        back = []
        for row in e[1:]:
            step = best[:, None] + m
            back.append(step.argmax(axis=0))
            best = step.max(axis=0) + row
        tag = int((best + (m[:, OUTSIDE] if right else 0)).argmax())
        tags = [tag]
        for choice in reversed(back):
            tag = int(choice[tag])
            tags.append(tag)
        return tags[::-1]


def tagged_runs(tags: list[int]) -> list[tuple[int, int]]:
    """[start, end) of each run of begin or inside; a begin starts a new one."""
    runs: list[list[int]] = []
    for i, tag in enumerate(tags):
        if tag == OUTSIDE:
            continue
        if runs and tag == INSIDE and runs[-1][1] == i:
            runs[-1][1] = i + 1
        else:
            runs.append([i, i + 1])
    return [(a, b) for a, b in runs]


def windows_of(text: str) -> list[tuple[list[str], list[int], int]]:
    """Training windows: around base matches, and one where there are none.

    A value counts as secret if it has a digit, so that prose after "secret:"
    is learned as outside.
    """
    tokens = TOKEN.findall(text)
    if not tokens:
        return []
    ends = np.cumsum([len(t) for t in tokens])
    labels = np.full(len(tokens), OUTSIDE)
    values = [m.span(2) for m in ASSIGN.finditer(text) if len(m[2]) >= 8 and any(map(str.isdecimal, m[2]))]
    values += [m.span() for m in ACCESS.finditer(text) if m.end() - m.start() >= 20] + [m.span() for m in HEX.finditer(text)]
    hits = []
    for a, b in sorted(values):
        i, j = int(np.searchsorted(ends, a, "right")), int(np.searchsorted(ends, b, "left")) + 1
        if labels[i] == OUTSIDE:
            labels[i:j] = INSIDE
            labels[i] = BEGIN
            hits.append(i)
    places = [max(0, i - WINDOW // 2) for i in hits[:WINDOWS]] + [xxhash.xxh32_intdigest(text) % len(tokens)]
    bucket = file_feature(text)
    return [([t.lstrip()[:200] for t in tokens[p : p + WINDOW]], labels[p : p + WINDOW].tolist(), bucket) for p in places]


LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Alphabets of made-up secrets: none of them is that of one base pattern alone.
ALPHABETS = [LOWER + UPPER + DIGITS, LOWER + UPPER + DIGITS, LOWER + DIGITS, UPPER + DIGITS, LOWER + UPPER + DIGITS + "+/", LOWER + UPPER + DIGITS + "_-", "ABCDEF" + DIGITS, "abcdef" + DIGITS]


def _word(rng: random.Random, alphabet: str, low: int, high: int) -> str:
    return "".join(rng.choices(alphabet, k=rng.randint(low, high)))


#: What may stand between a name and a value, and after the value, as tokens.
MARKS = [(("=",), ()), ((":",), ()), (("=", '"'), ('"',)), ((":", '"'), ('"',)), (('="',), ('"',)), (("='",), ("'",)), (("is",), ()), ((), ()), ((), ())]


def made_up(rng: random.Random, secret: bool) -> str:
    """A secret in one of ``ALPHABETS``, or something harmless: a word, a number, an address or a date."""
    if secret:
        value = _word(rng, rng.choice(ALPHABETS), 12, 48)
        return value if any(map(str.isdecimal, value)) else value + rng.choice(DIGITS)
    word = lambda: _word(rng, LOWER, 2, 14)
    number = lambda n: _word(rng, DIGITS, 1, n)
    harmless = [
        word(), word().title(), word().upper(), number(12), f"{word()}.{word()}.{word()}", f"{word()}-{word()}", f"{word()}{number(3)}",
        f"{number(4)}-{number(2)}-{number(2)}", f"{number(3)}.{number(3)}.{number(3)}", f"/{word()}/{word()}/{number(5)}", f"{word()}_{word()}",
    ]
    return rng.choice(harmless)


def _assigned(rng: random.Random, words: list[str], secret: bool, named: bool = True) -> tuple[list[tuple[str, int]], tuple[str, ...]]:
    """Tokens and labels of a name, marks and a made-up value, and the marks that close it.

    The name is made of words of the sample, which stand elsewhere in it too: a word
    that were only ever seen before secrets would be taken for a sign of them.
    """
    before, after = rng.choice(MARKS)
    name = rng.choice(words)
    names = [name, name, name.upper(), f"{name}_{rng.choice(words)}", f"{name}-{rng.choice(words)}"]
    head = [(rng.choice(names), OUTSIDE)] if named else []
    return [*head, *[(mark, OUTSIDE) for mark in before], (made_up(rng, secret), BEGIN if secret else OUTSIDE)], after


def masked(tokens: list[str], labels: list[int], rng: random.Random, words: list[str], secret: bool) -> tuple[list[str], list[int]]:
    """A window with its secrets, and the names and marks around them, replaced by made-up ones, so that the patterns are not learnt by heart."""
    out: list[tuple[str, int]] = []
    after: tuple[str, ...] | None = None
    for token, label in zip(tokens, labels, strict=True):
        if label == BEGIN:
            while out and not any(map(str.isalnum, out[-1][0])):
                out.pop()
            found, after = _assigned(rng, words, secret, named=bool(out))
            out[-1:] = found
        elif label == OUTSIDE:
            if after is None or any(map(str.isalnum, token)):
                out.append((token, label))
            else:  # what has closed the value
                out += [(mark, label) for mark in after]
            after = None
    return [t for t, _ in out[:WINDOW]], [x for _, x in out[:WINDOW]]


def planted(tokens: list[str], labels: list[int], rng: random.Random, words: list[str], secret: bool) -> tuple[list[str], list[int]]:
    """A window with a made-up name and value put in between two of its tokens: any words may stand around a secret."""
    at = rng.randint(0, min(len(tokens), WINDOW - 6))
    found, after = _assigned(rng, words, secret, named=rng.random() < 0.8)
    rest = list(zip(tokens, labels, strict=True))
    if at < len(rest) and rest[at][1] == INSIDE:  # not into a secret
        at = 0
    out = [*rest[:at], *found, *[(mark, OUTSIDE) for mark in after], *rest[at:]][:WINDOW]
    return [t for t, _ in out], [x for _, x in out]


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Field:
    """A field trained on windows of ``SAMPLE_TEXTS`` texts with and as many without base matches.

    They are those with the least hash of their id, then of their text, so the
    sample is the same at each run; equal rows count once. Only windows leave the
    tasks. Those with secrets are varied, with made-up secrets and with harmless
    values. Without any secret the field stays untrained and tags nothing.
    """
    ship(docs.sparkSession)
    hit = F.col("text").rlike(MAY_MATCH)
    rows = docs.where(F.length(text_col) > 0).select(F.xxhash64(id_col).alias("h"), F.col(text_col).alias("text")).withColumn("hit", hit)

    def cut(batches):
        for batch in batches:
            for h, r, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                got = windows_of(t)
                if got:
                    columns = [[h] * len(got), [r] * len(got), list(range(len(got))), *map(list, zip(*got, strict=True))]
                    kinds = [pa.bool_(), pa.int32(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.int32()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["hit", "r", "w", "tokens", "labels", "file"])

    few = sampled(rows, "hit", SAMPLE_TEXTS).select("hit", "r", "text")
    windows = few.mapInArrow(cut, "hit boolean, r int, w int, tokens array<string>, labels array<int>, file int").dropDuplicates(["hit", "r", "w"])
    got = [(w.tokens, w.labels, w.file) for w in sorted(windows.collect(), key=lambda w: (w.hit, w.r, w.w))]
    field = Field()
    hits = [w for w in got if BEGIN in w[1]]
    if hits:
        rng = random.Random(VARIANTS)
        words = [t for tokens, _, _ in got for t in tokens if t.isalpha()] or ["name"]
        got += [
            (*vary(*chosen[k % len(chosen)][:2], rng, words, secret), chosen[k % len(chosen)][2])
            for vary, chosen in ((masked, hits), (planted, list(got)))
            for secret in (True, False)
            for k in range(VARIANTS)
        ]
        feats = np.zeros((len(got), WINDOW, 3), int)
        labels = np.full((len(got), WINDOW), -1)
        for i, (tokens, tags, _) in enumerate(got):
            feats[i, : len(tokens)] = [token_features(t) for t in tokens]
            labels[i, : len(tokens)] = tags
        field.train(feats, labels, np.array([file for _, _, file in got]))
    return field


def all_spans(texts: list[str], tagger: Tagger) -> list[list[tuple[int, int, int]]]:
    """Base spans and those of the field that lie in none of them; they may overlap."""
    out = []
    for text, extra in zip(texts, tagger.spans(texts), strict=True):
        base = base_spans(text)
        out.append(sorted(base + [(a, 3, b) for a, b in extra if not any(s <= a and b <= e for s, _, e in base)]))
    return out


def scan(docs: DataFrame, field: Field, keep: list[str], text_col: str = "text") -> DataFrame:
    """The ``keep`` columns with n_assign, n_access, n_hex, base_sha256 and spans.

    Spans are code points of the whole text; null texts are empty texts.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)
    schema = docs.select(*keep).schema
    for c in ("n_assign", "n_access", "n_hex"):
        schema = schema.add(c, "long")
    schema = schema.add("base_sha256", "string").add("spans", "string")

    def run(batches):
        tagger = Tagger(shared.value)
        for batch in batches:
            raw = [t or "" for t in batch.column(len(keep)).to_pylist()]
            for start, stop in text_slices(raw):
                texts = raw[start:stop]
                found = all_spans(texts, tagger)
                base = [[s for s in spans if s[1] < 3] for spans in found]
                columns = [pa.array([sum(s[1] == k for s in spans) for spans in base], pa.int64()) for k in range(3)]
                columns.append(pa.array([hashlib.sha256(joined(b).encode()).hexdigest() for b in base]))
                columns.append(pa.array(map(joined, found), pa.string()))
                kept = [batch.column(i).slice(start, stop - start) for i in range(len(keep))]
                yield pa.RecordBatch.from_arrays([*kept, *columns], names=schema.names)

    return docs.select(*keep, F.col(text_col).alias("_text")).mapInArrow(run, schema)


def redacted(docs: DataFrame, field: Field, mark: str = "<SECRET>", text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """The rows with every span of the text replaced by ``mark`` and ``length_col`` made right; null stays null."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    at = docs.columns.index(text_col)

    def run(batches):
        tagger = Tagger(shared.value)
        for batch in batches:
            raw = batch.column(at).to_pylist()
            done: list[str | None] = []
            for start, stop in text_slices([t or "" for t in raw]):
                texts = [t or "" for t in raw[start:stop]]
                done += [None if r is None else without(t, s, mark) for r, t, s in zip(raw[start:stop], texts, all_spans(texts, tagger), strict=True)]
            yield batch.set_column(at, batch.schema.field(at), pa.array(done, batch.schema.field(at).type))

    out = docs.mapInArrow(run, docs.schema)
    return out.withColumn(length_col, F.length(text_col).cast(docs.schema[length_col].dataType)) if length_col in docs.columns else out


def without(text: str, spans: list[tuple[int, int, int]], mark: str) -> str:
    """The text with each stretch of spans, joined where they overlap, replaced."""
    out, at = [], 0
    end = -1
    for a, _, b in sorted(spans):
        if a >= end:
            out += [text[at:a], mark]
        at = end = max(end, b)
    return "".join([*out, text[at:]])


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base matches of every document, and spans that the field adds."""
    docs = table(spark, sf_dir, "documents")
    return scan(docs, fit(docs), ["doc_id"])
