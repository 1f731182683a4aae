"""Operators 11 to 13 against plain versions."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from caudal.llm import periodic_runs, ppm_scoring, qr_whitening
from tests.llm.conftest import sentence

HELD_OUT = "crc32(string(doc_id)) % 5 = 1"


def is_held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


# ---- operator 11

class PlainPPM:
    """PPM with explicit sets of excluded symbols."""

    def __init__(self, texts, order):
        self.order, self.counts = order, [defaultdict(Counter) for _ in range(order + 1)]
        for t in texts:
            s = b"\n" * order + t + b"\n"
            for i in range(order, len(s)):
                self.counts[order][s[i - order : i]][s[i]] += 1
        for k in range(order, 0, -1):
            for c, followers in self.counts[k].items():
                for x in followers:
                    self.counts[k - 1][c[1:]][x] += 1

    def probability(self, context, symbol):
        p, excluded = 1.0, set()
        for k in range(self.order, -1, -1):
            followers = self.counts[k].get(context[self.order - k :])
            left = {x: n for x, n in (followers or {}).items() if x not in excluded}
            if left:
                total = sum(left.values())
                if symbol in left:
                    return p * (left[symbol] - 0.5) / total
                p *= len(left) / 2 / total
            excluded |= set(followers or {})
        return p / (256 - len(excluded))

    def score(self, text):
        s = b"\n" * self.order + text + b"\n"
        return sum(math.log10(self.probability(s[i - self.order : i], s[i])) for i in range(self.order, len(s)))


def plain_scores(rows, order):
    texts = [(d, is_held_out(d), (t or "").encode().lower().split()) for d, t in rows]
    train = [ws for _, h, ws in texts if not h]
    count = Counter(w for ws in train for w in ws)
    n, v, ends = sum(count.values()) + len(train), len(count) + bool(train), len(train)
    model = PlainPPM([b" ".join(ws) for ws in train], order)
    below = math.log10(n + 0.5 * (v + 1))
    return sorted((d is None, d or 0, h, len(ws) + 1, sum(w in count for w in ws) + bool(ends), n,
                   round(sum(math.log10(count[w] + 0.5) - below for w in ws) + math.log10(ends + 0.5) - below, 6),
                   round(model.score(b" ".join(ws)), 6)) for d, h, ws in texts)


def assert_same(got, want):
    assert [x[:-1] for x in got] == [x[:-1] for x in want]
    assert [x[-1] for x in got] == pytest.approx([x[-1] for x in want], rel=1e-6)


def rounded(rows):
    return sorted((r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6),
                   round(r.score, 6)) for r in rows)


def test_probabilities_after_any_context_add_to_one():
    r = random.Random(2)
    model = PlainPPM([sentence(r, 40).encode() for _ in range(5)], 3)
    for context in (b"\n\n\n", b"abc", b"a b", b"zzz", b"\xff\xff ", b"e a"):
        assert abs(sum(model.probability(context, x) for x in range(256)) - 1) < 1e-12


@pytest.mark.parametrize("order", [1, 4])
def test_scores_are_those_of_explicit_exclusion(spark, order):
    r = random.Random(order)
    rows = [(i, " ".join(sentence(r, r.randint(0, 12)) for _ in range(r.randint(0, 3)))) for i in range(60)]
    rows += [(61, "Ab ab AB é \x01 \x7f"), (62, "unseen ZZZ 的"), (63, "a"), (64, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = ppm_scoring.score_documents(docs, F.expr(HELD_OUT), order, block_bytes=700, bucket_bytes=900)
    assert_same(rounded(got.collect()), plain_scores(rows, order))


def test_scores_of_odd_documents(spark, odd_docs, odd_rows):
    got = ppm_scoring.score_documents(odd_docs, F.expr(HELD_OUT), 2)
    assert_same(rounded(got.collect()), plain_scores([r[:2] for r in odd_rows], 2))


def test_scores_without_training_texts_and_of_an_empty_table(spark, no_docs):
    held = [i for i in range(100) if is_held_out(i)][:2]
    docs = spark.createDataFrame([(held[0], "ab c"), (held[1], None)], "doc_id long, text string")
    got = rounded(ppm_scoring.score_documents(docs, F.expr(HELD_OUT)).collect())
    assert_same(got, plain_scores([(held[0], "ab c"), (held[1], None)], 5))
    assert got[0][-1] == pytest.approx(-5 * math.log10(256), rel=1e-6) and got[0][4:6] == (0, 0)
    assert ppm_scoring.score_documents(no_docs, F.expr(HELD_OUT)).count() == 0
    with pytest.raises(ValueError):
        ppm_scoring.score_documents(docs, F.expr(HELD_OUT), 7)


# ---- operator 12

def plain_runs(s, min_length, min_exponent):
    n, out = len(s), []
    for p in range(1, n // min_exponent + 1):
        i = 0
        while i + p < n:
            if s[i] != s[i + p]:
                i += 1
                continue
            begin = i
            while i + p < n and s[i] == s[i + p]:
                i += 1
            length, w = i + p - begin, s[begin : i + p]
            if length >= min_length and length >= min_exponent * p and \
                    not any(w[q:] == w[:-q] for q in range(1, p)):
                out.append((begin, length, p))
    return sorted(out)


def random_words(r):
    s = [r.randrange(r.choice([1, 2, 3, 30])) for _ in range(r.randint(0, 50))]
    unit = [r.randrange(4) for _ in range(r.randint(1, 12))]
    at = r.randint(0, len(s))
    return [str(x) for x in s[:at] + (unit * 12)[: r.randint(1, 80)] + s[at:]]


def test_runs_of_sequences():
    r = random.Random(12)
    for _ in range(400):
        s = [int(x) for x in random_words(r)]
        for least, exponent in ((2, 2), (6, 3), (24, 3)):
            assert periodic_runs.runs_of(s, least, exponent) == plain_runs(s, least, exponent)
    assert periodic_runs.runs_of([]) == periodic_runs.runs_of([3]) == []


def plain_planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    g = h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def plain_digest(doc_id, text):
    from fractions import Fraction
    from hashlib import sha256

    ws = plain_planted(doc_id, (text or "").encode().split())
    runs = plain_runs(ws, 24, 3)
    best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=None)
    gone = {i for a, n, p in runs for i in range(a + p, a + n)}
    kept = b" ".join(w for i, w in enumerate(ws) if i not in gone)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha256("".join(f"{a},{n},{p}\n" for a, n, p in runs).encode()).hexdigest(), sha256(kept).hexdigest())


def test_runs_of_documents(spark):
    r = random.Random(13)
    rows = [(i, " ".join(random_words(r))) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = periodic_runs.scan(docs, periodic_runs.digest, periodic_runs.DIGEST, periodic_runs.planted)
    assert sorted(map(tuple, got.collect())) == [plain_digest(*x) for x in rows]
    full = {x.doc_id: x for x in periodic_runs.find_runs(docs).collect()}
    for i, text in rows:
        ws = text.encode().split()
        assert [tuple(x) for x in full[i].runs] == plain_runs(ws, 24, 3) and full[i].n_words == len(ws)


def test_runs_in_odd_documents(spark, no_docs):
    tail = " ".join(["x y z"] * 20)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, tail), (4, tail), (None, tail), (None, None), (5, "É é " * 30), (6, "w " * 50_000)]
    docs = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, n_runs int")
    got = periodic_runs.scan(docs, periodic_runs.digest, periodic_runs.DIGEST, periodic_runs.planted)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str(plain_digest(*x)) for x in rows)
    assert periodic_runs.find_runs(no_docs).count() == 0


def test_words_of_a_large_batch_share_trees_without_mixing(monkeypatch):
    monkeypatch.setattr(periodic_runs, "TREE_WORDS", 50)
    r = random.Random(14)
    documents = [[w.encode() for w in random_words(r)] for _ in range(200)]
    assert periodic_runs.runs_in_documents(documents) == [plain_runs(d, 24, 3) for d in documents]


# ---- operator 13

def check_whitened(rows, vectors, k=4):
    """rows: results by vector id; vectors: id -> whole numbers."""
    x = np.array(list(vectors.values()), object)
    fit = np.unique(np.array(x, np.float64), axis=0)
    n, d = fit.shape
    sums = [sum(int(v) for v in c) for c in fit.T]
    a = fit - fit.mean(0)
    values, components = np.linalg.eigh(a.T @ a / n)
    values, components = values[::-1][:k], components[:, ::-1][:, :k]
    by = {}
    for r in rows:
        by.setdefault(r.vec_id, {})[r.component] = r
    assert set(by) == set(vectors) and all(set(c) == set(range(1, min(k, d) + 1)) for c in by.values())
    for j in range(min(k, d)):
        column = [by[i][j + 1] for i in vectors]
        assert {r.n for r in column} == {n}
        assert [r.deviation for r in column] == [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
        total = np.trace(a.T @ a / n)
        if values[j] <= 1e-9 * max(total, 1e-300):
            assert all(r.whitened is None and r.explained == 0 for r in column)
            continue
        assert abs(column[0].explained * total / values[j] - 1) < 1e-9 and column[0].identity_error < 1e-9
        want = (np.array(x, np.float64) - fit.mean(0)) @ components[:, j] / np.sqrt(values[j])
        got = np.array([r.whitened for r in column])
        assert np.abs(got * np.sign(got @ want) - want).max() < 1e-7


def whole(v):
    return [math.floor(256 * float(np.float32(c))) for c in v]


@pytest.mark.parametrize("d", [1, 5, 64])
def test_whitened_components_are_those_of_the_covariance(spark, d):
    g = np.random.default_rng(d)
    m = g.normal(size=(150, d)) * np.linspace(3, 0.2, d)
    rows = [(i, v.tolist()) for i, v in enumerate(np.r_[m, m[:40]])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    check_whitened(qr_whitening.whiten(vectors).collect(), {i: whole(v) for i, v in rows})


def test_whitening_of_odd_vectors(spark):
    g = np.random.default_rng(1)
    nan, inf = float("nan"), float("inf")
    bad = [None, [1.0, None, 2.0], [nan, 0.0, 1.0], [0.0, -inf, 1.0], []]
    good = g.normal(size=(30, 3)).tolist()
    pairs = g.normal(size=(20, 2)).tolist()
    rows = [(i, v, "s", 1.0) for i, v in enumerate(bad + good + pairs)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string, whitened double")
    got = qr_whitening.whiten(vectors).collect()
    by_length = {3: {}, 2: {}}
    for i, v, *_ in rows[len(bad):]:
        by_length[len(v)][i] = [math.floor(256 * c) for c in v]
    for d, of in by_length.items():
        check_whitened([r for r in got if r.d == d], of)
    assert len(got) == 30 * 3 + 20 * 2
    assert qr_whitening.whiten(vectors.where("false")).count() == 0


def test_whitening_without_variance_and_with_dependent_columns(spark):
    one = [(i, [0.5, 1.0]) for i in range(9)]
    got = qr_whitening.whiten(spark.createDataFrame(one, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 18 and all(r.whitened is None and r.explained == 0 and r.n == 1 and r.deviation == 0 for r in got)
    g = np.random.default_rng(5)
    m = g.integers(-500, 500, (80, 2))
    m = np.c_[m, m.sum(1), m[:, 0] * 0 + 7, m[:, 0] * 1000] / 256
    rows = [(i, v.tolist()) for i, v in enumerate(m)]
    got = qr_whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    check_whitened(got, {i: [math.floor(256 * c) for c in v] for i, v in rows})


def test_deviation_beyond_a_long_is_null_and_large_entries_stay(spark):
    rows = [(i, [1e8 * (-1) ** i, float(i)]) for i in range(20)]
    got = qr_whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 40 and all(r.deviation is None for r in got)
    first = {r.vec_id: r.whitened for r in got if r.component == 1}
    assert all(abs(abs(w) - 1) < 1e-6 for w in first.values())


def test_triangular_solve():
    g = np.random.default_rng(0)
    r = np.triu(g.normal(size=(150, 150))) + 20 * np.eye(150)
    a = g.normal(size=(11, 150))
    assert np.abs(qr_whitening.solve_right(a, r) @ r - a).max() < 1e-10


@pytest.mark.parametrize("order", [1, 5, 6])
def test_gram_sums_are_those_of_single_grams(order):
    texts = [b"", b"a", b"ab ab"] + [b"word%d of text %d" % (i % 7, i) for i in range(600)]
    grams, _ = ppm_scoring.distinct_grams(texts, order)
    values = np.linspace(-9, -1, len(grams))
    each = [float(values[np.searchsorted(grams, ppm_scoring.grams_of([t], order)[0])].sum()) for t in texts]
    assert np.allclose(ppm_scoring.gram_sums(texts, order, grams, values), each, rtol=1e-12)


def test_scoring_uses_the_grams_and_words_that_a_block_sent(monkeypatch):
    import pyarrow as pa

    texts = [b"ab ab", b""]
    grams, _ = ppm_scoring.distinct_grams(texts, 2)
    pressed = ppm_scoring.squeezed
    docs = pa.table({"doc_id": pa.array([1, 2], pa.int64()), "held_out": [False, True], "text": [pressed(t) for t in texts]})
    cut = len(grams) // 2
    found = pa.table({"grams": pa.array([pressed(grams[cut:]), None, pressed(grams[:cut])], pa.binary()),
                      "logp": pa.array([pressed(np.full(len(grams) - cut, -1, "<f4")), None, pressed(np.full(cut, -1, "<f4"))], pa.binary()),
                      "words": pa.array([None, pressed(b"ab"), None], pa.binary()),
                      "counts": pa.array([None, pressed(np.array([2], "<i8")), None], pa.binary())})
    monkeypatch.setattr(ppm_scoring, "Block", None)  # grams and words are not listed a second time
    got = ppm_scoring._scorer(2, 2, 1, 1)(docs, found).to_pylist()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["score"]) for r in got] == [(3, 3, 3, -6.0), (1, 1, 3, -1.0)]
