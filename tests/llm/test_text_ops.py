"""Operators 2, 4, 5 and 10 against brute force and held-out labels."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from caudal.llm import chunk_dedup, license_scan, mil_toxicity, partenum_join
from caudal.llm.common import WordHash, components, words_of

from .conftest import sentence

HASHES = WordHash()


# ---------------------------------------------------------------- 4: n-gram Jaccard join

def shingles(text):
    w = words_of((text or "").encode())
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def linked_components(rows):
    """Component of each row by comparing all pairs of sets."""
    sets = [shingles(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, *_) in enumerate(rows):
        if sets[i]:
            least.setdefault(find(i), []).append(d)
    out = Counter()
    for i, (d, *_) in enumerate(rows):
        ids = [x for x in least.get(find(i), [d]) if x is not None] if sets[i] else [d]
        out[d, len(sets[i]), min(ids, default=None)] += 1
    return out


def edited(r, text, share):
    words = text.split()
    for _ in range(max(1, int(len(words) * share))):
        at = r.randrange(len(words))
        words[at : at + r.randint(0, 1)] = [sentence(r, 1)]
    return " ".join(words)


def near_copies(seed=1, groups=25):
    r, rows = random.Random(seed), []
    common = sentence(r, 40)
    for _ in range(groups):
        base = sentence(r, r.choice([6, 8, 10, 14, 20, 50, 150, 400]))
        if r.random() < 0.4:
            base += " " + common
        rows += [base] + [edited(r, base, r.choice([0.005, 0.01, 0.02, 0.03, 0.05])) for _ in range(r.randint(0, 8))]
    r.shuffle(rows)
    return [(i, t, "s") for i, t in enumerate(rows)]


@pytest.mark.parametrize("most", [0.05, 4])
def test_jaccard_components_match_all_pairs(spark, monkeypatch, most):
    monkeypatch.setattr(partenum_join, "PAIRS_PER_NODE", most)  # few: forests and more rounds
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in partenum_join.jaccard_groups(docs).collect())
    assert got == linked_components(rows)
    kept = partenum_join.one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in got})


def test_jaccard_of_odd_and_empty_tables(odd_docs, odd_rows, no_docs):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in partenum_join.jaccard_groups(odd_docs).collect())
    assert got == linked_components(odd_rows)
    kept = partenum_join.one_per_group(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids == Counter({1: 1, 3: 1, 4: 1, 5: 1, 6: 1, 7: 1, 9: 1, None: 1, 10: 2})
    assert partenum_join.jaccard_groups(no_docs).count() == 0 and partenum_join.one_per_group(no_docs).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.integers(4, 700), st.integers(0, 2**32), st.booleans())
def test_linked_sets_share_a_signature(n, seed, hot):
    rng = np.random.default_rng(seed)
    sketch = rng.integers(0, 1000 if hot else 2, 1 << partenum_join.SKETCH_BITS).astype(float)
    union = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
    lost = math.floor(len(union) * 0.2)  # |intersection| / |union| stays at 0.8 or more
    out = rng.permutation(len(union))[:lost]
    cut = rng.integers(0, lost + 1)
    a, b = np.delete(union, out[:cut]), np.delete(union, out[cut:])
    if len(a) == len(b) == len(union):
        return
    sa, sb = (partenum_join.signatures(s, sketch, max(1.0, sketch.mean())) for s in (a, b))
    assert len(np.intersect1d(sa, sb))


def test_linked_sets_of_all_small_sizes_share_a_signature():
    rng = np.random.default_rng(7)
    sketch = rng.integers(0, 3, 1 << partenum_join.SKETCH_BITS).astype(float)
    for a in range(4, 41):
        for b in range(a, 41):
            both = math.ceil(80 * (a + b) / 180)  # the least intersection that links
            if both > a or a == b == both:
                continue
            for _ in range(5):
                union = rng.integers(0, 2**64, a + b - both, dtype=np.uint64)
                sa, sb = (partenum_join.signatures(np.sort(s), sketch, 1.0) for s in (union[:a], union[a - both :]))
                assert len(np.intersect1d(sa, sb)), (a, b)


def test_a_word_appended_across_size_bands_links(spark):
    text = sentence(random.Random(12), 19)  # 15 shingles, then 16
    docs = spark.createDataFrame([(1, text), (2, text + " more")], "doc_id long, text string")
    assert {r.component_id for r in partenum_join.jaccard_groups(docs).collect()} == {1}


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components(links).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}


# ---------------------------------------------------------------- 2: substring dedup

def dedup_by_hand(rows, min_run=chunk_dedup.MIN_RUN):
    """Text of each (id, text): a chunk of words is a repeat unless it is the first of its words."""
    docs = sorted({(2**63 - 1 if d is None else d, t or "") for d, t, *_ in rows})
    chunks, first = {}, {}
    for doc in docs:
        words = words_of(doc[1].encode())
        cuts = chunk_dedup.cut_points(HASHES.of(words)) if words else []
        chunks[doc] = [(a, b, tuple(words[a:b])) for a, b in zip([0, *cuts], cuts)]
        for i, (_, _, w) in enumerate(chunks[doc]):
            first.setdefault(w, (doc, i))
    out = {}
    for doc in docs:
        keep = [True] * (chunks[doc][-1][1] if chunks[doc] else 0)
        run = []
        for i, (a, b, w) in enumerate([*chunks[doc], (0, 0, None)]):
            if w is not None and first[w] != (doc, i):
                run.append((a, b))
                continue
            if run and run[-1][1] - run[0][0] >= min_run:
                keep[run[0][0] : run[-1][1]] = [False] * (run[-1][1] - run[0][0])
            run = []
        out[doc] = [w for w, k in zip(doc[1].split(), keep) if k]
    return out


def test_passages_are_cut_like_by_hand(spark, odd_docs, odd_rows, no_docs):
    r = random.Random(8)
    passages = [sentence(r, 51) for _ in range(20)]
    rows = [(i, f"{sentence(r, r.randint(20, 200))} {passages[i % 20]} {sentence(r, r.randint(20, 200))}", "s") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = {x.doc_id: x for x in chunk_dedup.deduplicate_substrings(docs).collect()}
    want = dedup_by_hand(rows)
    for d, t, _ in rows:
        assert got[d].text.split() == want[d, t]
        assert (got[d].removed_words > 0) == (d >= 20)  # all but the first document of each passage
        assert got[d].n_words == len(t.split()) == got[d].removed_words + len(want[d, t])
    got = chunk_dedup.deduplicate_substrings(odd_docs)
    assert set(odd_docs.columns) - {"n_words"} <= set(got.columns)
    want = dedup_by_hand(odd_rows)
    out = Counter((x.doc_id, None if x.text is None else tuple(x.text.split())) for x in got.collect())
    assert out == Counter((d, None if t is None else tuple(want[2**63 - 1 if d is None else d, t])) for d, t, _ in odd_rows)
    assert chunk_dedup.deduplicate_substrings(no_docs).count() == 0


def test_copies_and_stock_phrases(spark):
    r = random.Random(9)
    whole, phrase = sentence(r, 90), sentence(r, 9)
    rows = [(1, whole), (2, whole), (2, whole)] + [(i, f"{sentence(r, 60)} {phrase} {sentence(r, 60)}") for i in range(3, 30)]
    got = chunk_dedup.deduplicate_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((x.doc_id, x.text) for x in got) == sorted([(1, whole), (2, ""), (2, "")] + rows[3:])


def test_a_repeat_within_a_document(spark):
    r = random.Random(10)
    passage = sentence(r, 80)
    docs = spark.createDataFrame([(1, f"{passage} {sentence(r, 30)} {passage}")], "doc_id long, text string")
    got = chunk_dedup.deduplicate_substrings(docs).first()
    assert got.text.startswith(passage) and 60 <= got.removed_words <= 80


def test_cuts_fall_back_into_step():
    words = np.random.default_rng(1).integers(0, 2**63, 500).astype(np.uint64)
    a = set(chunk_dedup.cut_points(words))
    b = {c - 3 for c in chunk_dedup.cut_points(np.r_[words[:100], words[:3], words[100:]])}
    assert {c for c in a if c > 140} == {c for c in b if c > 140}
    lengths = np.diff([0, *sorted(a)])
    assert lengths[:-1].min() >= chunk_dedup.MIN_WORDS and lengths.max() <= chunk_dedup.MAX_WORDS


# ---------------------------------------------------------------- 5: toxicity

def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    model = mil_toxicity.fit(docs, mil_toxicity.trainable(labels))
    rows = mil_toxicity.score_documents(docs, model, ["doc_id"]).join(labels, "doc_id").where(mil_toxicity.held_out("doc_id")).collect()
    hit = Counter((r.toxic, r.predicted) for r in rows)
    # one label in twenty has nothing in its text that would explain it, and few toxic documents are not English
    assert hit[1, 0] <= 0.15 * (hit[1, 0] + hit[1, 1]) and hit[0, 1] <= 0.03 * (hit[0, 0] + hit[0, 1])


def test_toxicity_is_noisy_or_over_sentences_and_locates_them():
    r = random.Random(2)
    bags = []
    for i in range(200):
        ss = [sentence(r, 12) for _ in range(6)]
        if i % 2:
            ss[r.randrange(6)] += " scoundrel"
        bags.append(([s.encode() for s in ss], i % 2))
    model = mil_toxicity.train(bags)
    scorer = mil_toxicity.Scorer(model)
    text = "Fine words here. What a Scoundrel! Other words."
    score, n, worst, worst_score = scorer.score(text.encode())
    z = scorer.sentence_logits(text.encode())
    assert n == 3 and worst == 1 and worst_score > 0.9
    assert score == pytest.approx(1 - np.prod(1 - 1 / (1 + np.exp(-z))))
    assert scorer.score(b"Fine words here. Other words.")[0] < 0.1
    assert scorer.score(b"") == (0.0, 0, None, None)


def test_toxicity_of_odd_and_empty_tables(spark, odd_docs, odd_rows, no_docs):
    model = {"bias": -5.0, "weights": {b"tail": 9.0}}
    out = mil_toxicity.score_documents(odd_docs, model)
    rows = out.collect()
    assert set(odd_docs.columns) <= set(out.columns) and len(rows) == len(odd_rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert [r.doc_id for r in rows if r.predicted] == [11]
    assert mil_toxicity.score_documents(no_docs, model).count() == 0
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 0), (2, 0)], "doc_id long, toxic int")
    assert mil_toxicity.fit(odd_docs, labels)["weights"] == {}
    assert mil_toxicity.fit(no_docs, labels.where("false"))["weights"] == {}


# ---------------------------------------------------------------- 10: license scans

def scan_by_hand(text, texts, containment=license_scan.CONTAINMENT):
    """Templates that a window of their class holds, without MinHash."""
    hashes, found = license_scan.LicenseWords(), set()
    s, _ = license_scan.document_shingles((text or "").encode(), hashes)
    for name, t in texts.items():
        want = set(license_scan.document_shingles(t.encode(), hashes)[0].tolist())
        size = license_scan.window_class(len(want))
        for at in range(0, len(s), max(1, size // 2)):
            if len(want & set(s[at : at + size].tolist())) >= containment * len(want) - 1e-9:
                found.add(name)
    return found


def test_licenses_match_brute_force(spark, odd_docs, no_docs):
    r, rows = random.Random(4), []
    names = list(license_scan.TEMPLATES)
    for i in range(150):
        notice = license_scan.TEMPLATES[r.choice(names)].split()
        for _ in range(r.choice([0, 0, 0, 1, 2])):
            notice[r.randrange(len(notice))] = sentence(r, 1)
        if r.random() < 0.3:
            notice = [w.upper() + r.choice([",", "", "!"]) for w in notice]
        rows.append((i, f"{sentence(r, r.randint(0, 300))} {' '.join(notice)} {sentence(r, r.randint(0, 300))}" if i % 3 else sentence(r, 200)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = license_scan.scan_licenses(docs).collect()
    assert Counter((x.doc_id, x.template) for x in got) == Counter((i, t) for i, text in rows for t in scan_by_hand(text, license_scan.TEMPLATES))
    texts = dict(rows)
    for x in got:
        inside = license_scan.document_shingles(" ".join(texts[x.doc_id].split()[x.start : x.stop]).encode(), license_scan.LicenseWords())[0]
        want = np.unique(license_scan.document_shingles(license_scan.TEMPLATES[x.template].encode(), license_scan.LicenseWords())[0])
        assert x.containment == pytest.approx(len(np.intersect1d(inside, want)) / len(want)) and x.containment >= 0.8
    assert license_scan.scan_licenses(odd_docs).count() == 0 == license_scan.scan_licenses(no_docs).count()


def test_every_copy_of_a_repeated_notice_is_listed(spark):
    r, rows, want = random.Random(14), [], Counter()
    for i, (name, t) in enumerate(license_scan.TEMPLATES.items()):
        n, words = len(t.split()), []
        for gap in (30, 0, 1, 7, n, 200):  # copies side by side, near and far
            words += sentence(r, gap).split()
            want[i, name, len(words), len(words) + n] += 1
            words += t.split()
        rows.append((i, " ".join(words)))
    got = license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    names = list(license_scan.TEMPLATES)
    assert Counter((x.doc_id, x.template, x.start, x.stop) for x in got if x.template == names[x.doc_id]) == want
    assert {x.containment for x in got if x.template == names[x.doc_id]} == {1.0}


def test_bands_make_misses_rare():
    for n in range(1, 300):
        size = license_scan.window_class(n)
        shared = math.ceil(0.8 * n - 1e-9)
        j = shared / (size + n - shared)
        bands = license_scan.bands_for(n, size)
        assert size >= n and (bands == 256 or (1 - j) ** bands <= license_scan.MISS)
        for at in range(size):  # a copy lies whole in some window
            assert any(p <= at and at + n <= p + size for p in range(0, 2 * size, max(1, size // 2)))


def test_short_templates_are_refused(no_docs):
    with pytest.raises(ValueError):
        license_scan.scan_licenses(no_docs, {"x": "too few words"})


def test_labels_without_documents_take_no_place_in_the_sample(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(40)], "doc_id long, text string")
    labels = spark.range(5_000).select((F.col("id") - 20).alias("doc_id"), (F.col("id") % 2).cast("int").alias("toxic"))
    got = mil_toxicity.training_sample(docs, labels, per_label=15).collect()
    assert sorted(r.toxic for r in got) == [0] * 10 + [0] * 5 + [1] * 15


def test_bands_have_no_cap():
    few, many = license_scan.bands_for(100, 128), license_scan.bands_for(100, 128, 0.05)
    assert few < 256 < many
    shared = 5
    assert (1 - shared / (128 + 100 - shared)) ** many <= license_scan.MISS * 1.0001
