"""Operator 5: toxicity by multiple-instance learning.

A document is a bag of sentences; only the bag has a label. A sentence has the probability
``sigmoid(bias + sum of its features' weights)``, and a document is toxic unless each sentence is clean
(noisy-or)::

    p(document) = 1 - product over sentences (1 - p(sentence))

The weights maximise the likelihood of the document labels. They score single sentences too, so the sentences
that make a document toxic are located without any sentence label.

Features of a sentence: its distinct words (runs of letters, A-Z in lower case) and the words' first 4, 5 and 6
letters, so inflected forms share a weight. Only features of at least ``MIN_DOCS`` training documents count. Weights
are not negative (a polite word does not undo an insult); an L1 penalty chooses the features, whose weights are then
fitted without it.

Training uses a sample of at most ``MAX_PER_LABEL`` labelled documents per label, those with the smallest seeded
hash of doc_id; one task reads it text by text and keeps its sentences as numbered features (4 bytes each). Scoring reads every document whole; the
model is broadcast and has at most ``MAX_FEATURES`` weights.

Null, empty and wordless texts have no sentence and score 0. Rows with a null label or id are not trained on.
Contradicting labels of one id count once each. Without labels of both kinds every score is 0.
An empty table gives no rows.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.common import kept_by_worker, slices_of, utf8

#: Bounds of the training sample (documents of each label) and of the model.
MAX_PER_LABEL = 1500
MAX_FEATURES = 20_000
MIN_DOCS = 5
PREFIXES = (4, 5, 6)
EPOCHS, RATE, L1, L2 = 300, 0.3, 7e-4, 1e-5
SEED = 5

_SENTENCE = re.compile(rb"[.!?\n]+")
_WORD = re.compile(rb"[a-z\x80-\xff]+")


def sentences(text: bytes) -> list[bytes]:
    """Sentences that have a word, A-Z in lower case."""
    return [s for s in _SENTENCE.split(text.lower()) if _WORD.search(s)]


def _features(sentence: bytes) -> set[bytes]:
    words = set(_WORD.findall(sentence))
    out = set(words)
    for w in words:
        s = w.decode("utf-8", "ignore")
        for n in PREFIXES:
            if len(s) >= n:
                out.add(s[:n].encode() + b"*")
    return out


class Bags:
    """Documents of the training sample as sets of numbered features, one array a sentence."""

    def __init__(self):
        self.number: dict[bytes, int] = {}
        self.seen: list[list[int]] = []  # documents of label 0 and 1 that have the feature
        self.sentences: list[np.ndarray] = []
        self.bag_of: list[int] = []
        self.labels: list[int] = []

    def add(self, bag: list[bytes], label: int) -> None:
        """A document by its sentences."""
        every = set()
        for s in bag:
            known = {self.number.setdefault(f, len(self.number)) for f in _features(s)}
            self.sentences.append(np.fromiter(known, np.int32, len(known)))
            self.bag_of.append(len(self.labels))
            every |= known
        self.seen += [[0, 0] for _ in range(len(self.number) - len(self.seen))]
        for f in every:
            self.seen[f][label] += 1
        self.labels.append(label)


def train(bags: list[tuple[list[bytes], int]]) -> dict:
    """``train_bags`` of (sentences, label) pairs."""
    held = Bags()
    for bag, y in bags:
        held.add(bag, y)
    return train_bags(held)


def train_bags(bags: Bags) -> dict:
    """Weights from labelled bags: ``{"bias": float, "weights": {feature: float}}``.

    The noisy-or likelihood is maximised with the two labels weighted to equal halves.
    """
    labels = np.array(bags.labels, np.float64)
    if not len(labels) or labels.min() == labels.max():
        return {"bias": -np.inf, "weights": {}}
    total = np.bincount(bags.labels, minlength=2)
    lift = {f: abs(a / total[0] - b / total[1]) for f, (a, b) in zip(bags.number, bags.seen) if a + b >= MIN_DOCS}
    names = sorted(lift, key=lambda f: (-lift[f], f))[:MAX_FEATURES]
    index = np.full(len(bags.number), -1, np.int32)
    index[[bags.number[f] for f in names]] = np.arange(len(names), dtype=np.int32)
    # sentences as flat (sentence, feature) pairs; a sentence without a known feature counts by its bag's size only
    known = [np.sort(k[k >= 0]) for k in (index[s] for s in bags.sentences)]
    sizes = np.array([len(k) for k in known], np.int64)
    cols = np.concatenate([*known, np.zeros(0, np.int32)])
    rows = np.repeat(np.arange(np.count_nonzero(sizes)), sizes[sizes > 0])
    every = np.array(bags.bag_of, np.int64)
    bag_of = every[sizes > 0]
    blank = np.bincount(every[sizes == 0], minlength=len(labels)).astype(np.float64)
    weight = np.where(labels > 0, 0.5 / total[1], 0.5 / total[0])
    theta = _ascend(rows, cols, bag_of, blank, labels, weight, np.r_[np.zeros(len(names)), -5.0], L1, 0.0)
    # the penalty chooses the features; their weights are then fitted without it
    chosen = np.flatnonzero(theta[:-1] > 1e-3)
    place = np.full(len(names), -1)
    place[chosen] = np.arange(len(chosen))
    used = place[cols] >= 0 if len(cols) else np.zeros(0, bool)
    theta = _ascend(rows[used], place[cols[used]], bag_of, blank, labels, weight, theta[np.r_[chosen, len(names)]], 0.0, L2)
    keep = {names[i]: float(w) for i, w in zip(chosen, theta[:-1]) if w > 0}
    return {"bias": float(theta[-1]), "weights": keep}


def _ascend(rows, cols, bag_of, blank, labels, weight, theta, l1: float, l2: float) -> np.ndarray:
    """Full-batch Adam on the noisy-or likelihood; the last of ``theta`` is the bias, the others stay at 0 or above."""
    n, m, v = len(theta) - 1, np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, EPOCHS + 1):
        z = np.bincount(rows, theta[cols], len(bag_of)) + theta[-1]
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        p0 = 1 / (1 + np.exp(-np.clip(theta[-1], -30, 30)))
        # log of the probability that every sentence is clean
        clean = np.bincount(bag_of, np.log1p(-np.minimum(p, 1 - 1e-12)), len(labels)) + blank * np.log1p(-p0)
        doc = np.clip(-np.expm1(clean), 1e-9, 1)
        # d(log likelihood)/d(z of a sentence): -p if clean, p (1 - doc) / doc if toxic
        pull = weight * np.where(labels > 0, (1 - doc) / doc, -1.0)
        by_sentence = pull[bag_of] * p
        grad = np.zeros_like(theta)
        grad[:-1] = np.bincount(cols, by_sentence[rows], n) - l1 - l2 * theta[:-1]
        grad[-1] = by_sentence.sum() + (pull * blank).sum() * p0
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        theta = theta + RATE * (1 - step / (EPOCHS + 1)) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        np.maximum(theta[:-1], 0, out=theta[:-1])
    return theta


class Scorer:
    """Scores of sentences and documents by a trained model."""

    def __init__(self, model: dict, limit: int = 300_000):
        self.bias, self.weights, self.limit = model["bias"], model["weights"], limit
        self.words: dict[bytes, tuple] = {}  # word -> its (feature, weight) pairs; most words have none

    def _of(self, word: bytes) -> tuple:
        if len(self.words) >= self.limit:
            self.words.clear()
        s = word.decode("utf-8", "ignore")
        names = [word] + [s[:n].encode() + b"*" for n in PREFIXES if len(s) >= n]
        self.words[word] = out = tuple((f, self.weights[f]) for f in names if f in self.weights)
        return out

    def sentence_logits(self, text: bytes) -> np.ndarray:
        get, out = self.words.get, []
        for sentence in _SENTENCE.split(text.lower()):
            words = _WORD.findall(sentence)
            if words:
                known = {}
                for w in words:
                    pairs = get(w)
                    if pairs is None:
                        pairs = self._of(w)
                    if pairs:
                        known.update(pairs)
                out.append(self.bias + sum(known[f] for f in sorted(known)) if known else self.bias)
        return np.array(out, np.float64)

    def score(self, text: bytes) -> tuple[float, int, int | None, float | None]:
        """Probability that the text is toxic, its sentences, and the worst one's place and probability."""
        z = self.sentence_logits(text)
        if not len(z) or not np.isfinite(self.bias):
            return 0.0, len(z), None, None
        z = np.clip(z, -700, 700)
        clean = -np.logaddexp(0, z).sum()
        worst = int(z.argmax())
        return float(-np.expm1(clean)), len(z), worst, float(1 / (1 + np.exp(-z[worst])))


def training_sample(docs: DataFrame, labels: DataFrame, per_label: int = MAX_PER_LABEL, seed: int = SEED) -> DataFrame:
    """At most ``per_label`` labelled documents of each label: text (UTF-8), toxic.

    Labels count only where the document exists: ids meet first, the bound is set on what is left, and only then are the
    texts fetched. Rows in ``labels`` without a document, however many, take no place in the sample.
    """
    ids = F.col("doc_id").cast("long").alias("doc_id")
    toxic = (labels.select(ids, F.col("toxic").cast("int").alias("toxic"))
             .where("doc_id IS NOT NULL AND toxic IN (0, 1)").distinct()
             .join(docs.select(ids), "doc_id", "left_semi")
             .withColumn("_order", F.xxhash64(F.lit(seed), "doc_id")))
    picked = [toxic.where(F.col("toxic") == y).orderBy("_order", "doc_id").limit(per_label) for y in (0, 1)]
    picked = F.broadcast(picked[0].union(picked[1]).select("doc_id", "toxic", "_order"))  # 2 * per_label rows at most
    rows = docs.select(ids, utf8("text").alias("text")).join(picked, "doc_id")
    # repeated rows of one id add nothing; one text of each (id, label) is enough
    return rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).orderBy("doc_id", "toxic").select("text", "toxic")


def trainable(labels: DataFrame) -> DataFrame:
    """Label rows outside the held-out fifth (crc32 of the id's text, modulo 5)."""
    return labels.where(~held_out("doc_id"))


def held_out(col: str):
    return F.coalesce(F.crc32(F.col(col).cast("long").cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, per_label: int = MAX_PER_LABEL) -> dict:
    """Model from a bounded sample of labelled documents; training runs in one task, the model comes back."""
    import pickle

    def run(batches):
        import pyarrow as pa

        kept_by_worker("toxicity", dict)  # nothing stays from other work
        bags = Bags()
        for b in batches:
            for i in range(b.num_rows):  # one text at a time
                bags.add(sentences(b.column("text")[i].as_py()), b.column("toxic")[i].as_py())
        yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(train_bags(bags))], pa.binary())})

    sample = training_sample(docs, labels, per_label).coalesce(1)
    row = sample.mapInArrow(run, "model binary").first()  # none if the sample has no partition
    return pickle.loads(bytes(row["model"])) if row else train_bags(Bags())


def score_documents(docs: DataFrame, model: dict, carry: list[str] | None = None) -> DataFrame:
    """Columns of ``docs`` (all, or those in ``carry``) with score, predicted, n_sentences, worst_sentence (its place
    from 0 among sentences that have a word) and worst_score. A kept column named like an added one gives way."""
    carry = [c for c in (docs.columns if carry is None else carry) if c not in SCORED]
    fields = [docs.schema[c] for c in carry]
    names = [f"_in_{i}" for i in range(len(fields))]
    once = "text" in carry and docs.schema["text"].dataType.typeName() == "string"
    text = names[carry.index("text")] if once else "_text"
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(carry, names)], *([] if once else [utf8("text").alias("_text")]))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        kept_by_worker("toxicity", dict)  # nothing stays from other work
        scorer = Scorer(shared.value)
        for b in (part for batch in batches for part in slices_of(batch)):
            found = [scorer.score(t or b"") for t in b.column(text).cast(pa.binary()).to_pylist()]
            score, n, worst, worst_score = zip(*found) if found else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(x) for x in names] + [pa.array(score, pa.float64()), pa.array([int(x >= 0.5) for x in score], pa.int32()),
                                                pa.array(n, pa.int32()), pa.array(worst, pa.int32()), pa.array(worst_score, pa.float64())],
                names + list(SCORED))

    from pyspark.sql import types as T

    schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, fields)]
                          + [T.StructField(c, t) for c, t in zip(SCORED, (T.DoubleType(), T.IntegerType(), T.IntegerType(), T.IntegerType(), T.DoubleType()))])
    out = rows.mapInArrow(run, schema)
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, carry)], *SCORED)


SCORED = ("score", "predicted", "n_sentences", "worst_sentence", "worst_score")
