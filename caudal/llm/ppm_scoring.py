"""Operator 11: language-model scores by prediction by partial matching (PPM).

The model is a trie of byte contexts of up to ``ORDER`` bytes, learned from the training texts. A text is written as its
words (A-Z in lower case) joined by one space, and an end byte (line feed, which no word holds); contexts before the
text's beginning are end bytes. A byte s after context c has

    (count(c, s) - 1/2) / total(c)          if s followed c in training
    escape(c) * probability after c without its first byte, symbols that followed c excluded
    escape(c) = symbols(c) / 2 / total(c)   (PPM's method D)

down to the empty context, and below it all bytes that are left alike. Counts of the longest contexts are occurrences; those
of shorter ones are the longer contexts in which the byte follows (update exclusion). The symbols of a context are among
those of its shorter contexts, so what exclusion takes away is a sum per context, and the probabilities of all bytes after
a context add to one. ``score`` is the sum of their log10 over a text.

Beside it stands the ``base`` of single words: log10 of (count + 1/2) / (N + (V + 1) / 2) for each word and the end.

How it runs. Texts are dealt into blocks of about ``BLOCK_BYTES`` as they are read. A block sends each of its distinct grams
(context and byte) and words once, with its training count, packed into one row per bucket; a bucket adds up the counts
of all blocks. The trie's levels are tables, made one from the other by grouping; grams that no training text has are looked
up level by level, the longest context first. Each block gets back the grams and words it sent, with one number for each, and
scores its documents; it lists nothing anew. A gram's log10 travels in 4 bytes, so a score is exact to about 1e-7 of its size. Blocks, buckets (their number follows the bytes) and tables are bounded or spread, whatever a source's or
a word's share; every count covers all training texts.

A null id trains. Null, empty and blank texts consist of the end alone. Repeated rows train and are scored as often as they
come. Without training texts all bytes are alike and N = V = 0. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from math import log10

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.common import mix, rows_of, utf8, words_of, written

ORDER = 5
#: Bytes of text in a block (a longer text is a block of its own), and for which a bucket is made.
BLOCK_BYTES, BUCKET_BYTES = 16 << 20, 4 << 20
#: Bytes of text whose grams are listed at once.
_LIST_BYTES = 2 << 20
_END, _SYMBOLS = b"\n", 256
_PARTS = "block long, bucket int, grams binary, gram_n binary, words binary, word_n binary, doc_id long, held_out boolean, text binary"


def grams_of(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams of the texts (words joined by one space, without the end), one after another, and where each text begins.

    A gram is the ``order`` bytes before a byte, and the byte, as a big-endian number. Each text has one more than bytes.
    """
    raw = np.frombuffer(b"".join([_END * order + t + _END for t in texts]), np.uint8)
    starts = np.cumsum([0] + [len(t) + 1 for t in texts])
    n = len(raw) - order
    g = np.zeros(max(n, 0), np.uint64)
    for j in range(order + 1):
        g <<= np.uint64(8)
        g |= raw[j : j + n]
    keep = np.ones(len(g), bool)  # not those that predict the end bytes before a text
    for i, s in enumerate(starts[1:-1].tolist(), 1):
        at = s + (i - 1) * order
        keep[at : at + order] = False
    return g[keep], starts


def distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in ascending order and how often each occurs."""
    if not len(values):
        return values, np.zeros(0, np.int64)
    v = np.sort(values)
    first = np.flatnonzero(np.r_[True, v[1:] != v[:-1]])
    return v[first], np.diff(np.r_[first, len(v)])


def distinct_grams(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of the texts in ascending order, and counts; listed piece by piece."""
    found, held, size = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))], [], 0
    for i, t in enumerate(texts):
        held.append(t)
        size += len(t)
        if size >= _LIST_BYTES or i + 1 == len(texts):
            found.append(distinct(grams_of(held, order)[0]))
            held, size = [], 0
    values, counts = (np.concatenate(x) for x in zip(*found))
    by = np.argsort(values, kind="stable")
    values = values[by]
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]]) if len(values) else np.zeros(0, np.int64)
    return values[first], np.add.reduceat(counts[by], first) if len(values) else counts


def distinct_words(texts: list[bytes]) -> dict[bytes, int]:
    """Distinct words of the texts (words joined by one space), and how often each occurs."""
    import pyarrow as pa
    import pyarrow.compute as pc

    raw = b"".join([t + b" " for t in texts if t])
    at = np.r_[0, np.flatnonzero(np.frombuffer(raw, np.uint8) == ord(" ")) + 1]  # a word goes up to its space
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(raw)])
    found = pc.value_counts(words)
    return dict(zip(b"".join(found.field("values").to_pylist()).split(b" "), found.field("counts").to_pylist()))


def gram_sums(texts: list[bytes], order: int, grams: np.ndarray, values: np.ndarray) -> list[float]:
    """For each text the sum of its grams' values; ``grams`` ascending. Piece by piece the grams are sorted with the number
    of their text in the bits that a gram leaves, so they are looked up in order, each distinct one once."""
    spare = 64 - 8 * (order + 1)
    most, mask = 1 << min(spare, 20), np.uint64((1 << spare) - 1)
    out, held, size = [], [], 0
    for i, t in enumerate(texts):
        held.append(t)
        size += len(t)
        if size >= _LIST_BYTES or len(held) == most or i + 1 == len(texts):
            g, starts = grams_of(held, order)
            g <<= np.uint64(spare)
            g |= np.repeat(np.arange(len(held), dtype=np.uint64), np.diff(starts))
            g.sort()
            of = (g & mask).astype(np.int64)
            g >>= np.uint64(spare)
            new = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
            found = values[np.searchsorted(grams, g[new])]
            out += np.bincount(of, np.repeat(found, np.diff(np.r_[new, len(g)])), len(held)).tolist()
            held, size = [], 0
    return out


def squeezed(values) -> bytes:
    """An array or bytes, compressed."""
    return zlib.compress(values if isinstance(values, bytes) else values.tobytes(), 1)


def unsqueezed(raw: bytes, dtype: str) -> np.ndarray:
    return np.frombuffer(zlib.decompress(raw), dtype)


def gram_buckets(grams: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each gram, one for all grams of a context."""
    return (mix(grams >> np.uint64(8)) % np.uint64(buckets)).astype(np.int64)


class Block:
    """The distinct grams and words of a block's documents (id, held_out, text) and their training counts there, in the
    orders (bucket, gram) and (bucket, word)."""

    def __init__(self, docs: list[tuple], order: int, buckets: int):
        learned, n = distinct_grams([t for _, held, t in docs if not held], order)
        asked, _ = distinct_grams([t for _, held, t in docs if held], order)
        grams = np.union1d(learned, asked)
        counts = np.zeros(len(grams), np.int64)
        counts[np.searchsorted(grams, learned)] = n
        bucket = gram_buckets(grams, buckets)
        by = np.argsort(bucket, kind="stable")
        self.grams, self.gram_n, self.gram_bucket = grams[by], counts[by], bucket[by]
        known = distinct_words([t for _, held, t in docs if not held])
        every = sorted(known.keys() | distinct_words([t for _, held, t in docs if held]).keys())
        bucket = np.fromiter(map(zlib.crc32, every), np.int64, len(every)) % buckets
        order = np.argsort(bucket, kind="stable")
        self.words, self.word_bucket = [every[i] for i in order.tolist()], bucket[order]
        self.word_n = np.fromiter((known.get(w, 0) for w in self.words), np.int64, len(every))

    def rows(self, buckets: int):
        """(bucket, grams, gram_n, words, word_n) of each bucket that holds something."""
        at = np.arange(buckets + 1)
        g, w = np.searchsorted(self.gram_bucket, at), np.searchsorted(self.word_bucket, at)
        for b in np.flatnonzero((np.diff(g) > 0) | (np.diff(w) > 0)).tolist():
            of, ow = slice(g[b], g[b + 1]), slice(w[b], w[b + 1])
            yield (b, squeezed(self.grams[of].astype("<u8")), squeezed(self.gram_n[of].astype("<u4")),
                   squeezed(_END.join(self.words[ow])), squeezed(self.word_n[ow].astype("<u4")))


def _dealer(order: int, buckets: int, block_bytes: int):
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        base, count = TaskContext.get().partitionId() << 33, 0
        kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
        schema = pa.schema([(n, kinds[t]) for n, t in (c.split() for c in _PARTS.split(", "))])

        def out(docs):
            parts = list(Block(docs, order, buckets).rows(buckets))
            for i in range(0, len(parts), 64):
                columns = list(zip(*[(base + count, *p, None, None, None) for p in parts[i : i + 64]]))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
            columns = list(zip(*[(base + count, None, None, None, None, None, i, held, squeezed(t)) for i, held, t in docs]))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        docs, size = [], 0
        for b in batches:
            for doc_id, held_out, text in rows_of(b, "doc_id", "held_out", "text"):
                docs.append((doc_id, held_out, b" ".join(words_of(text))))
                size += len(docs[-1][2]) + 1
                if size >= block_bytes:
                    yield from out(docs)
                    docs, size, count = [], 0, count + 1
        if docs:
            yield from out(docs)

    return run


def _add_grams(key, table):
    """Counts of a bucket's grams over all blocks, and the total of each gram's context."""
    import pyarrow as pa

    g = np.concatenate([unsqueezed(x, "<u8") for x in table["grams"].to_pylist()])
    n = np.concatenate([unsqueezed(x, "<u4") for x in table["gram_n"].to_pylist()])
    order = np.argsort(g, kind="stable")
    g = g[order]
    first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]]) if len(g) else np.zeros(0, np.int64)
    counts = np.add.reduceat(n[order].astype(np.int64), first) if len(g) else np.zeros(0, np.int64)
    g = g[first]
    context = g >> np.uint64(8)
    begin = np.r_[True, context[1:] != context[:-1]] if len(g) else np.zeros(0, bool)
    total = np.add.reduceat(counts, np.flatnonzero(begin))[np.cumsum(begin) - 1] if len(g) else counts
    return pa.table({"bucket": pa.array(np.full(len(g), key[0].as_py(), np.int32)), "g": pa.array(g.astype(np.int64)),
                     "n": pa.array(counts), "total": pa.array(total)})


def _add_words(key, table):
    """For each block of the bucket the counts of its words over all blocks; the first row has the bucket's sums."""
    import pyarrow as pa

    lists = [zlib.decompress(w).split() for w in table["words"].to_pylist()]  # no row holds a word twice
    whole: dict[bytes, int] = {}
    for ws, n in zip(lists, table["word_n"].to_pylist()):
        for w, k in zip(ws, unsqueezed(n, "<u4").tolist()):
            whole[w] = whole.get(w, 0) + k
    sums = [sum(whole.values()), sum(n > 0 for n in whole.values())]
    counts = [squeezed(np.fromiter(map(whole.__getitem__, ws), "<i8", len(ws))) for ws in lists]
    rows, rest = len(lists), [0] * (len(lists) - 1)
    return pa.table({"block": table["block"].cast(pa.int64()), "words": table["words"].cast(pa.binary()),
                     "counts": pa.array(counts, pa.binary()), "n": pa.array([sums[0], *rest], pa.int64()),
                     "v": pa.array([sums[1], *rest], pa.int64())})


def _hand_out(key, known, parts):
    """For each block of the bucket its grams, as it sent them, and their numbers."""
    import pyarrow as pa

    g, value = known["g"].to_numpy(), known["logp"].to_numpy()
    order = np.argsort(g)
    g, value = g[order], value[order]
    out = [squeezed(value[np.searchsorted(g, unsqueezed(x, "<u8").astype(np.int64))].astype("<f4")) for x in parts["grams"].to_pylist()]
    return pa.table({"block": parts["block"].cast(pa.int64()), "grams": parts["grams"].cast(pa.binary()), "logp": pa.array(out, pa.binary())})


def _scorer(order: int, n: int, v: int, trained: int):
    """Scores of a block's documents from its grams and words with their numbers."""
    tokens_n = n + trained
    distinct_n = v + (trained > 0)
    below = log10(tokens_n + 0.5 * (distinct_n + 1))
    end = log10(trained + 0.5) - below

    def run(docs, found):
        import pyarrow as pa

        kinds = (pa.int64(), pa.bool_(), *[pa.int64()] * 3, *[pa.float64()] * 2)
        texts = [zlib.decompress(t) for t in docs["text"].to_pylist()]
        if not texts:
            return pa.table({c: pa.array([], t) for c, t in zip(SCORED, kinds)})

        def numbers(column, dtype):
            return np.concatenate([np.zeros(0, dtype), *[unsqueezed(x, dtype) for x in found[column].to_pylist() if x is not None]])

        grams, logp = numbers("grams", "<u8"), numbers("logp", "<f4")
        by = np.argsort(grams)
        scores = gram_sums(texts, order, grams[by], logp[by].astype(float))
        counts = numbers("counts", "<i8")
        words = [w for x in found["words"].to_pylist() if x is not None for w in zlib.decompress(x).split()]
        base = dict(zip(words, (np.log10(counts + 0.5) - below).tolist()))
        unknown = {w for w, c in zip(words, counts.tolist()) if not c}
        out = []
        for text, score in zip(texts, scores):
            ws = text.split()
            strange = sum(map(unknown.__contains__, ws)) if unknown else 0
            out.append((len(ws) + 1, len(ws) - strange + (trained > 0), tokens_n, float(sum(map(base.__getitem__, ws))) + end, score))
        columns = [docs["doc_id"], docs["held_out"], *zip(*out)]
        return pa.table({c: x.cast(t) if isinstance(x, pa.ChunkedArray) else pa.array(x, t) for c, x, t in zip(SCORED, columns, kinds)})

    return run


SCORED = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def _low(column, size: int):
    """The last ``size`` bytes of a gram or context."""
    return F.col(column).bitwiseAND(F.lit((1 << 8 * size) - 1))


def trie(longest: DataFrame, order: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Levels 0 to ``order`` of the trie from its longest grams (g, n): grams with counts, and contexts.

    A context c has total, up (log10 of its escape, and of the shares left to c by the contexts above), low (log10 of what
    it must be divided by when its parent is read, with the shares). See ``_unseen`` for their use.
    """
    levels = [longest]
    for k in range(order - 1, -1, -1):
        above = levels[0].select(_low("g", k + 1).alias("g"))
        levels.insert(0, written(above.groupBy("g").agg(F.count(F.lit(1)).alias("n")), f"level-{k}"))
    contexts = []
    half = F.col("symbols") / F.lit(2.0)
    for k, level in enumerate(levels):
        c = F.shiftrightunsigned("g", 8).alias("c")
        if k == 0:
            own = level.groupBy(c).agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("symbols"))
            own = own.withColumn("share", F.lit(0.0)).withColumn(
                "low", F.log10(F.greatest(F.lit(_SYMBOLS) - F.col("symbols"), F.lit(1)).cast("double")))
        else:
            parent = levels[k - 1].select(F.col("g").alias("pg"), F.col("n").alias("pn"))
            own = level.join(parent, _low("g", k) == F.col("pg")).groupBy(c).agg(
                F.sum("n").alias("total"), F.count(F.lit(1)).alias("symbols"), F.sum("pn").alias("excluded"))
            above = contexts[-1].select(F.col("c").alias("pc"), F.col("total").alias("ptotal"),
                                        F.col("symbols").alias("psymbols"), F.col("share").alias("pshare"))
            own = own.join(above, _low("c", k - 1) == F.col("pc"))
            left = F.greatest(F.col("ptotal") - F.col("excluded"), F.lit(1)).cast("double")  # 1 only where nothing is left
            more = F.col("psymbols") - F.col("symbols")
            own = own.withColumn("share", F.col("pshare") + F.when(more > 0, F.log10(more / F.lit(2.0) / left)).otherwise(0.0))
            own = own.withColumn("low", F.col("share") + F.log10(left))
        own = own.withColumn("up", F.log10(half / F.col("total")) + F.col("share"))
        contexts.append(written(own.select("c", "total", "symbols", "share", "low", "up"), f"contexts-{k}"))
    return levels, contexts


def _unseen(grams: DataFrame, levels: list[DataFrame], contexts: list[DataFrame]) -> DataFrame:
    """bucket, g, logp of grams that training does not have.

    With c the longest context seen and s found first after its suffix e (d is e with one more byte), the probability is
    escape(c) times the shares left between, times count(e, s) over what d leaves of e: up(c) - low(d) + log10(count - 1/2).
    """
    todo = grams.select("bucket", "g", F.lit(None).cast("double").alias("up"), F.lit(None).cast("double").alias("low"))
    done = []
    for k in range(len(levels) - 1, -1, -1):
        seen = levels[k].select(F.col("g").alias("sg"), F.col("n").alias("sn"))
        context = contexts[k].select(F.col("c").alias("sc"), "total", F.col("up").alias("c_up"), F.col("low").alias("c_low"))
        now = (todo.join(context, F.shiftrightunsigned(_low("g", k + 1), 8) == F.col("sc"), "left")
               .join(seen, _low("g", k + 1) == F.col("sg"), "left"))
        found = F.log10(F.col("sn") - F.lit(0.5))
        logp = F.when(F.col("sn").isNotNull(), F.when(F.col("up").isNull(), found - F.log10(F.col("total").cast("double")))
                      .otherwise(F.col("up") - F.col("low") + found))
        now = written(now.select("bucket", "g", F.coalesce("up", "c_up").alias("up"), F.coalesce("c_low", "low").alias("low"),
                                 logp.alias("logp")), f"lookup-{k}")
        done.append(now.where("logp IS NOT NULL").select("bucket", "g", "logp"))
        todo = now.where("logp IS NULL").select("bucket", "g", "up", "low")
    rest = F.coalesce(F.col("up") - F.col("low"), F.lit(-log10(_SYMBOLS)))
    out = todo.select("bucket", "g", rest.alias("logp"))
    for d in done:
        out = out.unionByName(d)
    return out


def score_documents(docs: DataFrame, held_out, order: int = ORDER, block_bytes: int = BLOCK_BYTES,
                    bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Scores of all documents by a model of those for which the column ``held_out`` is not true.

    Columns: doc_id, held_out, n_tokens (words and the end), n_known (tokens that training has), train_tokens (N),
    base_score and score. ``order`` is 1 to 6: a gram is a long.
    """
    if not 1 <= order <= 6:
        raise ValueError("order must be 1 to 6")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
                       utf8("text").alias("text"))
    whole = rows.agg(F.sum(F.length("text")).alias("bytes"), F.count_if(~F.col("held_out")).alias("trained")).first()
    buckets = max(1, min(-(-(whole["bytes"] or 0) // bucket_bytes), 2**31 - 1))
    parts = written(rows.mapInArrow(_dealer(order, buckets, block_bytes), _PARTS), "blocks")
    sent = parts.where("bucket IS NOT NULL")
    counts = written(sent.select("bucket", "grams", "gram_n").groupBy("bucket")
                     .applyInArrow(_add_grams, "bucket int, g long, n long, total long"), "grams")
    words = written(sent.select("block", "bucket", "words", "word_n").groupBy("bucket")
                    .applyInArrow(_add_words, "block long, words binary, counts binary, n long, v long"), "words")
    sums = words.agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    levels, contexts = trie(counts.where("n > 0").select("g", "n"), order)
    logp = counts.where("n > 0").select("bucket", "g", F.log10((F.col("n") - F.lit(0.5)) / F.col("total")).alias("logp"))
    logp = logp.unionByName(_unseen(counts.where("n = 0"), levels, contexts))
    numbers = logp.groupBy("bucket").cogroup(sent.select("block", "bucket", "grams").groupBy("bucket")).applyInArrow(
        _hand_out, "block long, grams binary, logp binary")
    none = F.lit(None).cast("binary")
    found = numbers.select("block", "grams", "logp", none.alias("words"), none.alias("counts")).union(
        words.select("block", none, none, "words", "counts"))
    texts = parts.where("bucket IS NULL").select("block", "doc_id", "held_out", "text")
    scorer = _scorer(order, int(sums["n"] or 0), int(sums["v"] or 0), int(whole["trained"] or 0))
    return texts.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(
        scorer, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
