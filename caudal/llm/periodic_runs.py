"""Operator 12: periodic runs of words, by suffix-tree longest common extensions.

A run is a stretch of words with smallest period q (words q apart are equal) that no neighbouring word extends. Every
run has a Lyndon root for one of the two orders of the alphabet, and the root is the longest Lyndon word at its start:
it ends at the next suffix that is smaller (or, in the other order, greater). So two candidates a position are enough.
Each is extended to the right by the longest common extension (LCE) of its two copies, and to the left by that of the
reversed text::

    rank, turns = order of the leaves of Ukkonen's tree, depth where the Euler tour turns between two leaves
    LCE(i, j)   = depth of the lowest common ancestor = least turn between the leaves of i and j

The tour's least depth between two leaves is read from a sparse table in constant time, for all candidates at once.

Before that, words outside any stretch of repeated k-word sequences are set aside: in a run of length at least three
periods and ``min_length``, each k words occur again one period further on or back, so no run is lost. The stretches of a
batch of documents share one pair of trees, parted by symbols that occur once; a tree takes about 700 bytes a word. Each
text is searched whole, in the task that reads it, without a shuffle.

Words are ``[^\\x20\\x09-\\x0D]+``, compared as they are. Null, empty and blank texts have no word and no run. Repeated rows
are documents of their own; an empty table gives no rows. Columns that are not named in ``carry`` are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.common import mix, rows_of, utf8

MIN_LENGTH, MIN_EXPONENT = 24, 3
#: Words of documents, and of stretches, that are searched together.
BATCH_WORDS, TREE_WORDS = 400_000, 100_000
_P = 0x9E3779B97F4A7C15

Run = tuple[int, int, int]  # start, length, period


class Numbers(dict):
    """word -> number in order of first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def leaves(s: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the leaf order of the suffix tree of ``s`` and the depth at which the Euler tour turns before each.

    The last symbol of ``s`` occurs once and is the least. Children are visited by symbol, so the order is that of the suffixes.
    """
    n = len(s)
    start, end, link, suffix, kids = [0], [0], [0], [-1], [{}]
    node = edge = length = todo = 0
    for i, c in enumerate(s):
        todo += 1
        last = -1
        while todo:
            if not length:
                edge = i
            below = kids[node]
            child = below.get(s[edge])
            if child is None:
                below[s[edge]] = len(start)
                start.append(i)
                end.append(n)
                link.append(0)
                suffix.append(i - todo + 1)
                kids.append(None)
                if last >= 0:
                    link[last] = node
                    last = -1
            else:
                at = start[child]
                span = (end[child] if end[child] <= i else i + 1) - at
                if length >= span:
                    node, length, edge = child, length - span, edge + span
                    continue
                if s[at + length] == c:
                    length += 1
                    if last >= 0:
                        link[last] = node
                    break
                split = len(start)
                below[s[edge]] = split
                start += (at, i)
                end += (at + length, n)
                link += (0, 0)
                suffix += (-1, i - todo + 1)
                kids += ({c: split + 1, s[at + length]: child}, None)
                start[child] = at + length
                if last >= 0:
                    link[last] = split
                last = split
            todo -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - todo + 1
    order, turns = [], []
    stack = [(0, 0, 0)]  # node, its depth, depth of the tour's turn before its first leaf
    while stack:
        node, depth, turn = stack.pop()
        below = kids[node]
        if below is None:
            order.append(suffix[node])
            turns.append(turn)
            continue
        symbols = sorted(below, reverse=True)
        first = symbols.pop()
        for c in symbols:
            child = below[c]
            stack.append((child, depth + end[child] - start[child], depth))
        child = below[first]
        stack.append((child, depth + end[child] - start[child], turn))
    return np.array(order, np.int64), np.array(turns, np.int32)


class Extensions:
    """``lce(i, j)``: words that the suffixes at i and j (arrays, i != j) have in common at their beginnings."""

    def __init__(self, s: list[int]):
        order, turns = leaves(s)
        self.rank = np.empty(len(s), np.int64)
        self.rank[order] = np.arange(len(s))
        self.least = [turns]
        while 2 << (len(self.least) - 1) <= len(s):
            low, step = self.least[-1], 1 << (len(self.least) - 1)
            self.least.append(np.minimum(low[:-step], low[step:]))

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        a, b = self.rank[i], self.rank[j]
        low, high = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.zeros(len(a), np.int64)
        for k in np.unique(level):
            of = np.flatnonzero(level == k)
            out[of] = np.minimum(self.least[k][low[of]], self.least[k][high[of] - (1 << int(k))])
        return out


def _next_less(rank: list[int]) -> list[int]:
    """For each place the next one of smaller rank; the number of places if there is none."""
    out, open_ = [len(rank)] * len(rank), []
    for i, r in enumerate(rank):
        while open_ and rank[open_[-1]] > r:
            out[open_.pop()] = i
        open_.append(i)
    return out


def runs_of(symbols: list[int], min_length: int = 2, min_exponent: int = 2) -> list[Run]:
    """Runs (start, length, period) of a sequence of numbers >= 0, by start and period.

    Length is at least ``min_length`` and ``min_exponent`` (2 or more) periods.
    """
    if len(symbols) < 2:
        return []
    n = len(symbols)
    s = [x + 1 for x in symbols]
    forward, backward = Extensions([*s, 0]), Extensions([*s[::-1], 0])
    rank = forward.rank[:n]
    i = np.arange(n)
    found = []
    for order in (rank, -rank):
        j = np.array(_next_less(order.tolist()), np.int64)
        a, b = i[j < n], j[j < n]
        right = forward.lce(a, b)
        left = np.zeros(len(a), np.int64)
        some = np.flatnonzero(a > 0)
        left[some] = backward.lce(n - a[some], n - b[some])  # of the words before a and before b
        period, length = b - a, b - a + left + right
        keep = (length >= min_exponent * period) & (length >= min_length)
        found.append(np.stack([a - left, length, period], 1)[keep])
    both = np.unique(np.concatenate(found), axis=0)
    return [tuple(r) for r in both[np.lexsort((both[:, 2], both[:, 0]))].tolist()]


def _stretches(ids: np.ndarray, starts: np.ndarray, width: int, least: int) -> np.ndarray:
    """(begin, end) of the stretches, at least ``least`` words long, whose ``width``-word sequences all occur twice in
    their document; documents begin at ``starts`` (its last entry is the end)."""
    n = len(ids)
    none = np.zeros((0, 2), np.int64)
    if n < max(width, least):
        return none
    h, done, power = ids.astype(np.uint64) + np.uint64(1), 1, _P
    while done < width:  # widths double; the last step overlaps
        step = min(done, width - done)
        h = h[: len(h) - step] * np.uint64(power) + h[step:]
        done, power = done + step, power * _P % 2**64
    lengths = np.diff(starts)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    inside = (np.arange(n) + width <= starts[1:][doc])[: len(h)]
    h = mix(h + doc[: len(h)].astype(np.uint64) * np.uint64(_P))
    ordered = np.sort(h[inside])
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return none
    twice = twice[np.r_[True, twice[1:] != twice[:-1]]]
    at = np.searchsorted(twice, h)
    again = inside & (twice[np.minimum(at, len(twice) - 1)] == h)
    # neighbouring sequences of one document make a stretch
    edge = np.diff(np.r_[False, again, False].astype(np.int8))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) + width - 1
    found = np.stack([begin, end], 1)
    return found[end - begin >= least]


def runs_in_documents(documents: list[list[bytes]], min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> list[list[Run]]:
    """Runs of each document (its words), by start and period."""
    numbers = Numbers()
    starts = np.cumsum([0] + [len(d) for d in documents])
    ids = np.fromiter(map(numbers.__getitem__, chain.from_iterable(documents)), np.int64, int(starts[-1]))
    out: list[list[Run]] = [[] for _ in documents]
    # a sequence of `width` words in a run occurs again in it a period away: length >= 2 periods + width - 1
    width = max(1, min(8, (min_length + 5) // 3)) if min_exponent >= 3 else 1
    held: list[tuple[int, int]] = []
    size = 0

    def search():
        symbols, places = [], []
        for k, (begin, end) in enumerate(held):
            symbols += [*ids[begin:end].tolist(), len(numbers) + k]  # a symbol that occurs once parts the stretches
            places.append(len(symbols))
        for start, length, period in runs_of(symbols, min_length, min_exponent):
            k = int(np.searchsorted(places, start, "right"))
            at = held[k][0] + start - (places[k - 1] if k else 0)
            doc = int(np.searchsorted(starts, at, "right")) - 1
            out[doc].append((at - int(starts[doc]), length, period))

    for begin, end in _stretches(ids, starts, width, max(min_length, 2)).tolist():
        held.append((begin, end))
        size += end - begin
        if size >= TREE_WORDS:
            search()
            held, size = [], 0
    if held:
        search()
    return out


def strongest(runs: list[Run]) -> Run | None:
    """The run of greatest length over period (compared exactly); the first, then the one of smaller period, in a tie."""
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def kept_words(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run holds after its first period."""
    gone = sorted((start + period, start + length) for start, length, period in runs)
    out, at = [], 0
    for begin, end in gone:
        if begin > at:
            out += words[at:begin]
        at = max(at, end)
    return out + words[at:]


def scan(docs: DataFrame, summarise: Callable, schema: str, words: Callable | None = None, carry: tuple = ("doc_id",),
         min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """``summarise(words, runs)`` of every document, a tuple of values for the columns of ``schema``, after those of ``carry``.

    ``words(row, words)`` may replace a document's words before the search; row holds the values of ``carry``.
    """
    from pyspark.sql import types as T

    kinds = T._parse_datatype_string(schema)
    fields = [T.StructField(f"_in_{i}", docs.schema[c].dataType) for i, c in enumerate(carry)]
    out_type = T.StructType([*fields, *kinds.fields])
    rows = docs.select(*[F.col(f"`{c}`").alias(f.name) for c, f in zip(carry, fields)], utf8("text").alias("_text"))
    names = [f.name for f in fields]

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(out_type)

        def done(held):
            found = runs_in_documents([ws for _, ws in held], min_length, min_exponent)
            each = [(*row, *summarise(ws, runs)) for (row, ws), runs in zip(held, found)]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*each), arrow)], schema=arrow)

        held, size = [], 0
        for b in batches:
            for *row, text in rows_of(b, *names, "_text"):
                ws = text.split()
                if words is not None:
                    ws = words(row, ws)
                held.append((row, ws))
                size += len(ws)
                if size >= BATCH_WORDS or len(held) >= 10_000:
                    yield done(held)
                    held, size = [], 0
        if held:
            yield done(held)

    found = rows.mapInArrow(run, out_type)
    return found.select(*[F.col(n).alias(c) for n, c in zip(names, carry)], *[f.name for f in kinds.fields])


def find_runs(docs: DataFrame, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """doc_id, n_words, runs (start, length, period) and the text without what repeats (``collapsed``)."""
    def summarise(ws, runs):
        return len(ws), [{"start": a, "length": b, "period": c} for a, b, c in runs], b" ".join(kept_words(ws, runs)).decode()

    return scan(docs, summarise, "n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string",
                min_length=min_length, min_exponent=min_exponent)


def planted(row: list, words: list[bytes]) -> list[bytes]:
    """The words of a document whose tail repeats: with h = crc32 of the id's digits, every tenth document by h.

    From word a = g % n on (g = h // 10) the words repeat with period 1 + (n - a) // (3 + g % 8). A null id plants nothing.
    """
    import zlib

    n = len(words)
    if row[0] is None or not n:
        return words
    g, tenth = divmod(zlib.crc32(str(row[0]).encode()), 10)
    if tenth:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    times, rest = divmod(n - a, p)
    unit = words[a : a + p]
    return words[:a] + unit * times + unit[:rest]


def digest(words: list[bytes], runs: list[Run]) -> tuple:
    """n_runs; start, length, period and exponent_milli of the strongest run; sha256 of the runs and of the kept words."""
    from hashlib import sha256

    best = strongest(runs) or (None, None, None)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    listed = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
    return (len(runs), *best, milli, sha256(listed.encode()).hexdigest(), sha256(b" ".join(kept_words(words, runs))).hexdigest())


DIGEST = ("n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
          "collapsed_sha256 string")
