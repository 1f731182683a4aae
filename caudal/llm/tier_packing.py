"""Operator 8: hierarchical multi-length packing.

Context sizes are tiers: powers of two up to the window (2048, 1024, ...). A document gives whole windows
first; what is left is routed to the smallest tier that holds it. Tiers are packed from long to short. A
window takes the longest remainder of its tier, and the gap is filled from shorter tiers, longest fitting
first; if nothing fits, the shortest longer remainder is cut to the gap and its rest is routed anew. So every
sequence is exactly as long as its tier and needs no padding; the few ids left at a partition's end make
sequences of smaller powers of two.

Sequences of one pool are then dealt to step groups of about ``step_tokens`` ids: largest first, each to the
group with the fewest ids.

Each input partition is packed by one task from a bounded pool of remainders, without a shuffle; whatever
share of rows one source or group of copies has, it lies over as many tasks as the input has partitions. A lost
task repeats the same partition and gives the same rows; ids of sequences carry the partition's number.

Null texts are empty, and every document ends with the end id, so each has at least one piece. Repeated rows are
documents of their own. An empty table gives no rows. Input columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import bisect
import heapq
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm import tokens
from caudal.llm.common import rows_of, utf8

WINDOW = 2048
#: Context sizes, long to short. Remainders of the last tier or shorter share windows of it.
TIERS = (2048, 1024, 512, 256)
#: Remainders that are packed together, and ids in a step group.
POOL = 4096
STEP_TOKENS = 64 * WINDOW
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, tier int, step long")


class Pool:
    """Remainders sorted by length: take the longest up to a size, or the shortest above it."""

    def __init__(self):
        self.keys: list[tuple[int, int]] = []  # (length, serial)
        self.rows: dict[int, tuple] = {}
        self.serial = 0

    def add(self, row: tuple) -> None:
        bisect.insort(self.keys, (len(row[2]), self.serial))
        self.rows[self.serial] = row
        self.serial += 1

    def longest(self, most: int) -> tuple | None:
        i = bisect.bisect_left(self.keys, (most + 1, -1))
        return self.rows.pop(self.keys.pop(i - 1)[1]) if i else None

    def shortest(self, least: int) -> tuple | None:
        i = bisect.bisect_left(self.keys, (least, -1))
        return self.rows.pop(self.keys.pop(i)[1]) if i < len(self.keys) else None


def fill(pool: Pool, tiers=TIERS):
    """Pack the pool's remainders into full sequences (tier, pieces); what fills none stays in the pool.

    A remainder is (doc_id, start, ids, doc_tokens), ids a non-empty array.
    """
    for at, size in enumerate(tiers):
        floor = tiers[at + 1] if at + 1 < len(tiers) else 0
        while (first := pool.longest(size)) is not None:
            if len(first[2]) <= floor:  # the tier is packed
                pool.add(first)
                break
            pieces, gap = [first], size - len(first[2])
            while gap:
                if (fits := pool.longest(gap)) is None:
                    if (over := pool.shortest(gap + 1)) is None:
                        break
                    doc, start, ids, n = over
                    pool.add((doc, start + gap, ids[gap:], n))
                    fits = (doc, start, ids[:gap], n)
                pieces.append(fits)
                gap -= len(fits[2])
            if gap:
                for p in pieces:
                    pool.add(p)
                return
            yield size, pieces


def drain(pool: Pool, window: int):
    """The last remainders, one after another, in sequences of powers of two: none is padded."""
    left = sum(n for n, _ in pool.keys)
    rest = None
    while left:
        size = gap = min(window, 1 << (left.bit_length() - 1))
        pieces = []
        while gap:
            doc, start, ids, n = rest or pool.longest(window)
            pieces.append((doc, start, ids[:gap], n))
            rest = (doc, start + gap, ids[gap:], n) if len(ids) > gap else None
            gap -= len(pieces[-1][2])
        left -= size
        yield size, pieces


def step_groups(sizes: list[int], step_tokens: int) -> list[int]:
    """For each sequence the group it goes to: as many groups as the ids need, loads near equal."""
    loads = [(0, g) for g in range(max(1, -(-sum(sizes) // step_tokens)))]
    out = [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        load, g = loads[0]
        out[i] = g
        heapq.heapreplace(loads, (load + sizes[i], g))
    return out


def _packer(path: str, end_id: int, window: int, tiers: tuple, pool_size: int, step_tokens: int):
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        base = TaskContext.get().partitionId() << 33
        encoder, end = tokens.Encoder.of_worker(path), np.array([end_id], "<u4").tobytes()
        pool, ready, count = Pool(), [], [0, 0]  # sequences and step groups so far
        fields = [x.split() for x in PIECES.split(", ")]
        schema = pa.schema([(n, pa.int32() if t == "int" else pa.int64()) for n, t in fields])

        def out():
            rows = [[] for _ in fields]
            groups = step_groups([size for size, _ in ready], step_tokens)
            for (size, pieces), group in zip(ready, groups):
                offset = 0
                for doc, start, ids, n in pieces:
                    for column, v in zip(rows, (doc, start, len(ids), zlib.crc32(ids.tobytes()), n,
                                                base + count[0], offset, size, base + count[1] + group)):
                        column.append(v)
                    offset += len(ids)
                count[0] += 1
            count[1] += max(groups, default=-1) + 1
            ready.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema)], schema=schema)

        rows = (r for b in batches for r in rows_of(b, "doc_id", "text"))
        for some in tokens.batches(rows, lambda r: r[1]):
            for (doc, _), raw in zip(some, encoder.encode([t for _, t in some])):
                ids = np.frombuffer(raw + end, "<u4")
                n = len(ids)
                whole = n - n % window
                ready.extend((window, [(doc, i, ids[i : i + window], n)]) for i in range(0, whole, window))
                if whole < n:
                    pool.add((doc, whole, ids[whole:], n))
            if len(pool.keys) >= pool_size:
                ready.extend(fill(pool, tiers))
            if len(ready) >= pool_size:
                yield out()
        ready.extend(fill(pool, tiers))
        ready.extend(drain(pool, window))
        if ready:
            yield out()

    return run


def pack_documents(docs: DataFrame, tokenizer_file: str, end_id: int = tokens.END_ID, window: int = WINDOW,
                   tiers: tuple = TIERS, pool_size: int = POOL, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """A row per piece: where it lies in its document and in its sequence, and the sequence's tier and step.

    ``window`` and ``tiers`` are powers of two, tiers descending from the window.
    """
    if any(t & (t - 1) for t in tiers) or tiers[0] != window or list(tiers) != sorted(set(tiers), reverse=True):
        raise ValueError("tiers must be descending powers of two that begin with the window")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text"))
    return rows.mapInArrow(_packer(tokenizer_file, end_id, window, tuple(tiers), pool_size, step_tokens), PIECES)
