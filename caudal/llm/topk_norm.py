"""Operator 6: exact top-k inner products over norm-sorted blocks.

Vectors become integers, floor(scale * component), so scores are exact. They are rotated by the singular vectors of
the whole table (from a Gram matrix of dimension squared, summed by Spark), which gathers their length in the
first components. Rows are dealt to groups, sorted by falling length and cut into blocks.

Each query has a floor: its k-th best score among the ``HEAD_ROWS`` longest rows. Then a block of queries meets each
block of rows once:

* the pair is skipped if its longest query and row cannot reach the lowest floor or k-th best so far (length times length, Cauchy-Schwarz);
* otherwise rows are taken in falling length; the rotated partial sum plus the product of the residual lengths bounds
  each score, and only rows whose bound reaches the query's k-th best so far get the exact integer product.

A partial result is k rows per query and task; a window keeps the k best, ties to the smaller id.

Vectors meet in a grid of cells, a task each: a row goes to one of the groups, a query to all of them. A task keeps the rows of
its cell, ``CELL_BYTES`` or so, in integers of as few bytes as hold them, and the queries stream past; pairs of blocks exist only
inside it. So what moves grows with rows and queries, not with their pairs. Where the shuffle partitions ask for more tasks,
queries are dealt out too, to ``COPIES`` sets at most, and each set gets the rows.

Products of blocks whose entries are too large for exact doubles are formed from 64-bit integers, or Python's beyond those.
Scaled components and scores beyond a long are cut to the nearest long; scores so cut
come first, in no order among themselves. Vectors have products with those of their own length only: each
length is searched by itself, with passes of its own.

Vectors that are null, empty or hold null or non-finite components take no
part, nor do rows with a null id. Rows that repeat an id are rows of their own; a query's own id is no candidate.
A query id that repeats is asked once, with its least vector. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caudal.llm.common import written

#: Rows and queries in a block, rows that are bounded at once, rows that give the floors, least groups of rows.
ROW_BLOCK, QUERY_BLOCK, STRIPE, HEAD_ROWS, GROUPS = 2048, 512, 1024, 2048, 48
#: Bytes of the rows of a group, components of the queries that a task has at once, most sets of queries.
CELL_BYTES, AT_ONCE, COPIES = 2**26, 2**23, 4
#: Share of the summed squares that the leading rotated components hold.
ENERGY = 0.9
#: floor: of a query; whole: the integers, in as few bytes each as hold them all.
VECTOR = "vec_id long, length double, floor double, whole binary"
WIDTHS = (1, 2, 4, 8)
NONE = -(2**63)
#: Share of the product of two lengths below which rounding of doubles stays.
ROUNDING = 1e-13
#: Products of vectors whose lengths' product is below have sums that floats hold exactly.
SINGLE = 2**24 * (1 - 1e-6)


def integer_vectors(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, d (length), v (array of long) of the vectors that take part."""
    x = F.col("embedding")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), x.cast("array<double>").alias("x")).where(
        "vec_id IS NOT NULL AND x IS NOT NULL AND size(x) > 0")
    rows = rows.where(F.forall("x", lambda c: c.isNotNull() & (F.abs(c) < float("inf"))))  # nor is NaN below it
    return rows.select("vec_id", F.size("x").alias("d"), F.transform("x", lambda c: F.floor(c * scale)).alias("v"))


def _matrix(column) -> np.ndarray:
    """An Arrow list column of equal lengths as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def rotation(rows: DataFrame) -> tuple[np.ndarray, int]:
    """Right singular vectors of the table, by falling singular value, and how many hold ENERGY of the squares: all where
    that takes over half of them, since a loose bound would then cost more than the rest of the sum."""
    def gram(batches):
        import pyarrow as pa

        total = None
        for b in batches:
            if b.num_rows:
                m = _matrix(b.column("v")).astype(np.float64)
                total = m.T @ m if total is None else total + m.T @ m
        if total is not None:
            i, j = np.divmod(np.arange(total.size), len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.reshape(-1))], ["i", "j", "x"])

    cells = (rows.select("v").mapInArrow(gram, "i long, j long, x double").groupBy("i", "j")
             .agg(F.sum("x").alias("x")).toPandas())  # dimension squared rows
    if not len(cells):
        return np.zeros((0, 0)), 0
    d = int(cells["i"].max()) + 1
    m = np.zeros((d, d))
    m[cells["i"], cells["j"]] = cells["x"]
    values, vectors = np.linalg.eigh((m + m.T) / 2)
    values, vectors = np.maximum(values[::-1], 0), vectors[:, ::-1]
    part = np.cumsum(values) / max(values.sum(), 1e-300)
    lead = int(np.searchsorted(part, ENERGY)) + 1
    return np.ascontiguousarray(vectors), lead if 2 * lead <= d else d


def _floors(k: int, head: tuple, ids: np.ndarray, m: np.ndarray) -> np.ndarray:
    """At most the k-th best score of each vector among the head rows, its own id left out."""
    head_ids, head_rows = head
    if len(head_ids) <= k:
        return np.full(len(ids), -np.inf)
    x = m.astype(np.float64)
    scores = x @ head_rows.T
    scores[ids[:, None] == head_ids[None, :]] = -np.inf
    slack = ROUNDING * np.sqrt((x**2).sum(1) * (head_rows**2).sum(1).max())
    return -np.partition(-scores, k - 1, axis=1)[:, k - 1] - slack


def _exact(a: np.ndarray, b: np.ndarray, single: bool) -> np.ndarray:
    """Products of the rows of two integer matrices as 64-bit integers, cut to their range; ``single``: floats hold their sums."""
    if single:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    most = float(np.abs(a.astype(np.float64)).max(initial=0)) * float(np.abs(b.astype(np.float64)).max(initial=0)) * a.shape[1]
    if most < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < 2**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    whole = a.astype(object) @ b.astype(object).T
    return np.clip(whole, NONE + 1, 2**63 - 1).astype(np.int64)


def _packed(k: int = 0, head: tuple | None = None):
    """Vectors as integers of few bytes, with their lengths; with a head also the queries' floors."""
    def run(batches):
        import pyarrow as pa

        def out(ids, m):
            x = m.astype(np.float64)
            length, floors = np.sqrt((x**2).sum(1)), _floors(k, head, ids, m) if head else np.zeros(len(ids))
            low, high, left = m.min(1), m.max(1), np.ones(len(ids), bool)
            for width in WIDTHS:
                fit = left & (low >= np.iinfo(f"i{width}").min) & (high <= np.iinfo(f"i{width}").max)
                left &= ~fit
                if fit.any():
                    ends = np.arange(fit.sum() + 1, dtype=np.int32) * (width * m.shape[1])
                    whole = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(m[fit].astype(f"<i{width}"))])
                    yield pa.RecordBatch.from_arrays([pa.array(ids[fit]), pa.array(length[fit]), pa.array(floors[fit]), whole], ["vec_id", "length", "floor", "whole"])

        for b in batches:
            for at in range(0, b.num_rows, QUERY_BLOCK):
                part = b.slice(at, QUERY_BLOCK)
                yield from out(part.column("vec_id").to_numpy(), _matrix(part.column("v")))

    return run


def _best(k: int, kept: np.ndarray, kept_ids: np.ndarray, of: np.ndarray, scores: np.ndarray, ids: np.ndarray):
    """The k best of what each row has kept and of further scores, ``of`` their rows; ties to smaller ids: (scores, ids)."""
    n = len(kept)
    of = np.concatenate([np.repeat(np.arange(n), k), of])
    scores, ids = np.concatenate([kept.reshape(-1), scores]), np.concatenate([kept_ids.reshape(-1), ids])
    order = np.lexsort((ids, ~scores, of))  # ~x falls as x rises and cannot overflow
    take = order[np.searchsorted(of[order], np.arange(n))[:, None] + np.arange(k)]
    return scores[take], ids[take]


class _Block:
    """Vectors of an Arrow batch: ids, lengths, floors, integers, and on demand what bounds their products."""

    def __init__(self, batch, d: int, turn: np.ndarray, lead: int):
        self.turn, self.lead, self.kept = turn, lead, {}
        self.ids, self.length, self.floors = (batch.column(c).to_numpy().copy() for c in ("vec_id", "length", "floor"))  # views would hold the batch
        self.top = float(self.length.max())
        packed = batch.column("whole").to_pylist()
        width = np.fromiter(map(len, packed), np.int64, len(packed)) // d
        self.whole = np.empty((len(packed), d), f"<i{width.max()}")
        for w in np.unique(width):
            at = np.flatnonzero(width == w)
            self.whole[at] = np.frombuffer(b"".join(packed[i] for i in at), f"<i{w}").reshape(-1, d)

    def parts(self, kind) -> np.ndarray:
        """Leading rotated components, the length of the others, and what a product adds for the rounding of ``kind``."""
        r = self.whole.astype(np.float64) @ self.turn
        slack = np.sqrt(1e-6 + (self.lead + 4) * 2.0**-23)
        return np.column_stack([r[:, : self.lead], np.sqrt((r[:, self.lead :] ** 2).sum(1)), slack * self.length]).astype(kind)

    def kept_parts(self, kind) -> np.ndarray:
        if kind not in self.kept:
            self.kept[kind] = self.parts(kind)
        return self.kept[kind]


class _Queries:
    """A block of queries and their k best rows so far."""

    def __init__(self, k: int, block: _Block):
        self.k, self.block = k, block
        n = len(block.ids)
        self.scores, self.best = np.full((n, k), NONE, np.int64), np.full((n, k), -1, np.int64)
        self.least = block.floors - 1  # what a row's bound must reach

    def may_meet(self, rows: _Block) -> bool:
        return rows.top * self.block.top * 1.000001 + 0.000001 >= self.least.min()

    def kind(self, rows: _Block):
        return np.float32 if rows.top * self.block.top < SINGLE else np.float64

    def meet(self, rows: _Block, parts: np.ndarray) -> None:
        mine = self.block.kept_parts(parts.dtype.type)
        for at in range(0, len(rows.ids), STRIPE):
            cut = slice(at, at + STRIPE)
            bound = mine @ parts[cut].T
            least = np.minimum(self.least, 2.0**25).astype(bound.dtype) if bound.dtype == np.float32 else self.least
            asked = np.flatnonzero(bound.max(1) >= least)
            if not len(asked):
                continue
            at_query, at_row = np.divmod(np.flatnonzero(bound[asked] >= least[asked][:, None]), bound.shape[1])
            cols, place = np.unique(at_row, return_inverse=True)
            exact = _exact(self.block.whole[asked], rows.whole[cut][cols], bound.dtype == np.float32)[at_query, place]
            there, at_query = rows.ids[cut][at_row], asked[at_query]
            kth, last = self.scores[at_query, -1], self.best[at_query, -1]
            better = ((exact > kth) | ((exact == kth) & (there < last))) & (there != self.block.ids[at_query])
            if not better.any():
                continue
            asked, of = np.unique(at_query[better], return_inverse=True)
            self.scores[asked], self.best[asked] = _best(self.k, self.scores[asked], self.best[asked], of, exact[better], there[better])
            kth = np.where(self.scores[asked, -1] == NONE, -np.inf, self.scores[asked, -1].astype(np.float64))
            self.least[asked] = np.maximum(self.block.floors[asked], kth) - 1


def _search(k: int, d: int, turn: np.ndarray, lead: int):
    """Rows of a cell by falling length, then its queries, to the k best rows of each query among them."""
    def run(batches):
        import pyarrow as pa

        def out(q):
            kept = (q.scores > NONE).reshape(-1)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(q.block.ids, k)[kept]), pa.array(q.best.reshape(-1)[kept]), pa.array(q.scores.reshape(-1)[kept])], ["query_id", "vec_id", "score"])

        def blocks(part, size):
            return [_Block(part.slice(at, size), d, turn, lead) for at in range(0, part.num_rows, size)]

        def answers(part, rows):
            queries = [_Queries(k, b) for b in blocks(part, QUERY_BLOCK)]
            for r in rows:
                parts = {}  # of one block of rows at a time
                for q in queries:
                    if q.may_meet(r):
                        kind = q.kind(r)
                        if kind not in parts:
                            parts[kind] = r.parts(kind)
                        q.meet(r, parts[kind])
            return map(out, queries)

        now, rows, at_once = None, [], max(QUERY_BLOCK, AT_ONCE // d)
        for b in batches:
            place = np.column_stack([b.column("cell").to_numpy(), b.column("asked").to_numpy(zero_copy_only=False)])
            ends = [0, *(np.flatnonzero((place[1:] != place[:-1]).any(1)) + 1), b.num_rows]
            for start, end in zip(ends, ends[1:]):
                if start == end:
                    continue
                part = b.slice(start, end - start)
                if place[start, 0] != now:
                    now, rows = place[start, 0], []
                if not place[start, 1]:
                    rows += blocks(part, ROW_BLOCK)
                    continue
                for at in range(0, part.num_rows, at_once):
                    yield from answers(part.slice(at, at_once), rows)

    return run


def top_inner_products(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, groups: int = GROUPS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of each query's k best rows among all ``vectors`` but its own id.

    ``queries`` has a column vec_id: the rows of ``vectors`` to ask for.
    """
    spark = vectors.sparkSession
    every = written(integer_vectors(vectors, scale), "vectors")
    # in a product, components only need their sizes: doubles
    every = every.withColumn("length", F.aggregate("v", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double")))
    asked = queries.select(F.col("vec_id").cast("long").alias("vec_id")).distinct()
    out = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    least, most = F.array_min("v"), F.array_max("v")
    width = F.lit(8)
    for w in (4, 2):
        width = F.when((least >= -(2 ** (8 * w - 1))) & (most < 2 ** (8 * w - 1)), w).otherwise(width)
    for r in every.groupBy("d").agg(F.sum(F.col("d") * width + 16).alias("size")).collect():  # a row per length
        out = out.unionByName(_of_one_length(every.where(F.col("d") == r.d).drop("d"), asked, k, r.d, max(groups, -(-r["size"] // CELL_BYTES))))
    return out


def _of_one_length(rows: DataFrame, asked: DataFrame, k: int, d: int, groups: int) -> DataFrame:
    """``top_inner_products`` among vectors of length ``d``."""
    spark = rows.sparkSession
    turn, lead = rotation(rows)
    top = rows.orderBy(F.desc("length"), "vec_id").limit(HEAD_ROWS).select("vec_id", "v").collect()  # HEAD_ROWS rows
    head = (np.array([r[0] for r in top], np.int64), np.array([r[1] for r in top], np.float64))
    across = max(1, min(COPIES, int(spark.conf.get("spark.sql.shuffle.partitions")) // groups))  # sets of queries

    asked = rows.join(asked, "vec_id", "left_semi").groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = written(asked.mapInArrow(_packed(k, head), VECTOR), "queries")
    rows = rows.select("vec_id", "v").mapInArrow(_packed(), VECTOR)

    def dealt(n):
        return F.pmod(F.xxhash64("vec_id", "whole"), F.lit(n)).cast("int")

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def cells(vectors, group, share, queries):
        vectors = vectors.select("*", group.alias("g")).select("*", share.alias("h"))
        return vectors.select((F.col("g") * across + F.col("h")).alias("cell"), F.lit(queries).alias("asked"), "vec_id", "length", "floor", "whole")

    met = cells(rows, dealt(groups), every(across), False).unionByName(cells(asked, every(groups), dealt(across), True))
    met = met.repartitionById(groups * across, "cell").sortWithinPartitions("cell", "asked", F.desc("length"), "vec_id")
    found = met.mapInArrow(_search(k, d, turn, lead), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
