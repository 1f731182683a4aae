"""Operator 13: whitening of embeddings by shifted CholeskyQR.

The entries of a vector become whole numbers x = floor(scale * entry). The fit list is each distinct vector once, n
vectors with exact sums S; its rows, centred, are a tall matrix A. Passes over A orthogonalise its columns::

    G = Q'Q summed over all partitions    (Q = A at first)
    R = Cholesky factor of G              (of G + shift, where G alone may have none: at first, and later if it fails)
    Q <- Q R^-1 by triangular solves      (each task solves its own rows, with one factor after the other)

until Q'Q is the identity to rounding. The factors compose to one R with A = Q R; its singular values s and right
vectors are the components of A, with variances s^2 / n. What Q'Q still differs from the identity (columns that depend
on each other) enters the last step as its square root, so the result stays right.

A task holds one Arrow batch and d x d numbers; Gram matrices travel as d rows and are summed in rounds of ``FAN_IN``
tasks, so the driver sees d rows a pass, whatever the number of vectors. Hot vectors meet combined on the map side.

Vectors that are null or hold null or non-finite entries are dropped. Vectors of different lengths cannot be compared:
each length has a fit of its own, with passes of its own. Empty vectors give no rows. x beyond a long is cut to the
nearest long; ``deviation`` beyond a long is null. Repeated rows are returned as often as they come. Components without
variance (fewer distinct vectors than components, constant vectors) have explained 0 and whitened null and do not enter
``identity_error``. An empty table gives no rows. Input columns other than id and vector are ignored. Signs: the entry
of a component that is greatest in size is positive.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.common import rows_of, written

SCALE, COMPONENTS = 256, 4
#: Passes at most; two or three are enough unless columns depend on each other.
MAX_PASSES = 6
#: Partial matrices that one task sums, and numbers of a batch that are handled at once.
FAN_IN, BLOCK_ENTRIES = 64, 1 << 20
_UNIT = np.finfo(np.float64).eps / 2


@dataclass
class Fit:
    """Components of the vectors of one length."""

    n: int
    sums: list[int]
    components: np.ndarray  # d x k unit columns
    variances: np.ndarray  # k, 0 where there is no direction left
    explained: np.ndarray
    identity_error: float = 0.0

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates of rows of x; NaN for components without variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            out = centred(x, self.n, self.sums) @ self.components / np.sqrt(self.variances)
        out[:, self.variances <= 0] = np.nan
        return out


def _differences(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exact: 64-bit integers if they fit, else Python's."""
    most = float(n) * max(1.0, float(np.abs(x.astype(np.float64)).max(initial=0))) + max(map(abs, sums), default=0)
    if most < 2**62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x minus the mean, each difference rounded once."""
    return (_differences(x, n, sums) / n).astype(np.float64)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n * x - sums)^2, exact; None beyond a long."""
    d = _differences(x, n, sums)
    if d.dtype != object and x.shape[1] * float(np.abs(d).max(initial=0)) ** 2 < 2**62:
        return (d * d).sum(1).tolist()
    exact = [sum(v * v for v in row) for row in d.tolist()]
    return [v if v < 2**63 else None for v in exact]


def solve_right(a: np.ndarray, r: np.ndarray, width: int = 64) -> np.ndarray:
    """Q with Q R = A for upper triangular R, by blocks of columns."""
    q = np.array(a, np.float64)
    for b in range(0, q.shape[1], width):
        e = min(b + width, q.shape[1])
        if b:
            q[:, b:e] -= q[:, :b] @ r[:b, b:e]
        for j in range(b, e):
            if j > b:
                q[:, j] -= q[:, b:j] @ r[b:j, j]
            q[:, j] /= r[j, j]
    return q


def _blocks(batches, d: int):
    """Rows of x in matrices of about BLOCK_ENTRIES numbers."""
    step = max(1, BLOCK_ENTRIES // d)
    for b in batches:
        x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        for i in range(0, len(x), step):
            yield x[i : i + step]


def _summed(vectors: DataFrame, d: int, size: int, rows_from: Callable) -> np.ndarray:
    """Sum over all rows of the ``size`` x ``size`` matrices m'm, m = ``rows_from(x)``."""
    def partial(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        g = np.zeros((size, size))
        for x in _blocks(batches, d):
            m = rows_from(x)
            g += m.T @ m
        part = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array(np.full(size, part, np.int64)), pa.array(np.arange(size)),
                                          pa.array(list(g), pa.list_(pa.float64()))], ["part", "i", "row"])

    def add(key, table):
        import pyarrow as pa

        rows = table.sort_by("part").column("row").combine_chunks().flatten().to_numpy().reshape(-1, size)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "i": pa.array([key[1].as_py()], pa.int64()),
                         "row": pa.array([rows.sum(0)], pa.list_(pa.float64()))})

    schema = "part long, i long, row array<double>"
    sums, parts = vectors.mapInArrow(partial, schema), max(1, vectors.rdd.getNumPartitions())
    while parts > 1:
        sums = sums.withColumn("part", F.expr(f"part div {FAN_IN}")).groupBy("part", "i").applyInArrow(add, schema)
        parts = -(-parts // FAN_IN)
    out = np.zeros((size, size))
    for r in sums.collect():  # a row per dimension
        out[r.i] += r.row
    return out


def _exact_sums(vectors: DataFrame, d: int) -> tuple[int, list[int]]:
    """Rows and the sums of their entries, exact: each entry as high * 2^32 + low."""
    def partial(batches):
        import pyarrow as pa

        n, high, low = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for x in _blocks(batches, d):
            n += len(x)
            high += (x >> 32).sum(0)
            low += (x & 0xFFFFFFFF).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d)), pa.array(np.full(d, n)), pa.array(high), pa.array(low)],
                                         ["i", "n", "high", "low"])

    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "high", "low")]
    rows = vectors.mapInArrow(partial, "i long, n long, high long, low long").groupBy("i").agg(*wide).collect()
    rows = sorted(rows, key=lambda r: r.i)  # a row per dimension
    return (int(rows[0].n), [(int(r.high) << 32) + int(r.low) for r in rows]) if rows else (0, [0] * d)


def factorise(vectors: DataFrame, d: int, n: int, sums: list[int]) -> tuple[list[np.ndarray], np.ndarray]:
    """Triangular factors of the centred rows, in the order of the solves, and the last Q'Q."""
    factors: list[np.ndarray] = []
    while True:
        def q(x, done=tuple(factors)):
            m = centred(x, n, sums)
            for r in done:
                m = solve_right(m, r)
            return m

        g = _summed(vectors, d, d, q)
        g = (g + g.T) / 2
        size = float(np.linalg.norm(g, 2))
        if size == 0 or len(factors) == MAX_PASSES or factors and np.abs(g - np.eye(d)).max() <= 8 * d * _UNIT:
            return factors, g
        shift = 11 * (n * d + d * (d + 1)) * _UNIT * size
        factor = None
        if factors:
            try:
                factor = np.linalg.cholesky(g).T
            except np.linalg.LinAlgError:
                pass
        if factor is None:
            factor = np.linalg.cholesky(g + shift * np.eye(d)).T
        factors.append(factor)


def components(factors: list[np.ndarray], gram: np.ndarray, n: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k first unit components (columns), their variances and shares of the whole variance."""
    d = len(gram)
    whole = np.eye(d)
    for r in factors:
        whole = r @ whole
    values, vectors = np.linalg.eigh(gram)
    root = (np.sqrt(np.maximum(values, 0))[:, None] * vectors.T) @ whole
    _, s, right = np.linalg.svd(root)
    k = min(k, d)
    variances = s[:k] ** 2 / n
    variances[s[:k] <= d * 4 * _UNIT * s[0]] = 0
    out = right[:k].T
    out = out * np.where(out[np.abs(out).argmax(0), np.arange(k)] < 0, -1.0, 1.0)
    total = float((s**2).sum()) / n
    return out, variances, variances / total if total else np.zeros(k)


def fit_length(vectors: DataFrame, d: int, k: int = COMPONENTS) -> Fit:
    """Fit of distinct vectors ``x`` that all have ``d`` entries."""
    n, sums = _exact_sums(vectors, d)
    factors, gram = factorise(vectors, d, n, sums)
    fit = Fit(n, sums, *components(factors, gram, n, k))
    live = np.flatnonzero(fit.variances > 0)
    if len(live):
        m = len(live)
        g = _summed(vectors, d, m + 1, lambda x: np.c_[fit.project(x)[:, live], np.ones(len(x))]) / n
        cov = g[:m, :m] - np.outer(g[:m, m], g[:m, m])
        fit.identity_error = float(np.abs(cov - np.eye(m)).max())
    return fit


def scaled(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = SCALE) -> DataFrame:
    """id, d (entries) and x (whole numbers) of the vectors that have only finite entries, at least one."""
    v = F.col(vec_col)
    bad = F.exists(v, lambda e: e.isNull() | F.isnan(e.cast("double")) | (F.abs(e.cast("double")) == float("inf")))
    rows = vectors.where(v.isNotNull() & (F.size(v) > 0)).where(~bad)
    x = F.transform(v, lambda e: F.floor(F.lit(float(scale)) * e.cast("double")).cast("long"))
    return rows.select(F.col(id_col).alias("id"), F.size(v).alias("d"), x.alias("x"))


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = SCALE,
           k: int = COMPONENTS) -> DataFrame:
    """For each vector and component: id, component (from 1), n, deviation, whitened, explained, identity_error, d."""
    rows = written(scaled(vectors, id_col, vec_col, scale), "scaled")
    distinct = written(rows.select("d", "x").distinct(), "distinct")
    fits = {}
    for r in distinct.groupBy("d").count().collect():  # a row per length
        fits[r.d] = fit_length(distinct.where(F.col("d") == r.d).select("x"), r.d, k)
    shared = vectors.sparkSession.sparkContext.broadcast(fits)  # d * k numbers a length
    kind = vectors.schema[id_col].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for b in batches:
            ids, lengths = b.column("id"), b.column("d").to_numpy()
            for d in np.unique(lengths):
                of, fit = np.flatnonzero(lengths == d), shared.value[int(d)]
                m, step = len(fit.variances), max(1, BLOCK_ENTRIES // int(d))
                for i in range(0, len(of), step):
                    at = of[i : i + step]
                    x = np.array([r[0] for r in rows_of(b.take(pa.array(at)), "x")], np.int64)
                    w = fit.project(x).reshape(-1)
                    each = np.repeat(at, m)
                    deviation = np.array(deviations(x, fit.n, fit.sums), object).repeat(m)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(each)), pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(at))),
                         pa.array(np.full(len(each), fit.n, np.int64)), pa.array(deviation.tolist(), pa.int64()),
                         pa.array(w, pa.float64(), mask=np.isnan(w)), pa.array(np.tile(fit.explained, len(at))),
                         pa.array(np.full(len(each), fit.identity_error)), pa.array(np.full(len(each), d, np.int32))], names)

    names = [id_col, "component", "n", "deviation", "whitened", "explained", "identity_error", "d"]
    return rows.mapInArrow(run, f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, "
                                "explained double, identity_error double, d int")
