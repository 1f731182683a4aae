"""Operator 7: embedding near-duplicates by spherical-cap filters.

Unit vectors are turned by a fixed random rotation and cut into ``PARTS`` parts. Each part has a code of random unit
directions; a filter is one direction of each part, so few directions make very many structured filters. A vector goes
to every filter whose inner product with it exceeds a threshold (a spherical cap): list decoding adds the
parts' best sums branch by branch and never looks at all filters. Vectors of cosine 0.98 or more lie in nearly the same
caps, and meet in a filter; vectors of other directions hardly do. A vector with fewer than ``LEAST`` caps takes its
``LEAST`` best filters, so none is missed for lying between caps. The threshold is set by a seeded simulation: it falls until
``MEET`` of pairs at the least cosine share a filter. Short vectors have fewer parts, and no more directions than leave such
pairs in common caps.

Meeting vectors of one label are verified by their cosine in double precision. A pair that meets in several filters is
counted in the first filter that both have. Vectors equal in every component and label are one class, compared once and
counted with their number.

A filter's members are salted into slices of about ``SLICE`` rows; each pair of slices is a task of its own, so neither a
hot filter nor a class of copies meets in one task, and pairs are counted in matrices of slices, never emitted: a task
returns a count per vector and as few links as connect its members.

Vectors of each length have filters and cells of their own: vectors of different lengths have no cosine. Null, zero,
empty and non-finite vectors and null labels link with nothing. Null ids take no part in links and get a null component. Rows that repeat an id with the same vector and label are rows of
their own that link (cosine 1); component_id is the smallest id reached. An empty table gives no rows.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.common import components, rows_of, written

COSINE = 0.98
#: Parts of a vector at most (of PART_DIMS dimensions or more), directions per part: parts to the power of it filters.
#: Expected and least caps of a vector.
PARTS, PART_DIMS, DIRECTIONS, CAPS, LEAST = 4, 8, 32, 24, 12
#: Directions of a part at most, by the number of parts; a part's scores are a row of so many products.
MOST_DIRECTIONS = {1: 8192, 2: 4096, 3: 1024, 4: 512}
#: Share of simulated pairs at the least cosine that must meet; share of a cap that such a pair has in common (one part).
MEET, OVERLAP = 0.98, 0.4
SLICE = 1000
SEED = 20


class Filters:
    """Random product code over vectors of a dimension."""

    def __init__(self, dim: int, parts: int | None = None, directions: int = DIRECTIONS, caps: int = CAPS, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.dim, self.directions = dim, directions
        self.parts = parts_of(dim) if parts is None else min(parts, dim)
        self.turn = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        self.cuts = [dim * i // self.parts for i in range(self.parts + 1)]
        self.codes = []
        for a, b in zip(self.cuts, self.cuts[1:]):
            code = rng.normal(size=(directions, b - a))
            self.codes.append(code / np.linalg.norm(code, axis=1, keepdims=True) / math.sqrt(self.parts))
        filters = directions**self.parts
        #: inner products with a random filter are close to normal with variance 1 / dim; see ``calibrate``
        self.threshold = min(NormalDist().inv_cdf(1 - min(0.5, caps / filters)) / math.sqrt(dim), 0.999)

    @classmethod
    def for_table(cls, dim: int, classes: int, cosine: float = COSINE) -> Filters:
        """Filters for so many different vectors: more of them as vectors grow, so a filter's members do not."""
        parts = parts_of(dim)
        most = MOST_DIRECTIONS[parts]
        if parts == 1:
            most = min(most, _caps_that_overlap(dim, cosine))
        filters = cls(dim, directions=min(most, max(DIRECTIONS, math.ceil((classes * CAPS) ** (1 / parts)))))
        filters.classes, filters.cosine = classes, cosine
        filters.calibrate(cosine)
        return filters

    def calibrate(self, cosine: float, pairs: int = 400, seed: int = SEED + 1) -> None:
        """Lower the threshold until MEET of simulated pairs at ``cosine`` meet in a filter."""
        rng = np.random.default_rng(seed)
        a, b = (rng.normal(size=(pairs, self.dim)) for _ in range(2))
        a /= np.linalg.norm(a, axis=1, keepdims=True)
        b -= a * (a * b).sum(1, keepdims=True)
        b /= np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-300)
        b = a if self.dim == 1 else cosine * a + math.sqrt(max(0.0, 1 - cosine**2)) * b
        while True:
            met = [len(np.intersect1d(x, y, True)) > 0 for x, y in zip(self.decode(a), self.decode(b))]
            if np.mean(met) >= MEET or self.threshold <= 0:
                return
            self.threshold -= 0.1 / math.sqrt(self.dim)

    def decode(self, unit: np.ndarray, least: int = LEAST) -> list[np.ndarray]:
        """For each unit vector the filters above the threshold, or the ``least`` best if they are fewer; sorted."""
        turned = unit @ self.turn
        scores = [turned[:, a:b] @ c.T for (a, b), c in zip(zip(self.cuts, self.cuts[1:]), self.codes)]
        return [np.sort(self._list([s[i] for s in scores], least)) for i in range(len(unit))]

    def _list(self, scores: list[np.ndarray], least: int) -> np.ndarray:
        best = [float(s.max()) for s in scores]
        bar = self.threshold
        while True:
            sums, ids = np.zeros(1), np.zeros(1, np.int64)
            for p, s in enumerate(scores):
                rest = sum(best[p + 1 :])
                more = sums[:, None] + s[None, :]
                row, col = np.nonzero(more + rest >= bar)  # what the best of the other parts can still lift over it
                sums, ids = more[row, col], ids[row] * len(s) + col
            if len(ids) >= least or len(ids) == math.prod(len(s) for s in scores):
                break
            bar -= 0.02
        if len(ids) > least:
            keep = sums >= min(self.threshold, np.partition(sums, len(sums) - least)[len(sums) - least])
            ids = ids[keep]
        return ids


def parts_of(dim: int) -> int:
    return max(1, min(PARTS, dim // PART_DIMS))


def _caps_that_overlap(dim: int, cosine: float, n: int = 40_000) -> int:
    """Directions of a single part such that CAPS caps hold a vector and a pair at ``cosine`` shares OVERLAP of a cap.

    Caps of few dimensions must not shrink below the pair's angle, however many vectors there are."""
    if dim == 1:
        return CAPS
    rng = np.random.default_rng(SEED)
    x = rng.normal(size=(n, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    s, other = x[:, 0], cosine * x[:, 0] + math.sqrt(max(0.0, 1 - cosine**2)) * x[:, 1]
    share = 0.5
    while share / 2 * n >= 200:
        bar = np.quantile(s, 1 - share / 2)
        if (other[s >= bar] >= bar).mean() < OVERLAP:
            break
        share /= 2
    return max(CAPS, math.ceil(CAPS / share))


def classes_of(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows with the class of their vector (null: links with nothing), and the classes.

    Rows: vec_id, node. Classes: node (hash of label and vector), label, n (rows), v (array of double).
    """
    x = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), x.alias("v"))
    good = F.coalesce((F.size("v") > 0) & F.forall("v", lambda c: c.isNotNull() & (F.abs(c) < float("inf")))
                      & F.exists("v", lambda c: c != 0) & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.lit(False))
    node = F.xxhash64(F.lit(17), "label", F.transform("v", lambda c: c + 0.0))
    rows = written(rows.select("vec_id", "label", "v", F.when(good, node).alias("node")), "vectors")
    # copies of a vector meet as partial counts only
    classes = rows.where("node IS NOT NULL").groupBy("node").agg(
        F.first("label").alias("label"), F.count(F.lit(1)).alias("n"), F.first("v").alias("v"))
    return rows.select("vec_id", "node"), written(classes, "classes")


def _decoder(filters: Filters):
    """Adds to each class its length and its filters among those of the length, and replaces its vector by the unit vector.

    ``filters`` are of one length; other lengths get filters like them. Classes come sorted by length."""
    def run(batches):
        import pyarrow as pa

        now = filters
        for b in batches:
            dims = b.column("d").to_numpy()
            ends = np.flatnonzero(np.diff(dims)) + 1
            for low, high in zip([0, *ends.tolist()], [*ends.tolist(), len(dims)]):
                if low < high and dims[low] != now.dim:
                    now = Filters.for_table(int(dims[low]), filters.classes, filters.cosine)
                for at in range(low, high, 512):
                    part = b.slice(at, min(512, high - at))
                    v = np.array(part.column("v").to_pylist(), np.float64)
                    v /= np.abs(v).max(1, keepdims=True)  # lengths neither over- nor underflow
                    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("node"), part.column("label"), part.column("n"), part.column("d"),
                         pa.array(now.decode(unit), pa.list_(pa.int64())),
                         pa.array([u.astype("<f8").tobytes() for u in unit], pa.binary())], ["node", "label", "n", "d", "caps", "v"])

    return run


def _trees(near: np.ndarray) -> np.ndarray:
    """Least member of each member's connected component, for a symmetric matrix of links."""
    label = np.arange(len(near))
    while True:
        seen = np.minimum(label, np.where(near, label[None, :], len(near)).min(1))
        seen = seen[seen]
        if (seen == label).all():
            return label
        label = seen


def _met_before(caps: list[np.ndarray], cap: int, width: int = 4096) -> np.ndarray:
    """Whether two members have a filter before ``cap`` in common; filters are taken ``width`` at a time."""
    before = [x[x < cap] for x in caps]
    known, at = np.unique(np.concatenate(before), return_inverse=True)
    who = np.repeat(np.arange(len(caps)), [len(x) for x in before])
    met = np.zeros((len(caps), len(caps)), bool)
    for low in range(0, len(known), width):
        here = (at >= low) & (at < low + width)
        m = np.zeros((len(caps), min(width, len(known) - low)), np.float32)
        m[who[here], at[here] - low] = 1
        met |= m @ m.T > 0
    return met


def _verifier(cosine: float):
    """Members sorted by cell (length, cap, label, slice pair) to node, n (vectors linked here), other (a node of the same
    component, or null)."""
    def run(batches):
        import pyarrow as pa

        def cell(cap, low, high, rows):
            node, n, salt = (np.array(c, np.int64) for c in zip(*[r[:3] for r in rows]))
            v = np.stack([np.frombuffer(r[4], "<f8") for r in rows])
            near = v @ v.T >= cosine
            if near.sum() > len(near):  # links beyond each member's with itself
                near &= ~_met_before([np.array(r[3], np.int64) for r in rows], cap)
            if low == high:
                np.fill_diagonal(near, False)
            else:
                near &= salt[:, None] != salt[None, :]
            tree, count = _trees(near), near @ n
            hit = count > 0
            return node[hit], count[hit], node[tree[hit]]

        def out(found):
            columns = [np.concatenate(c) for c in zip(*found)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["node", "n", "other"])

        key, rows, found = None, [], []
        for b in batches:
            for r in rows_of(b, "cap", "label", "d", "low", "high", "node", "n", "salt", "caps", "v"):
                if r[:5] != key:
                    if len(rows) > 1:
                        found.append(cell(key[0], *key[3:], rows))
                    key, rows = r[:5], []
                    if len(found) >= 500:
                        yield out(found)
                        found = []
                rows.append(r[5:])
        if len(rows) > 1:
            found.append(cell(key[0], *key[3:], rows))
        if found:
            yield out(found)

    return run


def near_links(classes: DataFrame, filters: Filters, cosine: float = COSINE, slice_rows: int = SLICE) -> DataFrame:
    """node, n (linked vectors of other classes found in a cell), other (a node of the same component)."""
    spark = classes.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sized = classes.select("node", "label", "n", F.size("v").alias("d"), "v").repartition(parts).sortWithinPartitions("d")
    decoded = written(sized.mapInArrow(_decoder(filters), "node long, label long, n long, d int, caps array<long>, v binary"), "caps")
    members = decoded.select("node", "label", "d", F.explode("caps").alias("cap"))
    # most filters have one member: only narrow rows meet to find the others
    full = members.groupBy("cap", "label", "d").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    cells = (members.join(full, ["cap", "label", "d"]).withColumn("s", F.ceil(F.col("m") / slice_rows).cast("int"))
             .withColumn("salt", F.pmod(F.xxhash64("node", "cap"), F.col("s")).cast("int"))
             .withColumn("with", F.explode(F.expr("sequence(0, s - 1)")))
             .select("cap", "label", "d", F.least("salt", "with").alias("low"), F.greatest("salt", "with").alias("high"), "salt", "node"))
    cells = cells.join(decoded.select("node", "n", "caps", "v"), "node")
    key = ["cap", "label", "d", "low", "high"]
    cells = cells.repartition(parts, *key).sortWithinPartitions(*key)
    return cells.select(*key, "node", "n", "salt", "caps", "v").mapInArrow(_verifier(cosine), "node long, n long, other long")


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links (other vectors linked directly), component_id (smallest vec_id reached), kept."""
    rows, classes = classes_of(vectors)
    shape = classes.agg(F.max(F.size("v")).alias("d"), F.count(F.lit(1)).alias("n")).first()
    if not shape["n"]:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.col("vec_id").isNotNull().alias("kept"))
    links = written(near_links(classes, Filters.for_table(shape["d"], shape["n"], cosine), cosine), "near")
    roots = components(links, "node", "other")
    linked = links.groupBy("node").agg(F.sum("n").alias("near"))
    known = (classes.select("node", "n").join(linked, "node", "left").join(roots, "node", "left")
             .select("node", (F.col("n") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"), F.coalesce("root", "node").alias("root")))
    rows = rows.join(known, "node", "left")
    least = rows.where("root IS NOT NULL").groupBy("root").agg(F.min("vec_id").alias("least"))
    rows = rows.join(least, "root", "left")
    component = F.coalesce("least", "vec_id")
    return rows.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                       F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
