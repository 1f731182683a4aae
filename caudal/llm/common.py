"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caudal.session import scratch_path

SHINGLE_WORDS = 5
#: Rows of an Arrow batch that are Python values at once.
ROWS = 512
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one that ``spark.checkpoint.dir`` names."""
    return scratch_path(spark, f"caudal-{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write the rows to the shared folder and read them back: they are computed once, and a lost
    executor costs no recomputation of what came before."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def utf8(col):
    """UTF-8 bytes of a text, null as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")).cast("binary")


def source_key(col: str):
    """A non-null key of a nullable text column: null and the empty text stay apart."""
    return F.coalesce(F.concat(F.lit("="), F.col(col)), F.lit(""))


def row_key(doc_id, text):
    """64-bit hash of a document's id (null like the greatest) and text (UTF-8): rows equal in both share it."""
    return F.xxhash64(F.lit(3), F.coalesce(doc_id, F.lit(2**63 - 1)), text)


def kept_by_worker(key, make):
    """The object that the Python worker keeps under this key from task to task, made if it has none.

    Only the key asked for last is kept: what one operator remembers makes room when the worker turns to another.
    """
    kept = sys.__dict__.setdefault("_caudal_kept", {})
    if key not in kept:
        kept.clear()
        kept[key] = make()
    return kept[key]


def slices_of(batch):
    """An Arrow batch in slices of at most ROWS rows."""
    return (batch.slice(i, ROWS) for i in range(0, batch.num_rows, ROWS))


def rows_of(batch, *names):
    """The rows of an Arrow batch as tuples of Python values, some of them at a time."""
    for part in slices_of(batch):
        yield from zip(*(part.column(n).to_pylist() for n in names))


def mix(h: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser on unsigned 64-bit integers."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class WordHash(dict):
    """word -> 64-bit hash, looked up once per distinct word; emptied at ``limit`` words."""

    def __init__(self, limit: int = 300_000):
        from xxhash import xxh3_64_intdigest

        self.limit, self.digest = limit, xxh3_64_intdigest

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = h = self.digest(word)
        return h

    @classmethod
    def of_worker(cls) -> WordHash:
        """One for all tasks of a worker, until it turns to other work."""
        return kept_by_worker("words", cls)

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def words_of(text: bytes) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case (other letters as they are)."""
    return text.lower().split()


def shingle_hashes(words: np.ndarray, k: int = SHINGLE_WORDS) -> np.ndarray:
    """Hash of each run of k words, in order; with fewer words that of the whole sequence."""
    n = len(words)
    if not n:
        return words
    width = min(k, n)
    h = np.full(n - width + 1, np.uint64(width), np.uint64)
    for j in range(width):
        h = (h ^ words[j : n - width + 1 + j]) * _STEP
        h ^= h >> np.uint64(29)
    return mix(h)


def ranked(df: DataFrame, keys: list[str], order: list, spread, out: str, buckets: int = 4096,
           per_key: DataFrame | None = None) -> DataFrame:
    """0-based rank of each row within its keys by (``spread``, ``order``), and the key's row count.

    ``spread`` is a column whose values lie evenly in [0, 1). A key's rows are ranked in ``buckets``
    slices of it, each in a task of its own, on top of the counts of the slices before: a key with a
    third of all rows does not meet in one task. The rows move once; the counts are a row per key and
    slice that occurs. Keys are not null. Adds columns ``out`` and ``<out>_n``, and those of ``per_key``
    (a row per key).
    """
    slot, n = f"_{out}_slot", f"{out}_n"
    df = df.withColumn(slot, F.least(F.floor(spread * buckets), F.lit(buckets - 1)).cast("int"))
    counts = df.groupBy(*keys, slot).agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*keys) if keys else Window.partitionBy()
    counts = counts.select(*keys, slot, (F.sum("_n").over(whole.orderBy(slot)) - F.col("_n")).alias("_before"),
                           F.sum("_n").over(whole).alias(n))
    if per_key is not None:
        counts = counts.join(per_key, keys)
    inner = F.row_number().over(Window.partitionBy(*keys, slot).orderBy(spread, *order)) - 1
    return (df.withColumn("_inner", inner).join(counts, [*keys, slot])
            .withColumn(out, F.col("_before") + F.col("_inner")).drop(slot, "_before", "_inner"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of links between long ids: columns node, root (the smallest id reached).

    Each node points to a smaller node of its component. In a round it hears of its neighbours' grandparents, and
    it and its parent take the least; the pointers shorten at least by half, so rounds grow with the logarithm of a
    component's diameter. Each round's pointers are written to the shared folder; rows stay in proportion to the links.
    """
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    both = written(links.union(links.select("b", "a")).distinct(), "links")
    labels = written(both.groupBy("a").agg(F.min("b").alias("b")).select(
        F.col("a").alias("node"), F.least("a", "b").alias("root")), "labels")
    while True:
        up = labels.select(F.col("node").alias("root"), F.col("root").alias("top"))
        known = labels.join(up, "root")
        near = both.join(known.select(F.col("node").alias("b"), "top"), "b").groupBy("a").agg(F.min("top").alias("low"))
        known = known.join(near, known["node"] == near["a"]).select("node", "root", F.least("top", "low").alias("low"))
        votes = known.select("node", F.least("root", "low").alias("vote"), F.col("root").alias("old")).union(
            known.select(F.col("root").alias("node"), F.col("low").alias("vote"), F.lit(None).cast("long")))
        new = written(votes.groupBy("node").agg(F.min("vote").alias("root"), F.max("old").alias("old")), "labels")
        if not new.where("old <> root").limit(1).count():
            return new.select("node", "root")
        labels = new.select("node", "root")
