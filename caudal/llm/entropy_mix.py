"""Operator 9: mixing sources to target weights by entropy balancing (DataFrame functions only).

A document's rate is the expected number of its copies in the mix. Among all rates between 0 and ``cap`` that
give each source its target number of words, the ones nearest to 1 in relative entropy are exponentially tilted::

    rate = min(cap, exp(lambda[source] * size / mean size of the source))

The multipliers solve the dual problem, one equation per source, by Newton steps on the logarithm of the
words taken, kept in a bracket. A step is one aggregation over the counts per (source, size), which all documents
are reduced to first.

Rates become copies per (source, size): whole copies, then the fractions in the order of size by systematic
rounding, then a few single copies that bring the source nearest to its target. The copies of a (source, size) are dealt
evenly, the odd ones to the documents first in a seeded order, so no document has more than ``cap`` copies and reruns
agree. Ranks come from ``common.ranked``: neither a hot source nor a hot group of copies meets in one task.

A document without words (null, empty or blank text) has size 0 and keeps one copy. A null source is a source of
its own, sorted last. Null ids and repeated rows are documents like others. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caudal.llm.common import ranked, source_key, written
from caudal.llm.stratified_shards import unit_hash

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code point order, repeating; most copies of a document.
WEIGHTS, CAP = (1, 2, 3), 3
SEED = 11
#: Newton steps at most, and the relative error of a source's words that ends them.
STEPS, TOLERANCE = 60, 1e-7
#: Single copies that are moved per source after rounding.
REPAIRS = 4
ADDED = ("size", "source_size", "target", "copies", "taken")


def source_targets(sizes: DataFrame, weights=WEIGHTS, cap: int = CAP) -> DataFrame:
    """Targets per source: shares of all words by weight, none above ``cap`` times its source's words.

    ``sizes``: _source (key), source, source_size; a row per source, which is what the unpartitioned windows
    here sort. Shares that stop at the cap are the sources with the least cap per weight; the others share the
    rest by weight.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    rows = sizes.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int")))
    rows = rows.withColumn("_most", F.col("source_size") * float(cap))
    by_level = Window.orderBy(F.col("_most") / F.col("_w"), "_source")
    level = ((F.sum("source_size").over(Window.partitionBy()) - F.sum("_most").over(by_level) + F.col("_most"))
             / F.sum("_w").over(by_level.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    rows = rows.withColumn("_level", level)
    # the first source, in this order, that its share does not fill: its level holds for all after it
    free = F.when(F.col("_level") * F.col("_w") <= F.col("_most"), F.struct(F.col("_most") / F.col("_w"), "_source", "_level"))
    rows = rows.withColumn("_level", F.min(free).over(Window.partitionBy())["_level"])
    return rows.select("_source", "source_size", F.least("_most", F.col("_level") * F.col("_w")).alias("target"))


def solve_tilts(counts: DataFrame, targets: DataFrame, cap: int = CAP) -> DataFrame:
    """Multiplier per source: _source, tilt, scale. ``counts``: _source, size (> 0), n."""
    base = counts.groupBy("_source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("scale"))
    state = targets.join(base, "_source").select(
        "_source", "target", "scale", "source_size", F.lit(0.0).alias("tilt"), F.lit(-1e6).alias("low"),
        F.lit(1e6).alias("high"), (F.col("target") >= F.col("source_size") * (cap - 1e-9)).alias("full"),
        F.lit(False).alias("done"))
    state = written(state, "tilts")
    for _ in range(STEPS):
        z = F.col("size") / F.col("scale")
        raw = F.exp(F.col("tilt") * z)
        words = F.col("n") * F.col("size") * F.least(raw, F.lit(float(cap)))
        slope = F.when(raw < cap, words * z).otherwise(0.0)
        sums = (counts.join(state.where("NOT done AND NOT full").select("_source", "tilt", "scale"), "_source")
                .groupBy("_source").agg(F.sum(words).alias("got"), F.sum(slope).alias("slope")))
        new = state.join(sums, "_source", "left")
        over = F.col("got") > F.col("target")
        low, high = F.when(over, F.col("low")).otherwise(F.col("tilt")), F.when(over, F.col("tilt")).otherwise(F.col("high"))
        step = F.col("tilt") - F.log(F.col("got") / F.col("target")) * F.col("got") / F.nullif(F.col("slope"), F.lit(0.0))
        inside = F.coalesce((step > low) & (step < high), F.lit(False))
        met = F.coalesce(F.abs(F.col("got") / F.col("target") - 1) <= TOLERANCE, F.lit(True))
        new = new.select("_source", "target", "scale", "source_size", "full",
                         F.when(F.col("got").isNull() | met, F.col("tilt")).when(inside, step).otherwise((low + high) / 2).alias("tilt"),
                         F.coalesce(low, F.col("low")).alias("low"), F.coalesce(high, F.col("high")).alias("high"),
                         (F.col("done") | met).alias("done"))
        state = written(new, "tilts")
        if not state.where("NOT done AND NOT full").limit(1).count():
            break
    # rounded, so that the order in which an aggregation adds doubles does not show
    return state.select("_source", "full", "scale", F.round("tilt", 10).alias("tilt"))


def copies_per_size(counts: DataFrame, targets: DataFrame, tilts: DataFrame, cap: int = CAP) -> DataFrame:
    """Copies of each (source, size) as a whole: columns _source, size, copies."""
    rate = F.when(F.col("full"), float(cap)).otherwise(F.least(F.lit(float(cap)), F.exp(F.col("tilt") * F.col("size") / F.col("scale"))))
    rows = counts.join(tilts, "_source").join(targets.select("_source", "target"), "_source")
    rows = rows.withColumn("_real", F.when(F.col("target") > 0, F.round(F.col("n") * rate, 7)).otherwise(0.0))
    down = Window.partitionBy("_source").orderBy(F.desc("size"))  # a source's distinct sizes
    part = F.round(F.col("_real") - F.floor("_real"), 7)
    rows = rows.withColumn("_part", part).withColumn("_sum", F.round(F.sum("_part").over(down), 6))
    up = F.floor(F.col("_sum") + 0.5) - F.floor(F.lag("_sum", 1, 0.0).over(down) + 0.5)
    copies = F.least(F.floor("_real") + F.least(up, F.lit(1)), F.col("n") * cap).cast("long")
    rows = rows.select("_source", "size", "n", "target", copies.alias("copies"))
    for _ in range(REPAIRS):
        whole = Window.partitionBy("_source")
        rows = rows.withColumn("_miss", F.round(F.col("target")) - F.sum(F.col("copies") * F.col("size")).over(whole))
        can = F.when(F.col("_miss") > 0, F.col("copies") < F.col("n") * cap).otherwise(F.col("copies") > 0)
        left = F.when(can, F.abs(F.abs("_miss") - F.col("size")))
        rows = rows.withColumn("_left", left)
        best = F.min(F.when(F.col("_left") < F.abs("_miss"), F.struct("_left", "size"))).over(whole)
        move = F.coalesce(F.when(best["size"] == F.col("size"), F.signum("_miss")), F.lit(0.0)).cast("long")
        rows = rows.withColumn("_move", move).withColumn("copies", F.col("copies") + F.col("_move")).drop("_miss", "_left", "_move")
    return rows.select("_source", "size", "copies")


def mix_documents(docs: DataFrame, weights=WEIGHTS, cap: int = CAP, seed: int = SEED, carry: list[str] | None = None) -> DataFrame:
    """Each document with size, source_size, target, copies and taken (words with repeats).

    ``carry`` names the columns of ``docs`` to keep; all by default (they then move once). A kept column
    named like an added one gives way to it.
    """
    carry = [c for c in (docs.columns if carry is None else carry) if c not in ADDED]
    held = [F.col(f"`{c}`").alias(f"_in_{i}") for i, c in enumerate(carry)]
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(*held, F.col("source").cast("string").alias("source"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
                       F.struct(F.col("doc_id"), F.crc32(text.cast("binary"))).alias("_tie"))
    rows = rows.withColumn("_source", source_key("source"))
    narrow = written(rows.groupBy("_source", "source", "size").agg(F.count(F.lit(1)).alias("n")), "counts")
    sizes = narrow.groupBy("_source", "source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = written(source_targets(sizes, weights, cap), "targets")
    counts = narrow.where("size > 0").select("_source", "size", "n")
    copies = copies_per_size(counts, targets, solve_tilts(counts, targets, cap), cap)
    copies = (narrow.select("_source", "size").join(copies, ["_source", "size"], "left").join(targets, "_source")
              .withColumnRenamed("copies", "_all"))
    rows = rows.withColumn("_hash", unit_hash(F.col("_tie"), F.col("size"), seed=seed))
    rows = ranked(rows, ["_source", "size"], ["_tie"], F.col("_hash"), "_rank", 256, per_key=copies)
    n, all_ = F.col("_rank_n"), F.col("_all")
    own = F.coalesce(F.expr("_all div _rank_n") + (F.col("_rank") < all_ % n).cast("long"), F.lit(1)).cast("long")
    kept = [F.col(f"_in_{i}").alias(c) for i, c in enumerate(carry)]
    return rows.withColumn("_copies", own).select(
        *kept, F.col("size"), F.col("source_size"), F.col("target"), F.col("_copies").alias("copies"),
        (F.col("_copies") * F.col("size")).alias("taken"))
