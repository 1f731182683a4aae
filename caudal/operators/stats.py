"""Exact grouped quantiles that never hold a whole group in one task.

``F.percentile`` keeps every distinct value of a group in one aggregation buffer, so a
group holding a third of the rows would land on one executor. Here:

1. rows are counted per (group, value), so ties are one row from here on;
2. ``percentile_approx`` (a mergeable sketch, partial-aggregated) brackets each
   target rank: the exact order statistic lies between the approximations at
   p -/+ delta (delta a few times the sketch's rank error 1/accuracy);
3. one pass sums the counts below the bracket and keeps the distinct values inside
   it (at most about 2*delta*n per group and probability);
4. a cumulative sum over these values gives the two order statistics around p*(n-1),
   which are interpolated linearly (the rule of pandas ``quantile`` and DuckDB
   ``quantile_cont``).

A group whose bracket check fails (should not happen) falls back to the full
[min, max] bracket for that group only, which is still exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_quantiles(df: DataFrame, keys: list[str], value: str, probs: list[float],
                    names: list[str] | None = None, accuracy: int = 100_000) -> DataFrame:
    """One row per group with one column per probability (linear interpolation), plus ``n``."""
    names = names or [f"q{int(round(p * 100)):02d}" for p in probs]
    eps = 1.0 / accuracy
    delta = 3 * eps
    v = df.select(*keys, F.col(value).cast("double").alias("__v")).filter(F.col("__v").isNotNull())

    lo_probs = [max(0.0, p - delta) for p in probs]
    hi_probs = [min(1.0, p + delta) for p in probs]
    sk = v.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min("__v").alias("__min"), F.max("__v").alias("__max"),
        F.percentile_approx("__v", lo_probs, accuracy).alias("__a"),
        F.percentile_approx("__v", hi_probs, accuracy).alias("__b"))
    # one row per (group, probability): target ranks and bracket
    targets = sk.select(*keys, "n", "__min", "__max", F.posexplode(
        F.arrays_zip(F.array(*[F.lit(float(p)) for p in probs]), "__a", "__b")).alias("__j", "__t"))
    targets = targets.select(
        *keys, "n", "__j", F.col("__t")["0"].alias("__p"),
        F.col("__t.__a").alias("__a"), F.col("__t.__b").alias("__b"), "__min", "__max")
    pos = F.col("__p") * (F.col("n") - 1)
    targets = targets.withColumns({
        "__r0": F.floor(pos).cast("long"), "__r1": F.ceil(pos).cast("long"),
        "__f": pos - F.floor(pos)})

    # counts below / inside each bracket (one pass over the distinct values, joined on the group keys)
    v = v.groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__c"))
    j = v.join(targets.select(*keys, "__j", "__a", "__b"), keys)
    counts = j.groupBy(*keys, "__j").agg(
        F.sum(F.when(F.col("__v") < F.col("__a"), F.col("__c")).otherwise(0)).alias("__below"),
        F.sum(F.when(F.col("__v") <= F.col("__b"), F.col("__c")).otherwise(0)).alias("__upto"))
    t = targets.join(counts, [*keys, "__j"])
    ok = (F.col("__below") <= F.col("__r0")) & (F.col("__upto") >= F.col("__r1") + 1)
    t = t.withColumns({
        "__a": F.when(ok, F.col("__a")).otherwise(F.col("__min")),
        "__b": F.when(ok, F.col("__b")).otherwise(F.col("__max")),
        "__below": F.when(ok, F.col("__below")).otherwise(F.lit(0)),
    })
    inside = v.join(t.select(*keys, "__j", "__a", "__b", "__below", "__r0", "__r1"), keys).filter(
        (F.col("__v") >= F.col("__a")) & (F.col("__v") <= F.col("__b")))
    w = Window.partitionBy(*keys, "__j").orderBy("__v")
    # a value holds the ranks from __at to __to - 1
    ranked = inside.withColumn("__to", F.sum("__c").over(w) + F.col("__below")).withColumn("__at", F.col("__to") - F.col("__c"))

    def holds(r):
        return (F.col("__at") <= F.col(r)) & (F.col(r) < F.col("__to"))

    picks = ranked.filter(holds("__r0") | holds("__r1")).groupBy(*keys, "__j").agg(
        F.max(F.when(holds("__r0"), F.col("__v"))).alias("__v0"),
        F.max(F.when(holds("__r1"), F.col("__v"))).alias("__v1"))
    res = t.select(*keys, "__j", "n", "__f").join(picks, [*keys, "__j"]).withColumn(
        "__q", F.col("__v0") + F.col("__f") * (F.col("__v1") - F.col("__v0")))
    out = res.groupBy(*keys).agg(
        F.first("n").alias("n"),
        *[F.max(F.when(F.col("__j") == i, F.col("__q"))).alias(nm) for i, nm in enumerate(names)])
    return out
