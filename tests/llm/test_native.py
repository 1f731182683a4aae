"""Operators 3 and 9: sharding and mixing, against plain Python."""

import math
import random
import zlib
from collections import Counter

import pytest

from caudal.llm import entropy_mix, stratified_shards
from caudal.llm.common import ranked
from pyspark.sql import functions as F

PYTHON = ("Python", "Pandas", "Arrow")


def plan_of(df):
    return df._jdf.queryExecution().toString()


def many(spark, n=4000):
    r = random.Random(1)
    rows = [(i, "w " * r.randint(0, 300), r.choice(["a", "a", "a", "b", "c", None])) for i in range(n)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string")


def check_shards(rows, out, shards):
    assert Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows) == \
        Counter((r.doc_id, r["size"], r.text_crc32) for r in out)
    by = {}
    for r in out:
        by.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in by.values()) and set(by) <= set(range(shards))
    counts = [len(by.get(s, [])) for s in range(shards)]
    assert max(counts) - min(counts) <= 1


def test_shards_match_the_mixture(spark):
    rows, docs = many(spark)
    df = stratified_shards.stratified_shards(docs)
    assert not any(w in plan_of(df) for w in PYTHON)
    out = df.collect()
    check_shards(rows, out, 24)
    whole, per = Counter(r[2] for r in rows), Counter((r.source, r.shard) for r in out)
    for source, n in whole.items():
        assert all(abs(per[source, s] - n / 24) < 2 for s in range(24))
    assert sorted(map(tuple, out), key=str) == sorted(map(tuple, stratified_shards.stratified_shards(docs.repartition(7)).collect()), key=str)


def test_shards_of_odd_and_empty_tables(odd_docs, odd_rows, no_docs):
    check_shards(odd_rows, stratified_shards.stratified_shards(odd_docs, shards=4).collect(), 4)
    assert stratified_shards.stratified_shards(no_docs).count() == 0


def test_rank_of_a_hot_key(spark):
    df = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    out = ranked(df, ["k"], ["id"], stratified_shards.unit_hash(F.col("id"), seed=1), "r", 64).where("k = 'hot'").collect()
    assert sorted(x.r for x in out) == list(range(len(out))) and {x.r_n for x in out} == {len(out)}


def targets_by_hand(sizes: dict, weights=(1, 2, 3), cap=3):
    """The reshare as the contract words it: shares by weight, excess over the cap to the others, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        if not free:
            return fixed
        rest = total - sum(fixed.values())
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        above = [s for s in free if share[s] > cap * sizes[s]]
        if not above:
            return fixed | share
        fixed |= {s: cap * sizes[s] for s in above}


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 1000, "c": 10, None: 5, "d": 1}, {"a": 1}, {"x": 0, "y": 10}, {"b": 7, "a": 7, "é": 7, "Z": 9000, "": 3}])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(s if s is not None else "", str(i), n) for i, (s, n) in enumerate(sizes.items())],
                               "source string, _source string, source_size long")
    df = df.withColumn("source", F.when(F.col("_source").isin([str(i) for i, s in enumerate(sizes) if s is None]), None).otherwise(F.col("source")))
    got = {r._source: r.target for r in entropy_mix.source_targets(df).collect()}
    want = targets_by_hand(sizes)
    for i, s in enumerate(sizes):
        assert got[str(i)] == pytest.approx(want[s])


def check_mix(rows, out, near):
    words = [(r[0], len((r[1] or "").split()), r[2]) for r in rows]
    assert Counter((d, n) for d, n, _ in words) == Counter((r.doc_id, r["size"]) for r in out)
    sizes = Counter()
    for _, n, s in words:
        sizes[s] += n
    want, taken = targets_by_hand(dict(sizes)), Counter()
    for r in out:
        taken[r.source] += r.taken
        assert r.taken <= 3 * r["size"] and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
    for s, n in taken.items():
        assert abs(n - want[s]) <= near


def test_mix_meets_targets(spark):
    rows, docs = many(spark)
    df = entropy_mix.mix_documents(docs)
    assert not any(w in plan_of(df) for w in PYTHON)
    out = df.collect()
    check_mix(rows, out, 5)
    again = entropy_mix.mix_documents(docs.repartition(5)).collect()
    assert sorted((r.doc_id, r.copies) for r in out) == sorted((r.doc_id, r.copies) for r in again)


def test_rates_are_exponentially_tilted(spark):
    rows, docs = many(spark, 1500)
    counts = docs.selectExpr("coalesce(source, '-') _source", "cast(regexp_count(text, 'w') as long) size").where("size > 0").groupBy("_source", "size").agg(F.count("*").alias("n"))
    totals = {r._source: r.t for r in counts.groupBy("_source").agg(F.sum(F.col("n") * F.col("size")).alias("t")).collect()}
    goal = dict(zip(sorted(totals), (0.4, 1.0, 2.5, 3.0)))
    targets = spark.createDataFrame([(s, t, goal[s] * t) for s, t in totals.items()], "_source string, source_size long, target double")
    tilts = {r._source: r for r in entropy_mix.solve_tilts(counts, targets).collect()}
    for s, t in totals.items():
        got = sum(r.n * r["size"] * (3 if tilts[s].full else min(3, math.exp(tilts[s].tilt * r["size"] / tilts[s].scale)))
                  for r in counts.where(F.col("_source") == s).collect())
        assert got == pytest.approx(goal[s] * t, rel=1e-5)


def test_mix_of_odd_and_empty_tables(odd_docs, odd_rows, no_docs):
    out = entropy_mix.mix_documents(odd_docs).collect()
    check_mix(odd_rows, out, 30_000)
    assert all(r.copies == 1 for r in out if r["size"] == 0)
    assert entropy_mix.mix_documents(no_docs).count() == 0
