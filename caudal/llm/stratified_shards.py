"""Operator 3: sharding by proportional stratified interleaving (DataFrame functions only).

Within each source the rows are shuffled by a seeded hash and ranked; row r of n has the fractional rank
(r + 1/2) / n. Sorted by it, every stretch of the whole order holds the sources in the mixture's proportions,
and the order is cut into shards whose row counts differ by one at most.

Ranks are built from counts per slice of the hash (``common.ranked``), so a source with a third of all rows is
ranked by many tasks. Texts are reduced to their size and checksum at the scan; shuffles carry narrow rows.

A null source is a source of its own; a null text has no bytes; null ids and repeated rows are rows like others,
in an order that their hash, id, source, size and checksum decide (rows equal in all of these are
interchangeable). An empty table gives no rows. Columns other than doc_id, text and source are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caudal.llm.common import ranked, source_key

SHARDS = 24
SEED = 7


def unit_hash(*cols, seed: int):
    """A number in [0, 1) from a seeded 64-bit hash."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11) / F.lit(float(1 << 53))


def stratified_shards(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """doc_id, size (UTF-8 bytes + 8), text_crc32, source, position in the whole order, shard and slot."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       (F.length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    rows = rows.withColumn("_hash", unit_hash(F.col("doc_id"), F.col("size"), F.col("text_crc32"), seed=seed))
    tie = ["doc_id", "size", "text_crc32"]
    rows = rows.withColumn("_source", source_key("source"))
    rows = ranked(rows, ["_source"], tie, F.col("_hash"), "_rank")
    rows = rows.withColumn("_fraction", (F.col("_rank") + 0.5) / F.col("_rank_n"))
    rows = ranked(rows, [], ["_hash", "_source", *tie], F.col("_fraction"), "position")
    # shard s holds the positions p with floor(p * shards / n) = s
    n, p = F.col("position_n"), F.col("position")
    shard = F.expr(f"position * {shards}L div position_n")
    first = F.expr(f"(shard * position_n + {shards - 1}) div {shards}L")
    return (rows.withColumn("shard", shard.cast("int"))
            .withColumn("slot", (p - first).cast("long"))
            .select("doc_id", "size", "text_crc32", "source", p.cast("long").alias("position"), "shard", "slot"))
