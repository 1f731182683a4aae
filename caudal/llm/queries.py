"""Queries of the training-data operators, each over its whole table, and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.llm import (cap_filters, chunk_dedup, entropy_mix, license_scan, mil_toxicity, partenum_join, periodic_runs,
                        ppm_scoring, qr_whitening, stratified_shards, tier_packing, token_files, tokens, topk_norm)
from caudal.llm.common import shared_folder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_token_files")
def op1(spark, sf_dir):
    """Token ids of all documents, written in packed blocks and read back."""
    path = shared_folder(spark, "token-blocks")
    token_files.write_token_blocks(table(spark, sf_dir, "documents"), path, tokens.tokenizer_path())
    return token_files.document_digests(token_files.read_token_blocks(spark, path))


@query("op2_chunk_dedup")
def op2(spark, sf_dir):
    """All documents with passages that repeat across them cut from all but the first."""
    return chunk_dedup.deduplicate_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op3_stratified_shards")
def op3(spark, sf_dir):
    """All documents in 24 shards by proportional stratified interleaving."""
    return stratified_shards.stratified_shards(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "source", "position")


@query("op4_partenum_join", r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s, len(w) >= 5 AS whole
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.whole = b.whole AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * both_n >= 80 * (x.n + y.n - both_n)),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(id, seen) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.id, l.b FROM reach r JOIN both_ways l ON l.a = r.seen)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT id, min(seen) AS component_id FROM reach GROUP BY id) ON id = d.doc_id""")
def op4(spark, sf_dir):
    """Near-duplicate components of all documents on five-word shingles, Jaccard similarity 0.8 or more."""
    return partenum_join.jaccard_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op5_mil_toxicity")
def op5(spark, sf_dir):
    """Toxicity of all documents by multiple-instance learning on the labels that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = mil_toxicity.fit(docs, mil_toxicity.trainable(table(spark, sf_dir, "labels")))
    scored = mil_toxicity.score_documents(docs, model, ["doc_id"])
    return scored.select("doc_id", mil_toxicity.held_out("doc_id").alias("held_out"), "score", "predicted",
                         "n_sentences", "worst_sentence", "worst_score")


@query("op6_topk_norm", """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
WHERE rank <= 5""")
def op6(spark, sf_dir):
    """The 5 best inner products of every vector whose id is divisible by 50 among all others."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk_norm.top_inner_products(vectors, vectors.where("vec_id % 50 = 0"))


@query("op7_cap_filters", """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reach(id, seen) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.seen)
SELECT e.vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) ON a = e.vec_id
JOIN (SELECT id, min(seen) AS component_id FROM reach GROUP BY id) ON id = e.vec_id""")
def op7(spark, sf_dir):
    """Near-duplicate components of all embeddings of one label, cosine 0.98 or more."""
    return cap_filters.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op8_tier_packing")
def op8(spark, sf_dir):
    """All documents in sequences of up to 2048 ids by multi-length packing."""
    return tier_packing.pack_documents(table(spark, sf_dir, "documents"), tokens.tokenizer_path())


@query("op9_entropy_mix")
def op9(spark, sf_dir):
    """All documents with the words the mix takes from each."""
    return entropy_mix.mix_documents(table(spark, sf_dir, "documents"), carry=["doc_id", "source"]).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query("op10_license_scan")
def op10(spark, sf_dir):
    """License notices in all documents."""
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


@query("op11_ppm_scoring")
def op11(spark, sf_dir):
    """PPM scores of all documents by a model of those outside the held-out fifth."""
    held_out = F.crc32(F.col("doc_id").cast("long").cast("string")) % 5 == 1
    return ppm_scoring.score_documents(table(spark, sf_dir, "documents"), held_out)


@query("op12_periodic_runs")
def op12(spark, sf_dir):
    """Periodic runs of words in all documents, of which every tenth has a planted tail that repeats."""
    return periodic_runs.scan(table(spark, sf_dir, "documents"), periodic_runs.digest, periodic_runs.DIGEST, periodic_runs.planted)


@query("op13_qr_whitening")
def op13(spark, sf_dir):
    """The 4 first whitened components of all embeddings."""
    return qr_whitening.whiten(table(spark, sf_dir, "embeddings"))
