"""Corpus pipeline: toxicity filter, near-duplicate join, substring dedup, mixing, packing.

Each stage takes the documents that the one before kept (columns of ``documents``); the last returns pieces of packed
sequences. Between stages the rows are written to the shared folder and read back.

Every stage but the last returns all columns of its input with their own values, whatever they are called: those that are
no columns of ``documents`` are set aside under other names while an operator works. Null, empty and wordless texts are never
toxic, link with nothing, hold no passage, have size 0 (taken once) and give one piece, the end id. A null doc_id is a
document: it is not labelled, is the last of its group to stay, and takes no precedence in substring dedup. Rows equal in
id and text: the join keeps one of them (all, if they have no words), later stages treat each as a document. Ties follow the
operators (smaller id, then hash of id and text). An empty table stays empty through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.llm import chunk_dedup, entropy_mix, mil_toxicity, partenum_join, tier_packing, tokens
from caudal.llm.common import written

#: The tokenizer and the classifier are beyond SQL.
ORACLE_SQL = None


#: Columns that operators know; others are set aside.
KNOWN = ("doc_id", "text", "lang", "source", "n_chars")


def aside(docs: DataFrame):
    """``docs`` with its further columns under names that no operator uses, and a function that restores the columns."""
    names = {c: f"_doc_column_{i}" for i, c in enumerate(docs.columns) if c not in KNOWN}

    def back(rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns])

    return docs.select(*[F.col(f"`{c}`").alias(names.get(c, c)) for c in docs.columns]), back


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, trained on labels that are not held out, does not reject."""
    docs, back = aside(docs)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = mil_toxicity.fit(docs, mil_toxicity.trainable(labels))
    return back(mil_toxicity.score_documents(docs, model).where("predicted = 0"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents."""
    docs, back = aside(docs)
    return back(partenum_join.one_per_group(docs))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document has; n_chars follows the text."""
    docs, back = aside(docs)
    out = chunk_dedup.deduplicate_substrings(docs)
    if "n_chars" in docs.columns:
        n_chars = F.when(F.col("removed_words") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType))
    return back(out)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    docs, back = aside(docs)
    out = entropy_mix.mix_documents(docs).where("copies > 0")
    return back(out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in packed sequences."""
    return tier_packing.pack_documents(docs, tokens.tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("substring_dedup", cut_repeats),
    ("mixing", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs, name)
    return docs
