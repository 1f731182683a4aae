"""The pipeline over the smallest tables, and the registration."""

import __spark_entry__ as entry
import corpus_pipeline
from caudal.llm import mil_toxicity

NAMES = {f"op{n}_" for n in range(1, 14)}


def test_every_operator_has_a_query():
    names = [q for q in entry.queries() if q.startswith("op")]
    assert {n[: n.index("_") + 1] for n in names} == NAMES and len(names) == 13
    assert "pipeline" in entry.queries()
    assert {"op4_partenum_join", "op6_topk_norm", "op7_cap_filters"} <= set(entry.oracle_sql())


def test_stages_keep_columns_and_clean_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = spark.createDataFrame(stage(spark, before, sf_dir).collect(), docs.schema)
        assert after.columns == docs.columns and after.dtypes == docs.dtypes
        if name == "toxicity":
            gone = {r.doc_id for r in before.select("doc_id").collect()} - {r.doc_id for r in after.select("doc_id").collect()}
            assert sum(labels.get(d) == 0 for d in gone) <= 0.03 * len(labels)
        if name == "substring_dedup":
            assert after.count() == before.count()
        before = after
    pieces = corpus_pipeline.pack(spark, before, sf_dir).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in before.collect()}


def test_pipeline_runs(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0


def test_held_out_rows_are_not_trained_on(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    assert mil_toxicity.trainable(labels).where(mil_toxicity.held_out("doc_id")).count() == 0


def test_stages_with_clashing_columns_nulls_and_repeated_rows(spark, sf_dir):
    base = " ".join(f"word{i}" for i in range(80))
    rows = [(1, base, "en", "a", len(base)), (2, base + " tail", "en", "b", 1), (3, None, None, None, None), (4, "", "en", "", 0),
            (5, " \n\t", "en", "a", 3), (None, base[::-1], "en", "a", 5), (None, None, "en", "a", 0), (6, "one two", "en", "b", 7), (6, "one two", "en", "b", 7)]
    names = ["score", "predicted", "size", "target", "copies", "taken", "removed_words", "source_size", "_key", "_copy", "_most", "key", "node", "root"]
    docs = spark.createDataFrame([(*r, *range(i, i + len(names))) for i, r in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} int" for n in names))
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = spark.createDataFrame(stage(spark, before, sf_dir).collect(), docs.schema)
        assert after.columns == docs.columns
        extra = {tuple(r[c] for c in names) for r in before.collect()}
        assert {tuple(r[c] for c in names) for r in after.collect()} <= extra  # own values, not the operators'
        if name == "toxicity":
            assert after.count() == len(rows)
        if name == "ngram_jaccard_join":
            assert sorted(str(r.doc_id) for r in after.collect()) == sorted(map(str, [1, 3, 4, 5, 6, None, None]))
        before = after
    pieces = corpus_pipeline.pack(spark, before, sf_dir).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in before.collect()}


def test_stages_of_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.pack(spark, docs, sf_dir).count() == 0


def test_a_worker_keeps_what_one_operator_remembers():
    import gc
    import weakref

    from caudal.llm import tokens
    from caudal.llm.common import WordHash

    encoder = tokens.Encoder.of_worker(tokens.tokenizer_path())
    assert tokens.Encoder.of_worker(tokens.tokenizer_path()) is encoder
    seen = weakref.ref(encoder)
    del encoder
    words = WordHash.of_worker()
    gc.collect()
    assert seen() is None and WordHash.of_worker() is words


def test_signatures_of_a_batch_come_some_documents_at_a_time():
    from types import SimpleNamespace

    import numpy as np
    import pyarrow as pa

    from caudal.llm import partenum_join
    from caudal.llm.common import ROWS

    texts = [" ".join(f"w{i}x{j}" for j in range(20)).encode() for i in range(3 * ROWS)]
    sign = partenum_join._signer(SimpleNamespace(value=np.zeros(1 << partenum_join.SKETCH_BITS)))
    out = list(sign(iter([pa.RecordBatch.from_pydict({"text": texts})])))
    assert [len(set(b.column("node").to_pylist())) for b in out] == [ROWS] * 3


def test_scoring_sends_the_text_once(spark, odd_docs):
    model = {"bias": -2.0, "weights": {b"one": 5.0}}
    whole = mil_toxicity.score_documents(odd_docs, model)
    assert "as binary" not in whole._jdf.queryExecution().toString()
    ids = mil_toxicity.score_documents(odd_docs, model, ["doc_id"])
    assert sorted(map(str, whole.select("doc_id", "predicted", "n_sentences", "worst_sentence").collect())) == sorted(
        map(str, ids.select("doc_id", "predicted", "n_sentences", "worst_sentence").collect()))
    assert {7, 8} <= {r.doc_id for r in whole.where("predicted = 1").collect()}
