"""Operators 1 and 8: round trips of ids, packed blocks and packed sequences."""

import random
import zlib

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from caudal.llm import tier_packing, token_files, tokens

PATH = tokens.tokenizer_path()
ENCODER = tokens.Encoder(PATH)
TRICKY = st.sampled_from(list("aAzZ09 .,'%*\n\t\x0b\x0c\x1c\x85\xa0éÉßİıſŸŉ×÷ªº²½Ωςσ的<|>_-") + ["́", "̈", "<|endoftext|>", "'s", "'RE"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(TRICKY, max_size=25).map("".join), min_size=1, max_size=5))
def test_words_give_the_ids_of_whole_texts(texts):
    raw = [t.encode() for t in texts]
    assert ENCODER.encode(raw) == [ENCODER.whole(t) for t in raw]


@given(st.integers(1, 32), st.integers(0, 300), st.integers(0, 2**32))
@settings(max_examples=100, deadline=None)
def test_packed_ids_round_trip(bits, n, seed):
    ids = np.random.default_rng(seed).integers(0, 2**bits, n).astype("<u4")
    raw = token_files.pack(ids, bits)
    assert len(raw) == -(-n // 64) * bits * 8
    assert (token_files.unpack(raw, bits, 0, n) == ids).all()
    a = n // 3
    assert (token_files.unpack(raw, bits, a, n) == ids[a:]).all()


def test_width_is_the_least_that_holds_the_vocabulary():
    assert [token_files.width_of(v) for v in (1, 2, 3, 256, 257, 49_408, 65_537)] == [1, 1, 2, 8, 9, 16, 17]


def reference(rows):
    """Rows in the operator's order (equal ids by Spark's signed xxhash64 of the text) with their ids."""
    def key(r):
        h = xxhash.xxh64_intdigest((r[1] or "").encode(), 42)
        return r[0] is None, r[0] or 0, h - (h >> 63 << 64)

    rows = sorted(rows, key=key)
    return [(r[0], np.frombuffer(ENCODER.whole((r[1] or "").encode()) + b"\1\0\0\0", "<u4")) for r in rows]


def test_blocks_round_trip(spark, odd_docs, odd_rows, tmp_path):
    path = f"file://{tmp_path}/blocks"
    token_files.write_token_blocks(odd_docs, path, PATH)
    blocks = token_files.read_token_blocks(spark, path)
    got = {(r.doc_id, r.start): r for r in token_files.document_tokens(blocks).collect()}
    digests = {(r.doc_id, r.start): r.ids_crc32 for r in token_files.document_digests(blocks).collect()}
    at = 0
    for doc_id, ids in reference(odd_rows):
        row = got.pop((doc_id, at))
        assert row.tokens == ids.tolist() and row.n_tokens == len(ids)
        assert digests[doc_id, at] == zlib.crc32(ids.tobytes())
        at += len(ids)
    assert not got
    long = dict((d, i) for d, i in reference(odd_rows) if d is not None)
    assert token_files.read_document(spark, path, 6) == long[6].tolist()
    assert token_files.read_document(spark, path, 77) is None


def test_blocks_of_an_empty_table(spark, no_docs, tmp_path):
    path = f"file://{tmp_path}/blocks"
    token_files.write_token_blocks(no_docs, path, PATH)
    assert token_files.document_digests(token_files.read_token_blocks(spark, path)).count() == 0


def check_pieces(pieces, rows, window=2048):
    ids = {}
    for doc_id, x in reference(rows):
        ids.setdefault(doc_id, []).append(x)
    sequences, documents = {}, {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
        documents.setdefault((p.doc_id, p.doc_tokens), []).append(p)
        assert p.length >= 1
        assert any(len(x) == p.doc_tokens and zlib.crc32(x[p.start : p.start + p.length].tobytes()) == p.ids_crc32 for x in ids[p.doc_id])
    for s in sequences.values():
        s.sort(key=lambda p: p.offset)
        total = sum(p.length for p in s)
        assert [p.offset for p in s] == np.cumsum([0] + [p.length for p in s])[:-1].tolist()
        assert total <= window and total & (total - 1) == 0 and total == s[0].tier
    for doc_id, all_ids in ids.items():
        for n in {len(x) for x in all_ids}:
            copies = sum(len(x) == n for x in all_ids)
            covered = np.zeros(n, int)
            for p in documents[doc_id, n]:
                covered[p.start : p.start + p.length] += 1
            assert (covered == copies).all()


def test_packing_covers_every_id_once_without_padding(odd_docs, odd_rows):
    check_pieces(tier_packing.pack_documents(odd_docs, PATH).collect(), odd_rows)


def test_packing_of_many_short_documents(spark):
    r = random.Random(5)
    rows = [(i, " ".join("abcde"[r.randrange(5)] for _ in range(int(r.paretovariate(0.7)) % 4000)), "s") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    pieces = tier_packing.pack_documents(docs, PATH, pool_size=50, step_tokens=16 * 2048).collect()
    check_pieces(pieces, rows)
    assert len(pieces) < 2.5 * len(rows)
    assert len({p.tier for p in pieces}) > 2
    assert sorted(map(tuple, pieces)) == sorted(map(tuple, tier_packing.pack_documents(docs, PATH, pool_size=50, step_tokens=16 * 2048).collect()))


def test_step_groups_are_balanced():
    sizes = [2048] * 7 + [1024] * 9 + [256] * 5
    groups = tier_packing.step_groups(sizes, 8192)
    loads = np.bincount(groups, sizes)
    assert len(loads) == -(-sum(sizes) // 8192) and loads.max() - loads.min() <= 2048


def test_packing_of_an_empty_table_and_bad_tiers(no_docs):
    assert tier_packing.pack_documents(no_docs, PATH).count() == 0
    with pytest.raises(ValueError):
        tier_packing.pack_documents(no_docs, PATH, tiers=(2048, 1000))


def test_a_call_of_the_tokenizer_gets_a_bounded_number_of_pre_tokens(monkeypatch):
    encoder, calls = tokens.Encoder(tokens.tokenizer_path()), []

    class Counted:
        def __init__(self, inner):
            self.inner = inner

        def encode(self, words, **how):
            calls.append(len(words if isinstance(words, list) else words.split()))
            return self.inner.encode(words, **how)

    letters = "abcdefghij"
    runs = ["".join(letters[int(c)] for c in str(i)) for i in range(20_000)]
    text = " ".join(runs + [f"don't{w}" for w in runs[:9_000]]).encode()
    want = encoder.whole(text)
    monkeypatch.setattr(encoder, "model", Counted(encoder.model))
    monkeypatch.setattr(encoder, "tokenizer", Counted(encoder.tokenizer))
    assert encoder.encode([text]) == [want]
    assert len(calls) > 2 and max(calls) <= tokens.ENCODED


def test_rows_of_a_batch_become_python_values_some_at_a_time():
    import tracemalloc

    import pyarrow as pa

    from caudal.llm.common import rows_of

    batch = pa.RecordBatch.from_pydict({"i": list(range(5_000)), "t": [b"%04d" % i * 500 for i in range(5_000)]})
    tracemalloc.start()
    rows = iter(rows_of(batch, "i", "t"))
    assert next(rows) == (0, b"0000" * 500)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3_000_000  # the batch has 10 MB
    assert [(i, t[:4]) for i, t in rows] == [(i, b"%04d" % i) for i in range(1, 5_000)]
    assert list(rows_of(batch.slice(0, 0), "i", "t")) == []


def test_each_distinct_word_is_cut_once_and_marks_alone(monkeypatch):
    encoder, cut = tokens.Encoder(PATH), []
    inner = tokens._pre_tokens
    monkeypatch.setattr(tokens, "_pre_tokens", lambda text: cut.append(text) or inner(text))
    texts = [b"One two, three!! (four) five5.\nsix\xc3\xa9 don't... \xc3\xa9!! x.y\x1cz a\xc2\xa0b end." * n for n in (1, 30, 200)]
    assert encoder.encode(texts) == [encoder.whole(t) for t in texts]
    assert sum(map(len, cut)) < 200  # the texts have 15,000 characters
    assert encoder.encode(texts) == [encoder.whole(t) for t in texts] and len(cut) == len(set(cut))


def test_long_words_do_not_stay():
    encoder = tokens.Encoder(PATH)
    texts = [b"ab1" * 5_000 + b" short", "字".encode() * 3_000, b"q" * 100 + b"9"]
    assert encoder.encode(texts) == [encoder.whole(t) for t in texts] == encoder.encode(texts)
    assert b"short" in encoder.ids and max(map(len, encoder.ids)) <= tokens.LONG
