"""Operators 6 and 7 against all pairs."""

import numpy as np
import pytest

from caudal.llm import cap_filters, topk_norm

SCHEMA = "vec_id long, embedding array<float>, label int, score int, node int, n int, v int"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], label, 1, 2, 3, 4) for i, v, label in rows], SCHEMA)


def odd(dim):
    return [(900, None, 1), (901, [float("nan")] * dim, 1), (902, [None] + [1.0] * (dim - 1), 1), (903, [float("inf")] + [1.0] * (dim - 1), 1),
            (904, [], 1), (905, [1.0] * (dim + 1), 1), (906, [0.0] * dim, 1), (None, [1.0] * dim, 1)]


def top_by_hand(rows, asked, k, dim):
    good = [(i, np.floor(256 * np.array(v, np.float32).astype(float))) for i, v, _ in rows
            if i is not None and v is not None and len(v) == dim and None not in v and np.isfinite(np.array(v, float)).all()]
    out = []
    for q in sorted(set(asked) & {i for i, _ in good}):
        mine = min(tuple(v) for i, v in good if i == q)
        best = sorted((-int(np.dot(mine, v)), i) for i, v in good if i != q)[:k]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    return out


@pytest.mark.parametrize("kind", ["gauss", "norms", "ties", "few"])
def test_top_k_matches_all_pairs(spark, monkeypatch, kind):
    for name, v in (("ROW_BLOCK", 64), ("QUERY_BLOCK", 8), ("STRIPE", 16), ("HEAD_ROWS", 20), ("GROUPS", 3)):
        monkeypatch.setattr(topk_norm, name, v)
    rng = np.random.default_rng(1)
    n, dim = (4, 6) if kind == "few" else (400, 6)
    v = rng.normal(size=(n, dim)).astype(np.float32)
    if kind == "norms":
        v *= (rng.pareto(1.5, n)[:, None] * [3, 2, 1, 0.1, 0.1, 0.01]).astype(np.float32)
    if kind == "ties":
        v = np.round(v)
    rows = [(i, v[i].tolist(), 0) for i in range(n)] + odd(dim) + [(20, v[0].tolist(), 0)] * (n > 20)
    df = table(spark, rows)
    asked = [i for i, _, _ in rows if i is not None and i % 20 == 0]
    got = topk_norm.top_inner_products(df, df.where("vec_id % 20 = 0"), 5, groups=3).collect()
    assert sorted(map(tuple, got)) == top_by_hand(rows, asked, 5, dim)


def test_top_k_of_an_empty_table(spark):
    df = table(spark, [(1, [1.0], 0)]).where("false")
    assert topk_norm.top_inner_products(df, df).count() == 0
    none = table(spark, odd(3)[:4])
    assert topk_norm.top_inner_products(none, none).count() == 0


def links_by_hand(rows, dim, cosine=0.98):
    ok = [i is not None and v is not None and len(v) == dim and None not in v and np.isfinite(np.array(v, float)).all()
          and np.any(np.array(v)) and label is not None for i, v, label in rows]
    unit = np.array([np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float)) if good else np.zeros(dim)
                     for (_, v, _), good in zip(rows, ok)])
    labels = np.array([-1 if x is None else x for _, _, x in rows])
    near = (unit @ unit.T >= cosine) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(near, False)
    root = np.arange(len(rows))
    while True:
        new = np.minimum(root, np.where(near, root[None, :], len(rows)).min(1))
        if (new == root).all():
            break
        root = new
    out = []
    for i, (d, _, _) in enumerate(rows):
        least = min((rows[j][0] for j in np.flatnonzero(root == root[i])), key=lambda x: (x is None, x))
        out.append((d, int(near[i].sum()), least, d is not None and d == least))
    return out


def clusters(rng, dim=32):
    rows = []
    for g in range(40):
        centre = rng.normal(size=dim)
        for _ in range(rng.integers(1, 12)):
            rows.append(centre + rng.normal(size=dim) * rng.choice([0.02, 0.05, 0.1, 0.2]))
    rows += [rows[0] * 3.0] * 3
    return [(int(i), np.array(v, np.float32).tolist(), int(i) % 7 // 4) for i, v in zip(rng.permutation(len(rows)), rows)]


def test_near_duplicates_reach_almost_all_pairs(spark):
    rng = np.random.default_rng(5)
    rows = clusters(rng) + odd(32) + [(950, [1.0] * 32, None), (951, [1.0] * 32, None)]
    got = {r.vec_id: r for r in cap_filters.near_duplicates(table(spark, rows)).collect()}
    want = links_by_hand(rows, 32)
    assert set(got) == {w[0] for w in want}
    found, there = sum(r.n_links for r in got.values()), sum(w[1] for w in want)
    assert there > 500 and 0.99 * there <= found <= there
    assert sum(tuple(got[w[0]])[2:] == w[2:] for w in want) >= 0.98 * len(want)
    for d in (900, 901, 904, 905, 906, 950, 951):
        assert tuple(got[d]) == (d, 0, d, True)
    assert tuple(got[None]) == (None, 0, None, False)


def test_vectors_of_every_length_link_with_their_own(spark):
    rng = np.random.default_rng(9)
    rows = clusters(rng)
    for dim in (1, 3, 33):
        centre = rng.normal(size=dim) + 3
        rows += [(1000 * dim + i, (centre * (1 + 1e-3 * rng.normal(size=dim)) * s).astype(np.float32).tolist(), 1) for i, s in enumerate([1, 1, 2, 5])]
    got = {r.vec_id: tuple(r) for r in cap_filters.near_duplicates(table(spark, rows)).collect()}
    for dim in (1, 3, 33):
        for w in links_by_hand([x for x in rows if len(x[1]) == dim], dim):
            assert w[1] == 3 and got[w[0]] == w
    assert len(got) == len(rows)


def test_slices_of_a_hot_filter(spark, monkeypatch):
    rng = np.random.default_rng(6)
    centre = rng.normal(size=16)
    rows = [(i, (centre + rng.normal(size=16) * 0.03).astype(np.float32).tolist(), 1) for i in range(150)]
    rows += [(200 + i, rows[0][1], 1) for i in range(100)]  # copies of one vector
    _, classes = cap_filters.classes_of(table(spark, rows))
    links = cap_filters.near_links(classes, cap_filters.Filters(16), slice_rows=20)
    near = {r.node: r.n for r in links.groupBy("node").sum("n").withColumnRenamed("sum(n)", "n").collect()}
    by_vector = {tuple(v): n for (_, v, _), (_, n, _, _) in zip(rows, links_by_hand(rows, 16))}
    for r in classes.collect():
        assert near.get(r.node, 0) + r.n - 1 == by_vector[tuple(np.float32(r.v).tolist())]


def test_near_duplicates_of_an_empty_table(spark):
    assert cap_filters.near_duplicates(table(spark, [(1, [1.0], 0)]).where("false")).count() == 0


def test_decoding_lists_every_filter_above_the_threshold():
    filters = cap_filters.Filters(12, parts=3, directions=6, caps=20)
    unit = np.random.default_rng(2).normal(size=(50, 12))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    every = []
    for v, got in zip(unit @ filters.turn, filters.decode(unit, least=5)):
        s = [v[a:b] @ c.T for a, b, c in zip(filters.cuts, filters.cuts[1:], filters.codes)]
        sums = (s[0][:, None, None] + s[1][None, :, None] + s[2][None, None, :]).reshape(-1)
        above = np.flatnonzero(sums >= filters.threshold)
        assert set(above) <= set(got)
        if len(above) < 5:
            assert set(got) == set(np.argsort(-sums)[:5])
        every.append(len(above))
    assert 5 < np.mean(every) < 40


def test_top_k_of_every_length_and_size(spark, monkeypatch):
    for name, v in (("ROW_BLOCK", 32), ("QUERY_BLOCK", 8), ("STRIPE", 16), ("HEAD_ROWS", 20), ("GROUPS", 3)):
        monkeypatch.setattr(topk_norm, name, v)
    rng = np.random.default_rng(4)
    rows = []
    for dim in (1, 2, 3, 7):
        v = rng.normal(size=(60, dim)) * 10.0 ** rng.choice([0, 0, 3, 5, 6], (60, 1))
        rows += [(1000 * dim + 10 * i, x.astype(np.float32).tolist(), 0) for i, x in enumerate(v)]
    rows += [(60, [5e6, 1.0], 0), (80, [5e6, -5e6, 3.0], 0), (81, [5e6, 5e6, 5.0], 0), (100, [1.0, 2.0, 3.0], 0)]
    df = table(spark, rows)
    got = topk_norm.top_inner_products(df, df.where("vec_id % 20 = 0"), 5, groups=3).collect()
    whole = [(i, [int(np.floor(256 * float(np.float32(c)))) for c in v]) for i, v, _ in rows]
    want = []
    for q, v in whole:
        if q % 20 == 0:
            score = {i: max(-(2**63) + 1, min(2**63 - 1, sum(a * b for a, b in zip(v, w)))) for i, w in whole if i != q and len(w) == len(v)}
            want += [(q, r, i, s) for r, (i, s) in enumerate(sorted(score.items(), key=lambda x: (-x[1], x[0]))[:5], 1)]
    assert sorted(map(tuple, got)) == sorted(want)


@pytest.mark.parametrize("dim", [2, 3, 5, 6, 8, 10, 16, 24, 64])
def test_recall_of_random_pairs_at_every_length(dim):
    rng = np.random.default_rng(dim)
    for classes in (500, 200_000):
        filters = cap_filters.Filters.for_table(dim, classes)
        for cosine in (0.98, 0.985, 0.99):
            a, b = rng.normal(size=(2, 200, dim))
            a /= np.linalg.norm(a, axis=1, keepdims=True)
            b -= a * (a * b).sum(1, keepdims=True)
            b = cosine * a + np.sqrt(1 - cosine**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
            met = [len(np.intersect1d(x, y)) > 0 for x, y in zip(filters.decode(a), filters.decode(b))]
            assert np.mean(met) >= 0.93


def test_short_vectors_reach_almost_all_pairs(spark):
    rng = np.random.default_rng(7)
    rows = []
    for dim in (2, 4, 6, 8):
        for g in range(12):
            centre = rng.normal(size=dim)
            centre /= np.linalg.norm(centre)
            rows += [(10_000 * dim + 50 * g + i, (centre + rng.normal(size=dim) * 0.12 / np.sqrt(dim)).astype(np.float32).tolist(), 1) for i in range(12)]
    got = {r.vec_id: r.n_links for r in cap_filters.near_duplicates(table(spark, rows)).collect()}
    want = [w for dim in (2, 4, 6, 8) for w in links_by_hand([x for x in rows if len(x[1]) == dim], dim)]
    there = sum(w[1] for w in want)
    assert there > 2000 and 0.97 * there <= sum(got.values()) <= there


def search_reads(spark, monkeypatch, n, **sizes):
    """Bytes that reach the search of every second of n vectors, and its tasks."""
    for name, v in {"ROW_BLOCK": 64, "QUERY_BLOCK": 8, **sizes}.items():
        monkeypatch.setattr(topk_norm, name, v)

    def counted(*_):
        def run(batches):
            import pyarrow as pa
            from pyspark import TaskContext

            read = sum(b.nbytes for b in batches)
            if read:
                yield pa.RecordBatch.from_pydict({"query_id": [TaskContext.get().partitionId()], "vec_id": [0], "score": [read]})
        return run

    monkeypatch.setattr(topk_norm, "_search", counted)
    v = np.random.default_rng(8).normal(size=(n, 8))
    df = table(spark, [(i, v[i].astype(np.float32).tolist(), 0) for i in range(n)])
    got = topk_norm.top_inner_products(df, df.where("vec_id % 2 = 0"), 5, groups=3).collect()
    return sum(r.score for r in got), len(got)


def test_what_the_search_reads_grows_with_the_vectors(spark, monkeypatch):
    small, _ = search_reads(spark, monkeypatch, 1000)
    large, _ = search_reads(spark, monkeypatch, 3000)
    assert large < 4 * small  # pairs of blocks grow ninefold
    assert large < 3000 * 100 * 4  # a vector of 8 components has 16 bytes or 32, an id, a length, a floor, a cell


def test_groups_follow_the_bytes_of_the_rows(spark, monkeypatch):
    assert search_reads(spark, monkeypatch, 1000)[1] == 6  # 3 groups, two sets of queries for 8 partitions
    assert search_reads(spark, monkeypatch, 1000, CELL_BYTES=2000)[1] == 16  # 32 bytes a row


@pytest.mark.parametrize("kind", ["spread", "equal", "steep"])
def test_top_k_over_many_blocks(spark, monkeypatch, kind):
    for name, v in (("ROW_BLOCK", 32), ("QUERY_BLOCK", 8), ("STRIPE", 16), ("HEAD_ROWS", 20), ("CELL_BYTES", 2000), ("AT_ONCE", 100)):
        monkeypatch.setattr(topk_norm, name, v)
    rng = np.random.default_rng(3)
    v = rng.normal(size=(500, 12)) * (0.5 ** np.arange(12) if kind == "steep" else 1)
    if kind == "equal":
        v[:400] = v[0]
    rows = [(i - 250, x.astype(np.float32).tolist(), 0) for i, x in enumerate(v)]
    df = table(spark, rows)
    got = topk_norm.top_inner_products(df, df.where("vec_id % 5 = 0"), 5, groups=3).collect()
    assert sorted(map(tuple, got)) == top_by_hand(rows, [i for i, _, _ in rows if i % 5 == 0], 5, 12)
