"""Operator 4: n-gram Jaccard join by PartEnum signatures.

A document's set holds its distinct 5-word shingles (hashed to 64 bits). Two sets link if 100 * |intersection| >=
80 * |union|. Then their sizes a <= b differ by a factor of 1.25 at most, and the number of shingles in only one of them
is H <= (a + b) / 9.

Size bands. Band i joins the sets of sizes 2**i to 2**(i+1) - 1 with each other and with those just below (from
0.8 * 2**i): every linked pair is together in some band.

Partitions. In band i the shingle domain is cut into n = 2**i + 4 partitions by hash. The sets of a pair agree
(have the same shingles) in at least n - H partitions.

Enumerated subsets. Rank a set's partitions by a fixed order of their contents. The g highest of the partitions in which
two linked sets agree are among the h + g highest of both, h = floor(a / 4) for a set of size a, since a partition
ranked above them in one set is one of the H <= h that differ or one of these g. So if each set has one signature for each
g-subset of its h + g highest partitions, linked sets share a signature: no link is lost. g is 2 in bands up to 3, else 1:
a band's sets all have the same g, whatever their sizes.

The order decides the cost, never the result: contents with rare shingles rank high, by counts over the whole corpus
in a sketch of fixed size (``SKETCH`` counters), then contents of more shingles. A passage or line that very many
documents share makes no signature where a document has anything rarer.

Equal sets are one node. Nodes that share a signature are a group (equal groups are taken once), and each pair of a
group is a candidate, but pairs are not emitted per group:

1. Every group's hub (its node in most groups) is compared with its other nodes; linked nodes become components.
2. Groups that still have several components go through cells: pairs of slices of at most about ``SLICE`` nodes, a task's
   work each. A cell looks at pairs of different components that no earlier group has. A pair is out if more of its
   ``BUCKETS`` bucket hashes differ than shingles may (each differing bucket holds a differing shingle, so this loses no
   link). The pairs left are emitted if they are few for the cell's nodes, and their minimum spanning forest otherwise;
   then the group comes again, with the components that these links made and room for eight times as many pairs.

So each pair that shares a signature is compared, ruled out or known to be connected, components are exact, and a round
emits rows in proportion to the groups' rows. Candidates are verified on the shingles of the whole texts.

Texts that are null or without words have an empty set and link with nothing; with fewer than five words the whole
sequence is the one shingle. Repeated rows, ids and null ids are rows whose equal sets link; component_id is the least id
reached, null if all are null. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caudal.llm.common import WordHash, components, mix, ranked, row_key, rows_of, shingle_hashes, slices_of, utf8, words_of, written
from caudal.llm.stratified_shards import unit_hash

#: Jaccard similarity as a fraction, counters of the sketch (log2), slices it is summed in.
SHARE, OF = 80, 100
SKETCH_BITS, SLICES = 18, 64
#: Bucket hashes of four bits that a node has, nodes of a group in a slice, pairs per node that a cell may emit at first.
BUCKETS, SLICE, PAIRS_PER_NODE = 512, 1000, 4
#: Type of a group's number in a node's list (up to 2**32 groups of several components at a time).
GROUP = "<u4"
_SLICE = (1 << SKETCH_BITS) // SLICES


def shingle_set(text: bytes, hashes: WordHash) -> np.ndarray:
    return np.unique(shingle_hashes(hashes.of(words_of(text))))


def set_digest(shingles: np.ndarray) -> int:
    """64-bit digest of a set, as a signed integer."""
    h = mix(shingles ^ np.uint64(len(shingles)))
    return int(mix(np.array([h.sum(dtype=np.uint64)]))[0].view(np.int64))


def bands_of(size: int) -> list[int]:
    """The bands a set of this size takes part in."""
    i = size.bit_length() - 1
    return [i, i + 1] if 5 * size >= 4 * (2 << i) else [i]


def signatures(shingles: np.ndarray, sketch: np.ndarray, mean: float) -> np.ndarray:
    """Signatures of a set in all its bands."""
    a = len(shingles)
    h = a // 4
    if not h:  # a linked set would be equal
        return np.zeros(0, np.uint64)
    seen = sketch[(shingles & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)]
    common = np.log2(1 + seen / mean).astype(np.int64)  # 0 or 1: no more than chance
    out = []
    for band in bands_of(a):
        n, g = (1 << band) + 4, 2 if band <= 3 else 1  # by the band alone: both sets of a pair have the same
        part = ((shingles >> np.uint64(20)) % np.uint64(n)).astype(np.int64)
        content = np.zeros(n, np.uint64)
        np.add.at(content, part, mix(shingles + np.uint64(band)))
        count = np.bincount(part, minlength=n)
        rarest = np.full(n, 99)
        np.minimum.at(rarest, part, np.maximum(common, 1))
        content = mix(content ^ (np.arange(n, dtype=np.uint64) << np.uint64(40)) ^ np.uint64(band))
        top = np.lexsort((np.arange(n), content, -count, rarest))[: h + g]
        sig = content[top]
        if g == 2:
            pairs = np.array(list(combinations(range(len(sig)), 2)))
            low, high = np.minimum(sig[pairs[:, 0]], sig[pairs[:, 1]]), np.maximum(sig[pairs[:, 0]], sig[pairs[:, 1]])
            sig = mix(low * np.uint64(3) + high)
        out.append(sig)
    return np.concatenate(out)


def _profile():
    """Documents to size and set digest; at its end the task's counts of shingles, in slices."""
    def run(batches):
        import pyarrow as pa

        names = ["doc_id", "key", "n", "node", "slice", "counts"]
        kinds = [*[pa.int64()] * 4, pa.int32(), pa.binary()]

        def rows(*columns):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        hashes, counts = WordHash.of_worker(), np.zeros(1 << SKETCH_BITS, np.uint32)
        places, held = [], 0

        def count():
            if places:
                counts[:] += np.bincount(np.concatenate(places), minlength=len(counts)).astype(np.uint32)
                places.clear()

        for b in batches:
            n, nodes = [], []
            for (text,) in rows_of(b, "text"):
                s = shingle_set(text, hashes)
                n.append(len(s))
                nodes.append(set_digest(s) if len(s) else None)
                places.append(_places(s))
                held += len(s)
                if held >= 1 << 18:
                    count()
                    held = 0
            blank = [None] * len(n)
            yield rows(b.column("doc_id"), b.column("key"), n, nodes, blank, blank)
        count()
        blank = [None] * SLICES
        yield rows(blank, blank, blank, blank, range(SLICES), [counts[i * _SLICE : (i + 1) * _SLICE].tobytes() for i in range(SLICES)])

    return run


def _places(shingles: np.ndarray) -> np.ndarray:
    return (shingles & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)


def _add_slices(batches):
    import pyarrow as pa

    sums = {}
    for b in batches:
        for i, counts in rows_of(b, "slice", "counts"):
            sums[i] = sums.get(i, 0) + np.frombuffer(counts, np.uint32).astype(np.uint64)
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
                                     ["slice", "counts"])


def corpus_sketch(profile: DataFrame) -> np.ndarray:
    """Shingle counts of the corpus by hash: a fixed number of counters, whatever the corpus."""
    parts = profile.where("slice IS NOT NULL").select("slice", "counts").repartition(SLICES, "slice")
    out = np.zeros(1 << SKETCH_BITS, np.uint64)
    for i, counts in parts.mapInArrow(_add_slices, "slice int, counts binary").collect():  # SLICES rows
        out[i * _SLICE : (i + 1) * _SLICE] = np.frombuffer(bytes(counts), np.uint64)
    return out.astype(np.float64)


def _signer(sketch):
    def run(batches):
        import pyarrow as pa

        counts, hashes, seen = sketch.value, WordHash.of_worker(), set()
        mean = max(1.0, float(counts.mean()))
        for b in (part for batch in batches for part in slices_of(batch)):  # a document has a signature for each four shingles
            sigs, nodes = [np.zeros(0, np.uint64)], []
            for text in b.column("text").to_pylist():
                s = shingle_set(text, hashes)
                if len(s) and (node := set_digest(s)) not in seen:  # a task signs equal sets once
                    seen.add(node)
                    sigs.append(signatures(s, counts, mean))
                    nodes.append((node, len(sigs[-1])))
            node = np.repeat(np.array([x for x, _ in nodes], np.int64), np.array([k for _, k in nodes], np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs).view(np.int64)), pa.array(node)], ["sig", "node"])

    return run


def shared_groups(docs: DataFrame, sketch) -> DataFrame:
    """Nodes that share a signature: grp, node; groups of equal nodes once."""
    rows = docs.select("text").mapInArrow(_signer(sketch), "sig long, node long")
    by_sig = Window.partitionBy("sig")
    rows = rows.select("sig", "node", F.min("node").over(by_sig).alias("low"), F.max("node").over(by_sig).alias("high"))
    rows = rows.where("low < high").select("sig", "node").distinct()  # most signatures have one node
    grp = F.xxhash64(F.bit_xor(F.xxhash64("node")).over(by_sig), F.count(F.lit(1)).over(by_sig), F.min("node").over(by_sig))
    return rows.select(grp.alias("grp"), "node").distinct()


def _verifier(share: int, of: int):
    """Candidate pairs with their texts, those of a hub in a row, to the pairs that link."""
    def run(batches):
        import pyarrow as pa

        hashes, last, hub = WordHash.of_worker(), None, None
        for b in batches:
            found = []
            for a, other, text_a, text_b in rows_of(b, "a", "b", "text_a", "text_b"):
                if a != last:
                    last, hub = a, shingle_set(text_a, hashes)
                s = shingle_set(text_b, hashes)
                both = len(np.intersect1d(hub, s, assume_unique=True))
                if of * both >= share * (len(hub) + len(s) - both):
                    found.append((a, other))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    return run


def verified(pairs: DataFrame, texts: DataFrame, share: int = SHARE, of: int = OF) -> DataFrame:
    """Pairs (a, b) whose texts link. ``texts``: node, text."""
    rows = (pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
            .join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a"))
    return rows.sortWithinPartitions("a").select("a", "b", "text_a", "text_b").mapInArrow(_verifier(share, of), "a long, b long")


_NIBBLES = np.array([(x > 15) + (x % 16 > 0) for x in range(256)], np.uint8)


def bucket_hashes(shingles: np.ndarray) -> bytes:
    """BUCKETS hashes of four bits: of the shingles in each bucket of the domain."""
    h = np.zeros(BUCKETS, np.uint8)
    np.bitwise_xor.at(h, (shingles % np.uint64(BUCKETS)).astype(np.int64), (mix(shingles) >> np.uint64(60)).astype(np.uint8))
    return (h[::2] << np.uint8(4) | h[1::2]).tobytes()


def _carder(batches):
    import pyarrow as pa

    hashes = WordHash.of_worker()
    for b in (part for batch in batches for part in slices_of(batch)):
        sets = [shingle_set(t, hashes) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("node"), pa.array([len(x) for x in sets], pa.int64()),
                                          pa.array([bucket_hashes(x) for x in sets], pa.binary())], ["node", "n", "card"])


def _lister(batches):
    """Lists of groups as sorted binary: a tenth of the work of lists of Python integers later on."""
    import pyarrow as pa

    for b in batches:
        if b.num_rows and max(int(x.max()) for x in b.column("grps").to_numpy(zero_copy_only=False)) >> 32:
            raise OverflowError("more than 2**32 open groups: widen GROUP")
        lists = [np.sort(x).astype(GROUP).tobytes() for x in b.column("grps").to_numpy(zero_copy_only=False)]
        yield pa.RecordBatch.from_arrays([b.column("node"), b.column("n"), b.column("card"), pa.array(lists, pa.binary())],
                                         ["node", "n", "card", "grps"])


def _forest(cost: np.ndarray, root: np.ndarray) -> list[tuple[int, int]]:
    """Minimum spanning forest of a symmetric cost matrix (1 << 16: no edge); equal roots are connected."""
    none, m = 1 << 16, len(cost)  # above any count of differing buckets
    out, todo = [], np.ones(m, bool)
    cost = np.where(root[:, None] == root[None, :], 0, cost)
    for start in range(m):
        if not todo[start]:
            continue
        best, via = np.full(m, none), np.full(m, -1)
        at = start
        while True:
            todo[at] = False
            nearer = todo & (cost[at] < best)
            best[nearer], via[nearer] = cost[at][nearer], at
            left = np.where(todo, best, none)
            at = int(left.argmin())
            if left[at] >= none:
                break
            if root[via[at]] != root[at]:
                out.append((int(via[at]), at))
    return out


def _paired(room: int, share: int, of: int):
    """Members sorted by cell to candidate pairs (a, b); (null, grp) for a group that has more."""
    def run(batches):
        import pyarrow as pa

        def frombuffer(raw):
            return np.frombuffer(raw, GROUP)

        def cell(grp, low, high, rows):
            node, n, root, salt = (np.array(c, np.int64) for c in zip(*[r[:4] for r in rows]))
            may = (root[:, None] != root[None, :]) & (of * n[:, None] >= share * n[None, :]) & (of * n[None, :] >= share * n[:, None])
            if low != high:
                may &= salt[:, None] != salt[None, :]
            i, j = (x.astype(np.int32) for x in np.nonzero(np.triu(may, 1)))
            del may
            if not len(i):
                return [], False
            cards = np.stack([np.frombuffer(r[5], np.uint8) for r in rows])
            differ = np.concatenate([_NIBBLES[cards[i[k : k + 4096]] ^ cards[j[k : k + 4096]]].sum(1, dtype=np.int32)
                                     for k in range(0, len(i), 4096)])
            # |difference| <= (of - share) / (of + share) * (a + b) for linked sets
            keep = (of + share) * differ <= (of - share) * (n[i] + n[j])
            i, j, differ = i[keep], j[keep], differ[keep]
            # a pair belongs to the first of the groups that both are in
            before = {int(x): frombuffer(rows[x][4]) for x in np.unique(np.r_[i, j])}
            before = {x: set(g[: np.searchsorted(g, grp)].tolist()) for x, g in before.items()}
            keep = np.array([before[x].isdisjoint(before[y]) for x, y in zip(i.tolist(), j.tolist())], bool)
            i, j, differ = i[keep], j[keep], differ[keep]
            if len(i) <= room * len(rows):
                return list(zip(node[i].tolist(), node[j].tolist())), False
            cost = np.full((len(rows), len(rows)), 1 << 16, np.int32)
            cost[i, j] = cost[j, i] = differ
            return [(int(node[x]), int(node[y])) for x, y in _forest(cost, root)], True

        def out(found):
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

        def close(key, rows, found):
            if len(rows) > 1:
                pairs, more = cell(*key, rows)
                found += [(min(x), max(x)) for x in pairs]
                if more:
                    found.append((None, key[0]))

        key, rows, found = None, [], []
        for b in batches:
            for r in rows_of(b, "grp", "low", "high", "node", "n", "root", "salt", "grps", "card"):
                if r[:3] != key:
                    close(key, rows, found)
                    key, rows = r[:3], []
                    if len(found) >= 20_000:
                        yield out(found)
                        found = []
                rows.append(r[3:])
        close(key, rows, found)
        if found:
            yield out(found)

    return run


def _open(groups: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Rows of groups that have several components, with the nodes' roots and the group's size."""
    if roots is None:
        rows = groups.withColumn("root", F.col("node"))
    else:
        rows = groups.join(roots, "node", "left").select("grp", "node", F.coalesce("root", "node").alias("root"))
    by = Window.partitionBy("grp")
    rows = rows.select("*", F.count(F.lit(1)).over(by).alias("m"), F.min("root").over(by).alias("r0"), F.max("root").over(by).alias("r1"))
    return rows.where("r0 < r1").select("grp", "node", "root", "m")


def link_components(groups: DataFrame, texts: DataFrame) -> DataFrame:
    """node, root of every node that links, from groups of candidate nodes (grp, node) and the nodes' texts."""
    parts = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    used = groups.groupBy("node").agg(F.count(F.lit(1)).alias("used"))
    hub = F.max(F.struct("used", "node")).over(Window.partitionBy("grp"))["node"]
    pairs = groups.join(used, "node").select("grp", "node", hub.alias("hub")).where("node <> hub")
    pairs = written(pairs.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct(), "pairs")
    links = written(verified(pairs, texts), "links")
    roots = components(links)
    # groups of two are settled by their hub; the others are numbered, as a node's list of them travels with it
    groups = written(_open(groups, roots).where("m > 2").select("grp", "node"), "open")
    numbers = ranked(groups.select("grp").distinct(), [], ["grp"], unit_hash(F.col("grp"), seed=4), "number")
    groups = written(groups.join(numbers, "grp").select(F.col("number").cast("long").alias("grp"), "node"), "open")
    # a node is in as many groups as it has signatures at most; groups of one component no longer count
    lists = groups.groupBy("node").agg(F.collect_list("grp").alias("grps"))
    cards = texts.mapInArrow(_carder, "node long, n long, card binary").join(lists, "node")
    cards = written(cards.mapInArrow(_lister, "node long, n long, card binary, grps binary"), "cards")
    room = PAIRS_PER_NODE
    while True:
        rows = _open(groups, roots).withColumn("s", F.ceil(F.col("m") / SLICE).cast("int"))
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("node", "grp"), F.col("s")).cast("int"))
        rows = rows.withColumn("with", F.explode(F.expr("sequence(0, s - 1)"))).join(cards, "node").select(
            "grp", F.least("salt", "with").alias("low"), F.greatest("salt", "with").alias("high"), "node", "n", "root", "salt", "grps", "card")
        rows = rows.repartition(parts, "grp", "low", "high").sortWithinPartitions("grp", "low", "high")
        found = written(rows.mapInArrow(_paired(room, SHARE, OF), "a long, b long"), "found")
        new = written(found.where("a IS NOT NULL").distinct().join(pairs, ["a", "b"], "left_anti"), "pairs")
        more = verified(new, texts)
        links = written(links.union(more), "links")
        roots = components(links)
        open_groups = written(found.where("a IS NULL").select(F.col("b").alias("grp")).distinct(), "open")
        if not open_groups.limit(1).count():
            return roots
        groups = written(groups.join(open_groups, "grp", "left_semi"), "groups")
        pairs = written(pairs.union(new), "pairs")
        room *= 8


def jaccard_groups(docs: DataFrame) -> DataFrame:
    """doc_id, key (hash of id and text), n_shingles, node (hash of the set; null if empty), root (node that names the
    component) and component_id, a row per row of ``docs``."""
    spark = docs.sparkSession
    rows = keyed(docs)
    profile = written(rows.mapInArrow(_profile(), "doc_id long, key long, n long, node long, slice int, counts binary"), "profile")
    sketch = spark.sparkContext.broadcast(corpus_sketch(profile))  # SKETCH_BITS bound its size
    profile = profile.where("slice IS NULL").drop("slice", "counts")
    groups = written(shared_groups(rows, sketch), "groups")
    wanted = groups.select("node").distinct()
    one = profile.join(wanted, "node", "left_semi").groupBy("node").agg(F.min("key").alias("key"))
    texts = written(rows.select("key", "text").join(one, "key").groupBy("node").agg(F.min("text").alias("text")), "texts")
    roots = link_components(groups, texts)
    profile = profile.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = profile.where("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("least"))
    out = profile.join(least, "root", "left")
    component = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return out.select("doc_id", "key", F.col("n").alias("n_shingles"), "node", "root", component.alias("component_id"))


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, key (hash of id and text, null ids like the greatest), text (UTF-8, null as empty)."""
    doc, text = F.col("doc_id").cast("long"), utf8("text")
    return docs.select(doc.alias("doc_id"), row_key(doc, text).alias("key"), text.alias("text"))


def one_per_group(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of linked documents: the least doc_id, nulls last, then the least key.

    Documents without words stay all.
    """
    groups = jaccard_groups(docs)
    by = F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("doc"), "key")
    keep = groups.where("root IS NOT NULL").groupBy("root").agg(F.min(by)["key"].alias("_key")).select("_key", F.lit(1).alias("_most"))
    keep = keep.union(groups.where("root IS NULL").select("key", F.lit(2**31 - 1)).distinct())
    held = [F.col(f"`{c}`").alias(f"_in_{i}") for i, c in enumerate(docs.columns)]
    rows = docs.select(*held, row_key(F.col("doc_id").cast("long"), utf8("text")).alias("_key")).join(keep, "_key")
    # rows equal in id and text share a key: they lie together already
    rows = rows.withColumn("_copy", F.row_number().over(Window.partitionBy("_key").orderBy(F.lit(0))))
    return rows.where("_copy <= _most").select(*[F.col(f"_in_{i}").alias(c) for i, c in enumerate(docs.columns)])
