"""Operator 1: token ids in fixed-width packed blocks.

A table of token blocks is written as Parquet rows, so Spark's commit protocol covers lost tasks and
any store Spark can write to holds it. Each row is one self-contained block::

    part, block      place of the block: the range partition, and the block within it
    first_id, last_id  doc_id of the first and last document in the block (row groups prune on them)
    start_in_part    ids in the partition before this block
    n_tokens, bits   ids in the block, and the width of each
    doc_ids          doc_id of each document (null allowed)
    doc_starts       offset of each document's first id in the block, and the block's end
    payload          the ids, ``bits`` each, little-endian bit order, in groups of 64 ids = ``bits`` words

``bits`` is the least width that holds every id below the vocabulary size. A group of 64 ids fills a whole
number of 64-bit words, so a block unpacks in 64 vector steps and any id range unpacks alone.

Documents come in ascending doc_id (nulls last; equal ids by a hash of the text, so an id that many rows share is dealt to
many tasks). Null texts are empty and hold the end
id only. An empty table gives an empty block table.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caudal.llm import tokens
from caudal.llm.common import rows_of, utf8

#: Ids after which a block is closed; a longer document makes a longer block.
BLOCK_TOKENS = 1 << 18
BLOCK_SCHEMA = ("part int, block int, first_id long, last_id long, start_in_part long, n_tokens long, bits int, "
                "doc_ids array<long>, doc_starts array<long>, payload binary")


def width_of(vocab_size: int) -> int:
    """Bits that hold every id below the vocabulary size, 1 at least."""
    return max(1, (vocab_size - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids below 2**bits to groups of 64 ids in ``bits`` little-endian 64-bit words (zeros at the end)."""
    groups = -(-len(ids) // 64)
    padded = np.zeros(groups * 64, np.uint64)
    padded[: len(ids)] = ids
    if bits in (8, 16, 32):  # the same layout as whole numbers of that width
        return padded.astype(f"<u{bits // 8}").tobytes()
    padded = padded.reshape(groups, 64)
    out = np.zeros((groups, bits), "<u8")
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        out[:, word] |= padded[:, j] << np.uint64(shift)
        if shift + bits > 64:
            out[:, word + 1] |= padded[:, j] >> np.uint64(64 - shift)
    return out.tobytes()


def unpack(payload: bytes, bits: int, start: int, stop: int) -> np.ndarray:
    """Ids start to stop of a packed block; reads only the groups that hold them."""
    if stop <= start:
        return np.zeros(0, "<u4")
    if bits in (8, 16, 32):
        return np.frombuffer(payload, f"<u{bits // 8}", stop - start, start * bits // 8).astype("<u4")
    low, high = start // 64, -(-stop // 64)
    words = np.frombuffer(payload, "<u8", (high - low) * bits, low * bits * 8).reshape(high - low, bits)
    out = np.empty((high - low, 64), "<u4")
    mask = np.uint64((1 << bits) - 1)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        v = words[:, word] >> np.uint64(shift)
        if shift + bits > 64:
            v = v | (words[:, word + 1] << np.uint64(64 - shift))
        out[:, j] = v & mask
    return out.reshape(-1)[start - low * 64 : stop - low * 64]


def _writer(path: str, bits: int, end_id: int | None):
    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, encoder = TaskContext.get().partitionId(), tokens.Encoder.of_worker(path)
        end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
        done = block = 0
        doc_ids, starts, held = [], [0], []

        def close():
            ids = np.frombuffer(b"".join(held), "<u4")
            known = [d for d in doc_ids if d is not None]
            if len(ids) and int(ids.max()) >> bits:
                raise ValueError(f"an id needs more than {bits} bits")
            row = [part, block, known[0] if known else None, known[-1] if known else None, done, len(ids), bits,
                   list(doc_ids), list(starts), pack(ids, bits)]
            return pa.RecordBatch.from_pylist([dict(zip(names, row))], schema=schema)

        names = [c.split()[0] for c in BLOCK_SCHEMA.split(", ")]
        long = pa.list_(pa.int64())
        schema = pa.schema(list(zip(names, [pa.int32(), pa.int32(), *[pa.int64()] * 4, pa.int32(), long, long, pa.binary()])))
        rows = (r for b in batches for r in rows_of(b, "doc_id", "text"))
        for some in tokens.batches(rows, lambda r: r[1]):
            for (doc_id, _), ids in zip(some, encoder.encode([t for _, t in some])):
                held.append(ids + end)
                doc_ids.append(doc_id)
                starts.append(starts[-1] + (len(ids) + len(end)) // 4)
                if starts[-1] >= BLOCK_TOKENS:
                    yield close()
                    done, block = done + starts[-1], block + 1
                    doc_ids, starts, held = [], [0], []
        if doc_ids:
            yield close()

    return run


def write_token_blocks(docs: DataFrame, out_path: str, tokenizer_file: str, vocab_size: int = tokens.VOCAB_SIZE,
                       end_id: int | None = tokens.END_ID) -> None:
    """Encode ``docs`` (doc_id, text; other columns are ignored) and write the block table to ``out_path``."""
    width = max(width_of(vocab_size), (end_id or 0).bit_length())
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text"))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    ordered = rows.repartitionByRange(n, *order).sortWithinPartitions(*order, "text")
    ordered.mapInArrow(_writer(tokenizer_file, width, end_id), BLOCK_SCHEMA).write.mode("overwrite").parquet(out_path)


def read_token_blocks(spark: SparkSession, path: str) -> DataFrame:
    """The block table with ``start``: ids of all blocks before the block, over the whole table."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))  # a row per partition written: broadcast
    w = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    parts = parts.selectExpr("part", f"coalesce(sum(n) OVER (ORDER BY part {w}), 0) AS part_start")
    return blocks.join(F.broadcast(parts), "part").withColumn("start", F.col("part_start") + F.col("start_in_part"))


def document_tokens(blocks: DataFrame) -> DataFrame:
    """Unpack every document of ``read_token_blocks``: doc_id, start, n_tokens, tokens (array of int)."""
    return blocks.select("start", "bits", "doc_ids", "doc_starts", "payload").mapInArrow(
        _unpacker(False), "doc_id long, start long, n_tokens long, tokens array<int>")


def document_digests(blocks: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and the crc32 of the ids as little-endian unsigned 32-bit integers."""
    return blocks.select("start", "bits", "doc_ids", "doc_starts", "payload").mapInArrow(
        _unpacker(True), "doc_id long, start long, n_tokens long, ids_crc32 long")


def _unpacker(digest: bool):
    def run(batches):
        import pyarrow as pa

        for b in batches:
            for start, bits, doc_ids, offsets, payload in rows_of(b, "start", "bits", "doc_ids", "doc_starts", "payload"):
                ids = unpack(payload, bits, 0, offsets[-1])
                at = np.array(offsets, np.int64)
                each = [ids[i:j] for i, j in zip(offsets, offsets[1:])]
                what = pa.array([zlib.crc32(x.tobytes()) for x in each], pa.int64()) if digest else \
                    pa.array([x.astype(np.int32) for x in each], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids, pa.int64()), pa.array(start + at[:-1]), pa.array(np.diff(at)), what],
                    ["doc_id", "start", "n_tokens", "ids_crc32" if digest else "tokens"])

    return run


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[int] | None:
    """The ids of one document: the block is found by its id range, only the document's groups are unpacked."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path).where(
        (F.col("first_id") <= doc_id) & (F.col("last_id") >= doc_id) & F.array_contains("doc_ids", doc_id))
    for row in blocks.select("bits", "doc_ids", "doc_starts", "payload").take(1):
        i = row["doc_ids"].index(doc_id)
        return unpack(bytes(row["payload"]), row["bits"], row["doc_starts"][i], row["doc_starts"][i + 1]).tolist()
    return None
