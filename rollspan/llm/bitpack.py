"""Token ids in files of fixed-width bit packing.

A row of the Parquet files is one block: whole documents in ascending ``doc_id`` order, their
ids stored in the minimum number of bits that the vocabulary needs, and the offset of each
document in the block. The id at place i of a block starts at bit ``i * width``, so any range is read
without the rest, and whole blocks are unpacked by a few numpy operations.

The rows are range-partitioned by ``doc_id`` and written by Spark's own writer, so a lost
executor's part is written again and only whole parts are committed.

Cases: a null text is empty; an empty text has the end id only; null ids come first; rows with
equal ids are ordered by a hash of their text; a very long text is a block of its own; an
empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rollspan.llm.encoding import encoder, ids_crc

FILE_SCHEMA = ("shard int, block int, first long, n_ids long, width int, doc_ids array<long>, "
               "offsets array<long>, bits binary")
DOC_SCHEMA = "shard int, first long, doc_id long, n_tokens long, ids_crc32 long"


def _step(width: int) -> list[list[tuple[int, int]]]:
    """For each byte of eight packed ids: which ids lie in it, and by how much to shift them."""
    return [[(i, i * width - 8 * byte) for i in range(8) if i * width < 8 * byte + 8 and (i + 1) * width > 8 * byte]
            for byte in range(width)]


def pack(ids: np.ndarray, width: int) -> bytes:
    """``ids`` in ``width`` bits each, lowest bit first."""
    groups = np.zeros(-(-len(ids) // 8) * 8, np.uint64)
    groups[:len(ids)] = ids
    groups = groups.reshape(-1, 8)
    out = np.zeros((len(groups), width), np.uint8)
    for byte, parts in enumerate(_step(width)):
        for i, shift in parts:
            moved = groups[:, i] << np.uint64(shift) if shift >= 0 else groups[:, i] >> np.uint64(-shift)
            out[:, byte] |= (moved & np.uint64(255)).astype(np.uint8)
    return out.tobytes()


def unpack(bits: bytes, width: int, start: int, n: int) -> np.ndarray:
    """``n`` ids from place ``start`` of a block; only their bytes are read."""
    first = start // 8
    raw = np.frombuffer(bits, np.uint8, (-(-(start + n) // 8) - first) * width, first * width).reshape(-1, width)
    out = np.zeros((len(raw), 8), np.uint64)
    for byte, parts in enumerate(_step(width)):
        column = raw[:, byte].astype(np.uint64)
        for i, shift in parts:
            out[:, i] |= column >> np.uint64(shift) if shift >= 0 else column << np.uint64(-shift)
    out &= np.uint64((1 << width) - 1)
    return out.ravel()[start - 8 * first:start - 8 * first + n].astype(np.uint32)


def _blocks(batches: Iterator[pa.RecordBatch], path: str, keeps_blanks: bool, end: int,
            block_ids: int) -> Iterator[pa.RecordBatch]:
    enc = encoder(path, keeps_blanks)
    width = int(max(enc.size - 1, end)).bit_length()
    shard, block, first = TaskContext.get().partitionId(), 0, 0
    schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("n_ids", pa.int64()),
                        ("width", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())),
                        ("bits", pa.binary())])
    held, docs, counts = [], [], []

    def flush():
        nonlocal block, first, held, docs, counts
        ids = np.concatenate(held)
        offsets = np.concatenate([[0], np.cumsum(counts)])
        row = [[shard], [block], [first], [len(ids)], [width], [docs], [offsets.tolist()], [pack(ids, width)]]
        block, first = block + 1, first + len(ids)
        held, docs, counts = [], [], []
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, schema)], schema=schema)

    for batch in batches:
        ids, lengths = enc.encode([t or "" for t in batch.column(1).to_pylist()], end)
        at = 0
        for doc, n in zip(batch.column(0).to_pylist(), lengths.tolist()):
            if docs and sum(counts) + n > block_ids:
                yield flush()
            held.append(ids[at:at + n])
            docs.append(doc)
            counts.append(n)
            at += n
    if docs:
        yield flush()


def write_ids(docs: DataFrame, out: str, path: str, keeps_blanks: bool, end: int, doc_id: str = "doc_id",
              text: str = "text", block_ids: int = 1 << 17) -> None:
    """Encode every text and write the blocks to the folder ``out``."""
    ordered = (docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
                   .orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")))
    ordered.mapInArrow(partial(_blocks, path=path, keeps_blanks=keeps_blanks, end=end, block_ids=block_ids),
                       FILE_SCHEMA).write.mode("overwrite").parquet(out)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["shard", "first", "doc_id", "n_tokens", "ids_crc32"]
    for batch in batches:
        for shard, first, n, width, docs, offsets, bits in zip(*(c.to_pylist() for c in batch.columns)):
            ids = unpack(bits, width, 0, n)
            crcs = [ids_crc(ids[a:b]) for a, b in zip(offsets, offsets[1:])]
            at = np.array(offsets[:-1], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(docs), shard, np.int32)), pa.array(at + first), pa.array(docs, pa.int64()),
                 pa.array(np.diff(np.array(offsets, np.int64))), pa.array(crcs, pa.int64())], names=names)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document from the files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``.

    The first id of a part follows from the sizes of the parts before it: one row per file
    part, which is what the broadcast holds.
    """
    blocks = spark.read.parquet(folder)
    parts = blocks.groupBy("shard").agg(F.max(F.col("first") + F.col("n_ids")).alias("_n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select("shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    found = blocks.select("shard", "first", "n_ids", "width", "doc_ids", "offsets", "bits").mapInArrow(_documents, DOC_SCHEMA)
    return (found.join(F.broadcast(starts), "shard")
                 .select("doc_id", (F.col("_before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32"))


def read_ids(spark: SparkSession, folder: str, doc_id: int, start: int = 0, n: int | None = None) -> np.ndarray:
    """Ids of one document (or a range of them) by random access to its block."""
    rows = (spark.read.parquet(folder).where(F.array_contains("doc_ids", F.lit(doc_id).cast("long")))
                 .orderBy("shard", "block").limit(1).collect())
    if not rows:
        raise KeyError(doc_id)
    row = rows[0]
    i = row.doc_ids.index(doc_id)
    a, b = row.offsets[i] + start, row.offsets[i + 1]
    return unpack(bytes(row.bits), row.width, a, b - a if n is None else min(n, b - a))
