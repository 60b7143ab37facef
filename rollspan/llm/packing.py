"""Packing documents into sequences with a bounded number of open windows.

Each partition keeps ``windows`` open sequences. A document's full windows go out at once;
its rest goes to the open sequence that it fits best. When none fits and all windows are in
use, the fullest is sent out; a gap of more than ``gap`` tokens is filled by cutting the
rest. At the end the open sequences of groups of partitions are merged in the same way,
whole; a merged sequence keeps the number of its first part. Only places and checksums travel, not ids.

Cases: a null text is empty; an empty text has the end id only; a document of any length is cut
into pieces; repeated rows are packed each for itself; null ids stay null; an empty table gives no
rows; other columns aren't read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from rollspan.llm.encoding import encoder, ids_crc
from rollspan.llm.frames import giving_back
from rollspan.session import cut_lineage

PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence long, offset long, is_open boolean"
#: Sequence numbers of one partition.
PART = 1 << 36


class OpenWindows:
    """A fixed number of open sequences; ``place`` says where a piece goes."""

    def __init__(self, windows: int, length: int, first: int, close: Callable[[int], None]):
        self.windows, self.length, self.next, self.close = windows, length, first, close
        self.free: list[tuple[int, int]] = []  # (room, sequence), least room first

    def new(self) -> int:
        self.next += 1
        return self.next - 1

    def place(self, n: int, gap: int | None) -> tuple[int, int, int]:
        """(sequence, offset, tokens placed) for a piece of ``n``; fewer than ``n`` only where ``gap`` allows a cut."""
        at = bisect_left(self.free, (n, -1))
        if at < len(self.free):
            room, seq = self.free.pop(at)
        elif len(self.free) < self.windows:
            room, seq = self.length, self.new()
        else:
            room, seq = self.free.pop(0)  # none fits: the fullest goes out
            if gap is not None and room > gap:
                self.close(seq)
                return seq, self.length - room, room
            self.close(seq)
            room, seq = self.length, self.new()
        if room > n:
            insort(self.free, (room - n, seq))
        else:
            self.close(seq)
        return seq, self.length - room, n


@giving_back
def _pieces(batches: Iterator[pa.RecordBatch], path: str, keeps_blanks: bool, end: int, length: int, windows: int,
            gap: int) -> Iterator[pa.RecordBatch]:
    enc = encoder(path, keeps_blanks)
    held: dict[int, list] = {}
    done: list[tuple] = []
    packer = OpenWindows(windows, length, TaskContext.get().partitionId() * PART,
                         lambda seq: done.extend((*p, False) for p in held.pop(seq, [])))

    def rows(found):
        columns = list(zip(*found))
        types = [pa.int64()] * 7 + [pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                          names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence", "offset", "is_open"])

    for batch in batches:
        ids, lengths = enc.encode([t or "" for t in batch.column(1).to_pylist()], end)
        at = 0
        for doc, n in zip(batch.column(0).to_pylist(), lengths.tolist()):
            pos = 0
            while pos < n:
                if n - pos >= length:
                    seq, offset, took = packer.new(), 0, length
                    done.append((doc, pos, took, ids_crc(ids[at + pos:at + pos + took]), n, seq, 0, False))
                else:
                    seq, offset, took = packer.place(n - pos, gap)
                    piece = (doc, pos, took, ids_crc(ids[at + pos:at + pos + took]), n, seq, offset)
                    if offset + took == length:
                        done.append((*piece, False))
                    else:
                        held.setdefault(seq, []).append(piece)
                pos += took
            at += n
        if done:
            yield rows(done)
            done.clear()
    left = [(*p, True) for pieces in held.values() for p in pieces]
    if left:
        yield rows(left)


@giving_back
def _merge(batches: Iterator[pa.RecordBatch], length: int, windows: int) -> Iterator[pa.RecordBatch]:
    packer = OpenWindows(windows, length, 0, lambda seq: None)
    first: dict[int, int] = {}  # merged sequence to that of its first part
    for batch in batches:
        seqs, used = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        placed = [packer.place(n, None) for n in used]
        yield pa.RecordBatch.from_arrays(
            [pa.array(seqs, pa.int64()), pa.array([first.setdefault(p[0], s) for s, p in zip(seqs, placed)], pa.int64()), pa.array([p[1] for p in placed], pa.int64())],
            names=["sequence", "to", "shift"])


def pack_documents(docs: DataFrame, path: str, keeps_blanks: bool, end: int, doc_id: str = "doc_id", text: str = "text",
                   length: int = 1024, windows: int = 64, gap: int = 24, merge_parts: int = 64) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    Documents are taken in the order of their partitions, so an order given by an earlier
    step holds within each partition.
    """
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    pieces = cut_lineage(narrow.mapInArrow(
        partial(_pieces, path=path, keeps_blanks=keeps_blanks, end=end, length=length, windows=windows, gap=gap), PIECE_SCHEMA))
    ends = pieces.where("is_open").groupBy("sequence").agg(F.sum("length").alias("used"))
    # each task merges what some partitions left, most first; at most windows x merge_parts rows
    group = F.expr(f"sequence div {PART * merge_parts}")
    merged = ends.repartition(group).sortWithinPartitions(group, F.col("used").desc(), "sequence")
    moved = cut_lineage(merged.mapInArrow(partial(_merge, length=length, windows=windows), "sequence long, to long, shift long"))
    out = pieces.join(moved, "sequence", "left")
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens",
                      F.coalesce("to", "sequence").alias("sequence_id"),
                      (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"))
