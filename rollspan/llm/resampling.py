"""Importance resampling towards a target: documents drawn by hashed feature weights.

Features are runs of 1 to ``longest`` words, hashed to a fixed number of buckets. The corpus and the target are
each reduced to one count per bucket; the gains, log ratios of smoothed shares, are one array of that many integers
(the only thing sent to all workers), and a document's weight is the floored mean gain of its features. Texts are
read as bytes: words are found, and their CRC-32 is fed, for all words of a batch at a time.

Drawing without replacement in proportion to exp(weight / 1000) is taking the highest sums of weight and a
Gumbel number, which a hash of the document's id gives. The key of the last document drawn is found exactly
by weighted selection: each partition of the keys names the median of what it still holds, the median of these medians, weighted by
the rows they stand for, is compared with all keys, and the side that can't hold the sought key goes, at least a quarter
of the rest each time. Only the documents up to that key are sorted and numbered.

Cases: a null text has no words; empty texts and texts without words have no features, weight 0 and a score, and are never drawn (if ``fewest``
is positive); null ids are hashed as empty strings and lose ties; repeated rows are documents like any other, ties between equal ids go by a hash of
the text, and rows alike in all of that are interchangeable; texts and words of any length are read whole; an empty
target or corpus counts 0 for every bucket; an empty table gives no rows; other columns aren't read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rollspan.llm.frames import slices, utf8
from rollspan.operators.windows import global_prefix
from rollspan.session import cut_lineage

BUCKETS = 10_000
#: Bytes read at a time, and the length up to which words are fed together.
AT_ONCE, TOGETHER = 4_000_000, 48
#: A byte in lower case, and whether it belongs to a word: digits, letters, and all bytes of other characters.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
IN_WORD = np.zeros(256, bool)
IN_WORD[ord("0"):ord("9") + 1] = IN_WORD[ord("a"):ord("z") + 1] = IN_WORD[0x80:] = True


def _crc_table() -> np.ndarray:
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, (value >> 1) ^ np.uint32(0xEDB88320), value >> 1)
    return value


CRC = _crc_table()
ALL = np.uint32(0xFFFFFFFF)


def _fed(crc: np.ndarray, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of what ``crc`` stands for, followed by ``size`` bytes of ``data`` from ``start``."""
    out = crc.copy()
    order = np.argsort(-size, kind="stable")
    order = order[size[order] <= TOGETHER]
    state, at = out[order] ^ ALL, start[order]
    rest = np.searchsorted(-size[order], -np.arange(TOGETHER), side="left")  # words longer than k, for each k
    for k, n in enumerate(rest.tolist()):
        if not n:
            break
        state[:n] = CRC[(state[:n] ^ data[at[:n] + k]) & np.uint32(255)] ^ (state[:n] >> np.uint32(8))
    out[order] = state ^ ALL
    for i in np.flatnonzero(size > TOGETHER).tolist():
        out[i] = crc32(data[start[i]:start[i] + size[i]], int(crc[i]))
    return out


def features(texts: list[bytes], longest: int, buckets: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Words of each text, and for each length of run the buckets of all runs with the text they belong to."""
    data = LOWER[np.frombuffer(b"".join(texts), np.uint8)]
    sizes = np.array([len(t) for t in texts], np.int64)
    begins = np.zeros(len(data) + 1, bool)
    begins[np.cumsum(sizes) - sizes] = begins[len(data)] = True
    inside = IN_WORD[data]
    before = np.append(False, inside[:-1])[:len(data)] & ~begins[:-1]
    after = np.append(inside[1:], False)[:len(data)] & ~begins[1:]
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    text = np.searchsorted(np.cumsum(sizes), start, side="right")
    crc = _fed(np.zeros(len(start), np.uint32), data, start, end - start)
    runs = [((crc % np.uint32(buckets)).astype(np.int64), text)]
    for n in range(2, longest + 1):
        # the runs of n - 1 words that have a word after them in the same text
        kept = np.flatnonzero(text[:len(crc)] == np.append(text, -1)[n - 1:len(crc) + n - 1])
        kept = kept[kept + n - 1 < len(start)]
        blank = np.full(1, ord(" "), np.uint8)
        full = np.zeros(max(0, len(start) - n + 1), np.uint32)
        grown = _fed(crc[kept], blank, np.zeros(len(kept), np.int64), np.ones(len(kept), np.int64))
        full[kept] = _fed(grown, data, start[kept + n - 1], (end - start)[kept + n - 1])
        crc = full
        runs.append(((full[kept] % np.uint32(buckets)).astype(np.int64), text[kept]))
    return np.bincount(text, minlength=len(texts)), runs


def _counted(batches: Iterator[pa.RecordBatch], longest: int, buckets: int) -> Iterator[pa.RecordBatch]:
    total = np.zeros(buckets, np.int64)
    for batch in batches:
        texts = utf8(batch.column(0))
        for a, b in slices(texts, AT_ONCE):
            for bucket, _ in features(texts[a:b], longest, buckets)[1]:
                total += np.bincount(bucket, minlength=buckets)
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])


def bucket_counts(docs: DataFrame, text: str = "text", longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: features of all texts by bucket, added up within each partition first."""
    parts = docs.select(F.col(text)).mapInArrow(partial(_counted, longest=longest, buckets=buckets), "bucket long, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of each bucket in thousandths; ``buckets`` numbers, whatever the tables hold."""
    counts = np.zeros((2, buckets))
    for side, df in enumerate((corpus, target)):
        for bucket, n in df.collect():  # at most one row per bucket
            counts[side, bucket] = n
    (s, t), (all_s, all_t) = counts, counts.sum(1)
    return np.floor(1000 * np.log((t + 1) * (all_s + buckets) / ((s + 1) * (all_t + buckets)))).astype(np.int64)


def _scored(batches: Iterator[pa.RecordBatch], gain: np.ndarray, longest: int, seed: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        every = utf8(batch.column(1))
        for a, b in slices(every, AT_ONCE):
            words, runs = features(every[a:b], longest, len(gain))
            n, total = np.zeros(b - a, np.int64), np.zeros(b - a, np.int64)
            for bucket, text in runs:
                edges = np.searchsorted(text, np.arange(b - a + 1))
                n += np.diff(edges)
                total += np.diff(np.append(0, np.cumsum(gain[bucket]))[edges])
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            ids = batch.column(0).slice(a, b - a)
            h = np.array([int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16) for i in ids.to_pylist()], np.float64)
            score = weight + np.floor(-1000 * np.log(-np.log((h + 0.5) / 4294967296))).astype(np.int64)
            yield pa.RecordBatch.from_arrays([ids, *map(pa.array, (words, n, weight, score)), batch.column(2).slice(a, b - a)],
                                             names=["doc_id", "n_words", "n_features", "weight", "score", "tie"])


def score_documents(docs: DataFrame, gain: np.ndarray, longest: int = 1, seed: str = "2024", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` and ``tie``, a hash of the text."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("tie")).mapInArrow(
        partial(_scored, gain=gain, longest=longest, seed=seed), "doc_id long, n_words long, n_features long, weight long, score long, tie long")


#: Columns of a key, best first in ascending order: negative score, whether the id is null, id, hash of the text.
KEY = ["k0", "k1", "k2", "k3"]
_HALVES = "half int, n long, k0 long, k1 long, k2 long, k3 long"


def _compared(pivot: tuple) -> tuple[Column, Column]:
    """Whether a key is below the pivot, and whether it is the pivot."""
    below = F.lit(False)
    for c, v in reversed(list(zip(KEY, pivot))):
        below = (F.col(c) < v) | ((F.col(c) == v) & below)
    same = F.lit(True)
    for c, v in zip(KEY, pivot):
        same = same & (F.col(c) == v)
    return below, same


def _medians(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each half that the partition still holds keys of: how many, and their median."""
    held = [np.stack([c.to_numpy() for c in b.columns]) for b in batches if b.num_rows]
    if not held:
        return
    keys = np.concatenate(held, axis=1)
    out = []
    for half in np.unique(keys[0]).tolist():
        own = keys[1:, keys[0] == half]
        n = own.shape[1]
        out.append([half, n, *own[:, np.lexsort(own[::-1])[(n - 1) // 2]].tolist()])
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32() if i == 0 else pa.int64()) for i, c in enumerate(zip(*out))],
                                     names=["half", "n", *KEY])


def nth_key(keys: DataFrame, nth: int) -> tuple[tuple, int]:
    """The ``nth`` key (from 1) in ascending order, and the number of comparisons with all that was left.

    Each round is one narrow job: rows meet the pivot, and a partition answers with one row for each side of it. The driver
    gets these rows, at most two per partition.
    """
    rest, below, rounds = keys, 0, 0
    side = F.lit(0)
    while True:
        answers = rest.select(side.alias("half"), *KEY).where("half <> 1").mapInArrow(_medians, _HALVES).collect()
        if rounds:
            sizes = [sum(r.n for r in answers if r.half == h) for h in (0, 2)]
            if below + sizes[0] < nth <= total - sizes[1]:
                return pivot, rounds
            half = 0 if nth <= below + sizes[0] else 2
            lesser, same = _compared(pivot)
            if half:
                rest, below = rest.where(~(lesser | same)), total - sizes[1]
            else:
                rest, total = rest.where(lesser), below + sizes[0]
            answers = [r for r in answers if r.half == half]
        else:
            total = sum(r.n for r in answers)
        if not 1 <= nth <= total:
            raise ValueError(f"no key {nth} among {total}")
        ranked = sorted((tuple(r[c] for c in KEY), r.n) for r in answers)
        reached, goal = 0, sum(n for _, n in ranked) / 2
        for pivot, n in ranked:
            reached += n
            if reached >= goal:
                break
        lesser, same = _compared(pivot)
        side = F.when(lesser, 0).when(same, 1).otherwise(2)
        rounds += 1


def draw(scored: DataFrame, percent: int = 10, fewest: int = 20) -> DataFrame:
    """The columns of ``scored`` and ``rank``: 1, 2, 3 ... for the drawn documents in descending score, else null."""
    names = [c for c in scored.columns if c != "tie"]
    key = dict(zip(KEY, (-F.col("score"), F.col("doc_id").isNull().cast("long"), F.coalesce("doc_id", F.lit(0)), F.col("tie"))))
    rows = cut_lineage(scored.withColumns(key))
    able = rows.where(F.col("n_words") >= fewest)
    n = able.count()
    take = n * percent // 100
    unranked = F.lit(None).cast("long").alias("rank")
    if not take:
        return rows.select(*names, unranked)
    # as many partitions of keys as keys in each
    last, _ = nth_key(able.select(*KEY).coalesce(int(n ** 0.5) + 1), take)
    lesser, same = _compared(last)
    drawn = F.coalesce((F.col("n_words") >= fewest) & (lesser | same), F.lit(False))
    ranked = global_prefix(rows.where(drawn), KEY, rank="rank")
    return ranked.select(*names, F.when(F.col("rank") <= take, F.col("rank")).alias("rank")).unionByName(rows.where(~drawn).select(*names, unranked))


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, fewest: int = 20, longest: int = 1, buckets: int = BUCKETS,
             seed: str = "2024", doc_id: str = "doc_id", text: str = "text", target_text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every document; ``percent`` of those with ``fewest`` words are drawn."""
    gain = gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, target_text, longest, buckets), buckets)
    return draw(score_documents(docs, gain, longest, seed, doc_id, text), percent, fewest)
