"""Spelling variants: words one edit apart, found by comparing padded blocks of words.

Two words differ by exactly one inserted, deleted or replaced code point if and only if the lengths of their common prefix and common suffix
add up to the longer length minus one at least (different words of unlike or equal length). Words are therefore laid
out as matrices of code points, padded once on the right and once on the left, and pairs of blocks of rows are
compared cell by cell: the first unlike cell from either side gives both lengths.

Only words that can be that close meet. A pair whose shorter word has m code points is equal outside one of ``SEGMENTS``
segments of 0 ... m, so each word is dealt to groups by all that lies outside a segment, as a word of length m = its own and
as one of length m + 1. A pair counts only in the segment where its common prefix ends, so once in all, and leaves
each task as sums per word: the number of near words and the best of them.

A group with more than ``limit`` words (or more than ``CELLS`` cells) is split before it is dealt: its segment is halved, for as long as it has more than
one code point; then its size is bounded by the alphabet, not by the table. Groups are counted with map-side sums, and
rows of such groups are the only ones touched again.

Cases: null and empty words and null counts are left out by :func:`variants`; null texts have no words; repeated rows add their occurrences;
texts and words of any length are taken whole; a word without near words has ``n_near`` 0 and is its own root; an empty table gives no
rows; other columns aren't read, whatever their names. A null ``doc_id`` is written as an empty string in the hash of :func:`noisy_words`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rollspan.session import cut_lineage

#: Letters of a run, and the lower-cased ones.
LETTERS, UPPER, LOWER = "A-Za-zÀ-ÿ", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Segments of a word, words of a group, and cells of a matrix held at a time.
SEGMENTS, LIMIT, CELLS = 4, 20_000, 4_000_000


def noisy_words(docs: DataFrame, shortest: int = 7, one_in: int = 31, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n``: runs of letters in lower case, where every ``one_in``-th by hash has lost a code point."""
    runs = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("_id"),
                       F.explode(F.regexp_extract_all(F.col(text), F.lit(f"[{LETTERS}]{{{shortest},}}"), F.lit(0))).alias("_run"))
    runs = runs.withColumn("_low", F.translate("_run", UPPER, LOWER)).withColumn("_h", F.crc32(F.concat("_id", F.lit(":"), "_low")))
    at = F.expr("cast(_h % length(_low) as int)")
    word = F.when(F.col("_h") % one_in == 0, F.concat(F.substring("_low", F.lit(1), at), F.substr("_low", at + 2))).otherwise(F.col("_low"))
    return runs.select(word.alias("word")).where(F.length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _key() -> Column:
    """All of a word that lies outside code points ``lo`` to ``hi`` of its group's length ``m``."""
    return F.expr("xxhash64(m, lo, hi, left(word, lo), right(word, m - hi))")


def _dealt(words: DataFrame) -> DataFrame:
    """``word, n, m, lo, hi, key``: each word in the groups of its length and of the length below."""
    parts = F.expr(f"""flatten(transform(array(length(word), length(word) - 1), m -> transform(sequence(0, {SEGMENTS - 1}),
        i -> named_struct('m', m, 'lo', i * m div {SEGMENTS}, 'hi', (i + 1) * m div {SEGMENTS}))))""")
    rows = words.select("word", "n", F.explode(parts).alias("_p")).select(
        "word", "n", "_p.m", F.col("_p.lo").cast("int").alias("lo"), F.col("_p.hi").cast("int").alias("hi"))
    return rows.where("lo < hi").withColumn("key", _key())


def _split(rows: DataFrame, limit: int) -> DataFrame:
    """Halve the segments of groups that are too large until none is."""
    done = None
    while True:
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("_rows"), F.max("m").alias("_m"), F.max(F.expr("hi - lo")).alias("_free"))
        hot = cut_lineage(sizes.where((F.col("_free") > 1) & ((F.col("_rows") > limit) | (F.col("_rows") * F.col("_m") > CELLS))).select("key"))
        if hot.isEmpty():
            return rows if done is None else done.unionByName(rows)
        # plain joins: the hot keys are few rows, so that Spark sends them out, or else splits skewed partitions
        cold = rows.join(hot, "key", "left_anti")
        done = cold if done is None else done.unionByName(cold)
        middle = F.expr("(lo + hi) div 2").cast("int")
        halves = rows.join(hot, "key", "left_semi").withColumn("_half", F.explode(F.array(F.struct(F.col("lo").alias("a"), middle.alias("b")), F.struct(middle.alias("a"), F.col("hi").alias("b")))))
        rows = cut_lineage(halves.select("word", "n", "m", F.col("_half.a").alias("lo"), F.col("_half.b").alias("hi")).withColumn("key", _key()))


class Tile:
    """Words as code points, padded with zeros behind and before."""

    def __init__(self, words: list[str]):
        self.length = length = np.array([len(w) for w in words], np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        if len(points) and points.max() < 1 << 16:
            points = points.astype(np.uint16)
        self.width = width = int(length.max(initial=0))
        row = np.repeat(np.arange(len(words)), length)
        place = np.arange(len(points)) - np.repeat(np.cumsum(length) - length, length)
        self.left = np.zeros((len(words), width), points.dtype)
        self.left[row, place] = points
        self.right = np.zeros((len(words), width), points.dtype)
        self.right[row, width - length[row] + place] = points

    def prefix_of_near(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common prefix of each pair one edit apart, else -1. The words of a pair differ."""
        out = np.full(len(i), -1, np.int64)
        step = max(1, CELLS // max(1, self.width))
        for a in range(0, len(i), step):
            x, y = i[a:a + step], j[a:a + step]
            prefix = (self.left[x] != self.left[y]).argmax(1)
            suffix = (self.right[x] != self.right[y])[:, ::-1].argmax(1)
            longer = np.maximum(self.length[x], self.length[y])
            near = (prefix + suffix >= longer - 1) & (np.abs(self.length[x] - self.length[y]) <= 1)
            out[a:a + step] = np.where(near, prefix, -1)
        return out


def _pairs(words: list[str], group: np.ndarray, m: np.ndarray) -> Iterator[tuple[Tile, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of pairs within groups: a tile, places in it, and the places of its words; the first of a pair has length m."""
    n = len(words)
    width = max(map(len, words))
    ends = np.searchsorted(group, group, side="right")
    own = np.array([len(w) for w in words]) == m
    if n * width <= CELLS:
        tile, every = Tile(words), np.arange(n)
        left = np.where(own, ends - every - 1, 0)
        done = 0
        while done < n:
            # as many rows as give about CELLS / width pairs, each row against all behind it in its group
            total = np.cumsum(left[done:])
            stop = done + max(1, int(np.searchsorted(total, CELLS // max(1, width), side="right")))
            k = left[done:stop]
            i = np.repeat(every[done:stop], k)
            j = i + 1 + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
            yield tile, i, j, i, j
            done = stop
        return
    # one group over many blocks: pairs of blocks of rows
    rows = max(1, CELLS // (4 * width))
    blocks = [(a, min(a + rows, n)) for a in range(0, n, rows)]
    for x, (a, b) in enumerate(blocks):
        if not own[a:b].any():
            continue
        for c, d in blocks[x:]:
            tile = Tile(words[a:b] + words[c:d])
            i, j = (g.ravel() for g in np.meshgrid(np.arange(a, b), np.arange(c, d), indexing="ij"))
            kept = (i < j) & own[i] & (group[i] == group[j])
            i, j = i[kept], j[kept]
            yield tile, i - a, j - c + (b - a), i, j


def _sums(words: list[str], n: np.ndarray, key: np.ndarray, m: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Near words within complete groups, as one row per word: their number and the best one."""
    pairs = []
    for tile, i, j, x, y in _pairs(words, np.cumsum(np.append(False, key[1:] != key[:-1])), m):
        if not len(i):
            continue
        prefix = tile.prefix_of_near(i, j)
        # a pair belongs to the segment where its common prefix ends
        here = (prefix >= lo[x]) & ((prefix < hi[x]) | ((prefix == m[x]) & (hi[x] == m[x]))) & (m[x] == m[y]) & (lo[x] == lo[y]) & (hi[x] == hi[y])
        pairs.append((x[here], y[here]))
    a, b = (np.concatenate([p[s] for p in pairs] or [np.zeros(0, np.int64)]) for s in (0, 1))
    if not len(a):
        return
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    met = np.unique(b)
    rank = np.zeros(len(words), np.int64)
    rank[sorted(met.tolist(), key=words.__getitem__)] = np.arange(len(met))
    order = np.lexsort((rank[b], -n[b], a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
    yield pa.RecordBatch.from_arrays(
        [pa.array([words[k] for k in a[first]], pa.string()), pa.array(np.diff(np.append(first, len(a)))),
         pa.array(n[b[first]]), pa.array([words[k] for k in b[first]], pa.string())], names=["word", "n_near", "best_n", "best"])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by (m, key, length); blocks end where a group does."""
    held, cells = [], 0

    def complete(rest: bool):
        nonlocal held, cells
        table = pa.Table.from_batches(held)
        key = table["key"].to_numpy()
        stop = len(key) if rest else int(np.flatnonzero(key != key[-1])[-1]) + 1 if key[0] != key[-1] else 0
        ready, kept = table.slice(0, stop), table.slice(stop)
        held = kept.to_batches()
        cells = len(kept) * (int(kept["m"][0].as_py()) + 1) if len(kept) else 0
        if not stop:
            return
        words, key = ready["word"].to_pylist(), key[:stop]
        n, m, lo, hi = (ready[c].to_numpy().astype(np.int64) for c in ("n", "m", "lo", "hi"))
        # groups of one word are left out, and blocks of groups are cut to size
        met = np.zeros(stop, bool)
        same = key[1:] == key[:-1]
        met[1:] |= same
        met[:-1] |= same
        at = np.flatnonzero(met)
        if not len(at):
            return
        bounds = np.append(np.flatnonzero(np.append(True, key[at][1:] != key[at][:-1])), len(at))
        start = 0
        while start < len(bounds) - 1:
            size = (bounds[start + 1:] - bounds[start]) * (m[at[bounds[start + 1:] - 1]] + 1)
            end = start + max(1, int(np.searchsorted(size, CELLS, side="right")))
            rows = at[bounds[start]:bounds[end]]
            yield from _sums([words[k] for k in rows], n[rows], key[rows], m[rows], lo[rows], hi[rows])
            start = end

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        cells += batch.num_rows * (batch.column("m")[batch.num_rows - 1].as_py() + 1)
        if cells > CELLS:
            yield from complete(False)
    if held:
        yield from complete(True)


def near_words(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``word, n_near, best_n, best`` of every word with near words; equal ``best_n`` goes to the smaller word."""
    rows = _split(_dealt(words), limit).repartition("key").sortWithinPartitions("m", "key", F.length("word"))
    found = rows.mapInArrow(_compared, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("a"), F.col("best").alias("b"))).alias("_b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("_b.a")).alias("best_n"), F.col("_b.b").alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: forms followed to the last. Each round doubles the way, and counts grow ``ratio`` times a step, so rounds are few."""
    found = forms.select("word", F.col("form").alias("root"))
    while True:
        onward = found.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        stepped = cut_lineage(found.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")))
        found = stepped.select("word", "root")
        if stepped.where("_moved").isEmpty():
            return found


def variants(words: DataFrame, fewest: int = 2, ratio: int = 10, limit: int = LIMIT) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of a table ``word, n`` of different words.

    ``form`` is the near word with the most occurrences (the smaller of equals) if it has ``ratio`` times those of the word; ``root`` is the
    last of the forms that follow from a word. Words with fewer than ``fewest`` occurrences take no part.
    """
    counted = cut_lineage(words.select("word", "n").where((F.col("n") >= fewest) & (F.col("word") != "")))
    close = counted.join(near_words(counted, limit), "word", "left")
    is_form = F.col("best_n") >= ratio * F.col("n")
    close = cut_lineage(close.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                     F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")))
    roots = _roots(close.where(F.col("form").isNotNull()))
    return close.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
