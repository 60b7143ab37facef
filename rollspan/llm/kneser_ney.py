"""Quality by the perplexity of an interpolated modified Kneser-Ney bigram model of words.

Words are runs of letters and digits, or of other signs, with their case; each text ends with an end symbol. A
word's hash gives its class, one of ``CLASSES``; all words take part, and words that share a class count
together (on 0.5 GB of text most classes are taken: see README). So tables by
word have a bound, whatever the corpus, and are sent to all workers; the bigrams have none, and stay in shards.

With p(w|v) = (c(v,w) - D) / c(v) + g(v) p(w), log p(w|v) = log g(v) + log p(w) + gain(v,w), where the gain of an
unseen bigram is zero. A worker adds up the first two terms of its documents by itself. For the third, it sends
each shard the bigrams of a block of documents, each once, with the documents that hold it; the shard looks up its
counts, answers with one sum per document, and the sums meet by block. Texts aren't shuffled for scoring.
Bigrams that make up over ``HEAVY`` of trusted text, at most 1 / HEAVY, are sent to the workers and don't travel.

The model is trained on seven eighths of the trusted documents, dealt by hash of their id. The others are the measure: a
document is accepted if its perplexity is at most the quantile over them in its language (documents that
the model has seen would look too good). A language with too few of them takes the quantile over all.

Cases: a null or empty text has no perplexity and isn't accepted, one of blanks only has that of the end symbol; a
null language is a language of its own; repeated rows score alike; repeated labels count once; without
trusted text the model is uniform and nothing is rejected but empty texts; an empty table gives no rows; other
columns aren't read, and :func:`drop_poor` keeps them whatever their names. Documents should be a stored table: a row is
known by its place in the scan.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from rollspan.llm.frames import give_back, slices, task, utf8, with_row_ids
from rollspan.session import cut_lineage, with_scalars

#: Word classes: 0 starts a text, 1 ends it, the others are hashes of words.
CLASSES = 1 << 20
#: Bits of a bigram's key, and of a document's number in its block.
KEY_BITS, DOC_BITS = 40, 24
#: Bytes of text in a block, and bytes of text for which there is one shard.
BLOCK, SHARD = 8 << 20, 512 << 20
#: Share of trusted text from which on a bigram is sent to all workers.
HEAVY = 1e-6
#: Bins of a quantile: thousandths of the mean negative log-likelihood.
BIN = 1000
#: Ranges of word classes that are added up apart.
PARTS = 16

#: Bits and hashes of the filter that finds trusted texts in the scan, and most ids of others which it lets pass that workers are told.
FILTER_BITS, FILTER_HASHES, STRANGERS = 1 << 26, 6, 1 << 18

_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\s]+")
#: An odd factor spreads bigrams evenly over the keys; its inverse gives the bigram back.
_MIX = 0x9E3779B97F
_UNMIX = pow(_MIX, -1, 1 << KEY_BITS)
_MASK = np.uint64((1 << KEY_BITS) - 1)


def pack(*arrays: np.ndarray) -> bytes:
    """Unsigned arrays as compressed byte planes."""
    sizes = np.array([len(arrays), *map(len, arrays)], np.uint64).tobytes()
    planes = [np.ascontiguousarray(a, np.uint64).view(np.uint8).reshape(-1, 8).T.tobytes() for a in arrays]
    return zstandard.compress(b"".join([sizes, *planes]), 3)


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.decompress(blob), np.uint8)
    k = int(raw[:8].view(np.uint64)[0])
    out, at = [], 8 * (k + 1)
    for n in raw[8:at].view(np.uint64).astype(int):
        out.append(np.ascontiguousarray(raw[at:at + 8 * n].reshape(8, n).T).view(np.uint64).ravel())
        at += 8 * n
    return out


def steps(sorted_values: np.ndarray) -> np.ndarray:
    return np.diff(sorted_values.astype(np.uint64), prepend=np.uint64(0))


def word_pairs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first classes, second classes, predictions of each text), text after text."""
    found = [_WORD.findall(t) for t in texts]
    n = np.array([len(f) + 1 for f in found], np.int64)
    digest = xxhash.xxh32_intdigest
    hashes = np.fromiter((digest(w) for f in found for w in f), np.int64, int(n.sum()) - len(n))
    ends = np.cumsum(n)
    second = np.ones(int(n.sum()), np.int64)
    inner = np.ones(len(second), bool)
    inner[ends - 1] = False
    second[inner] = 2 + hashes % (CLASSES - 2)
    first = np.zeros(len(second), np.int64)
    first[1:] = second[:-1]
    first[ends - n] = 0
    return first, second, n


def keys_of(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return ((first * CLASSES + second).astype(np.uint64) * np.uint64(_MIX)) & _MASK


def classes_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    pair = ((keys * np.uint64(_UNMIX)) & _MASK).astype(np.int64)
    return pair // CLASSES, pair % CLASSES


def shard_bounds(keys: np.ndarray, shards: int) -> np.ndarray:
    """Places where sorted keys pass from one shard to the next; ``shards`` is a power of two."""
    return np.searchsorted(keys, np.arange(shards + 1, dtype=np.uint64) << np.uint64(KEY_BITS - shards.bit_length() + 1))


def shards_for(docs: DataFrame, text: str) -> int:
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return min(1 << 22, max(64, 1 << int(size // SHARD).bit_length()))


def blocks(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[pa.Table, list[bytes]]]:
    """Rows of about ``BLOCK`` bytes of text at a time."""
    held, texts, size = [], [], 0
    for batch in batches:
        own = utf8(batch.column(text))
        held.append(batch.drop_columns([batch.schema.names[text]]) if batch.num_columns > 1 else batch)
        texts += own
        size += sum(map(len, own)) + len(own)
        if size >= BLOCK:
            yield pa.Table.from_batches(held), texts
            held, texts, size = [], [], 0
            give_back()
    if held:
        yield pa.Table.from_batches(held), texts


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def added_up(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


@task
def _block_counts(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    for _, texts in blocks(batches, 0):
        found = [keys_of(*word_pairs(texts[a:b])[:2]) for a, b in slices(texts, 1_000_000)]
        keys, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *found]), return_counts=True)
        cuts = shard_bounds(keys, shards)
        own = np.flatnonzero(np.diff(cuts))
        bodies = [pack(steps(keys[cuts[s]:cuts[s + 1]]), n[cuts[s]:cuts[s + 1]]) for s in own]
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(bodies, pa.binary())], names=["shard", "body"])


@task
def _shard_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All counts of each shard, added up whenever as many new ones have come as there are."""
    for shard, rows in groupby(rows_of(batches), lambda r: r[0]):
        keys, counts, more, waiting = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0
        for _, body in rows:
            d, n = unpack(body)
            more.append((np.cumsum(d, dtype=np.uint64), n.astype(np.int64)))
            waiting += len(d)
            if waiting > max(1_000_000, len(keys)):
                keys, counts = added_up(*(np.concatenate(x) for x in zip((keys, counts), *more)))
                more, waiting = [], 0
        keys, counts = added_up(*(np.concatenate(x) for x in zip((keys, counts), *more)))
        kinds = [int((counts == i).sum()) for i in (1, 2, 3, 4)]
        yield pa.RecordBatch.from_pydict({"shard": [shard], "body": [pack(steps(keys), counts)], **{f"n{i + 1}": [k] for i, k in enumerate(kinds)},
                                          "total": [int(counts.sum())]})


def unpack_counts(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    d, n = unpack(body)
    return np.cumsum(d, dtype=np.uint64), n.astype(np.int64)


@task
def _class_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """By class: total as a first word, kinds of bigrams seen once, twice and more, and kinds of words before it."""
    sums = np.zeros((5, CLASSES), np.int64)
    for body, in rows_of(batches):
        keys, n = unpack_counts(body)
        v, w = classes_of(keys)
        sums[0] += np.bincount(v, n, CLASSES).astype(np.int64)
        for i, chosen in ((1, n == 1), (2, n == 2), (3, n > 2)):
            sums[i] += np.bincount(v[chosen], minlength=CLASSES)
        sums[4] += np.bincount(w, minlength=CLASSES)
    own = sums.reshape(5, PARTS, -1)
    yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array([pack(*own[:, i]) for i in range(PARTS)], pa.binary())],
                                     names=["part", "body"])


@task
def _parts_added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, rows in groupby(rows_of(batches), lambda r: r[0]):
        total = np.zeros((5, CLASSES // PARTS), np.uint64)
        for _, body in rows:
            total += np.stack(unpack(body))
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([pack(*total)], pa.binary())], names=["part", "body"])


@task
def _heavy(batches: Iterator[pa.RecordBatch], least: float) -> Iterator[pa.RecordBatch]:
    for body, in rows_of(batches):
        keys, n = unpack_counts(body)
        chosen = n >= least
        yield pa.RecordBatch.from_arrays([pa.array(keys[chosen].astype(np.int64)), pa.array(n[chosen])], names=["key", "n"])


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """Discounts of counts 0 to 3 (and more) from the counts of counts, kept off nothing and all."""
    n = [0, n1, n2, n3, n4]
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    raw = [i - (i + 1) * y * n[i + 1] / n[i] if n1 and n[i] else i / 2 for i in (1, 2, 3)]
    return np.array([0.0, *(min(max(d, 0.1 * i), 0.95 * i) for i, d in zip((1, 2, 3), raw))])


@dataclass
class Tables:
    """What all workers have: bounded by ``CLASSES`` and ``HEAVY``."""

    log_share: np.ndarray  # log g(v)
    log_p: np.ndarray      # log p(w)
    total: np.ndarray      # c(v)
    discount: np.ndarray
    follows: np.ndarray    # whether w comes after any word
    heavy: np.ndarray      # sorted keys
    heavy_gain: np.ndarray

    def gain(self, keys: np.ndarray, n: np.ndarray) -> np.ndarray:
        v, w = classes_of(keys)
        above = (n - self.discount[np.minimum(n, 3)]) / self.total[v]
        return np.log1p(above * np.exp(-(self.log_share[v].astype(np.float64) + self.log_p[w])))


@dataclass
class Model:
    counts: DataFrame  # one row per shard
    shards: int
    tables: Tables


def trusted_ids(labels: DataFrame, doc_id: str = "doc_id", label: str = "quality") -> DataFrame:
    """``_id`` and ``measures``, whether it is of the eighth that isn't trained on."""
    ids = labels.where((F.col(label) == 1) & F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("_id")).distinct()
    return ids.withColumn("measures", F.expr("pmod(xxhash64(_id), 8) = 0"))


def _sifted(batches: Iterator[pa.RecordBatch], sieve, columns: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bits, strangers = sieve.value
        there = ~_found(batch.column("_id").to_numpy(), strangers)[1]
        for i in range(FILTER_HASHES):
            at = batch.column(f"_p{i}").to_numpy()
            there &= (bits[at >> 6] >> (at & 63)) & 1 == 1
        yield batch.select(columns).filter(pa.array(there))


def _sifted_counts(batches: Iterator[pa.RecordBatch], sieve, shards: int) -> Iterator[pa.RecordBatch]:
    return _block_counts(_sifted(batches, sieve, ["text"]), shards)


def block_counts(texts: DataFrame, ids: DataFrame, shards: int) -> DataFrame:
    """Counts by block and shard of the bigrams of all rows of ``texts`` (``_id``, ``text``) whose id is in ``ids``, one row per id.

    A filter of 8 MB, whatever the corpus, is sent to the workers and lets these rows pass, and some others. The ids of the others are found
    without their texts. While they are at most ``STRANGERS``, they are sent to the workers, and no text is shuffled; if there are more (with
    over 10 million trusted documents), the texts that pass the filter are shuffled to ``ids``.
    """
    places = [F.expr(f"pmod(xxhash64(_id, {k}), {FILTER_BITS}L)").alias(f"_p{k}") for k in range(FILTER_HASHES)]
    found = (ids.select(F.explode(F.array(*places)).alias("p")).groupBy(F.expr("p div 64").alias("word"))
                .agg(F.expr("bit_or(shiftleft(1L, cast(p % 64 as int)))").alias("bits")).toPandas())
    bits = np.zeros(FILTER_BITS // 64, np.int64)
    bits[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64)
    send = texts.sparkSession.sparkContext.broadcast
    sieve = send((bits, np.zeros(0, np.int64)))
    known = texts.where(F.col("_id").isNotNull())
    passed = known.select("_id", *places).mapInArrow(partial(_sifted, sieve=sieve, columns=["_id"]), "_id long")
    strangers = passed.join(ids, "_id", "left_anti").distinct().limit(STRANGERS + 1).toPandas()["_id"].to_numpy(np.int64)
    placed = known.where("length(text) > 0").select("_id", "text", *places)
    if len(strangers) <= STRANGERS:
        return placed.mapInArrow(partial(_sifted_counts, sieve=send((bits, np.sort(strangers))), shards=shards), _COUNTED)
    whole = placed.mapInArrow(partial(_sifted, sieve=sieve, columns=["_id", "text"]), "_id long, text string").join(ids, "_id", "left_semi")
    return whole.select("text").mapInArrow(partial(_block_counts, shards=shards), _COUNTED)


_COUNTED = "shard long, body binary"


def fit(docs: DataFrame, trusted: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Model:
    spark = docs.sparkSession
    shards = shards_for(docs, text)
    texts = docs.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("text"))
    sent = block_counts(texts, trusted.where("not measures").select("_id"), shards)
    counts = cut_lineage(sent.repartition("shard").sortWithinPartitions("shard")
                             .mapInArrow(_shard_counts, "shard long, body binary, n1 long, n2 long, n3 long, n4 long, total long"), drops_shuffles=True)
    kinds = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n1", "n2", "n3", "n4", "total")]).first()
    parts = (counts.select("body").mapInArrow(_class_counts, "part int, body binary").repartition("part").sortWithinPartitions("part")
                   .mapInArrow(_parts_added, "part int, body binary").collect())  # PARTS rows
    sums = np.zeros((5, PARTS, CLASSES // PARTS), np.int64)
    for r in parts:
        sums[:, r.part] = np.stack(unpack(bytes(r.body)))
    total, *seen, before = sums.reshape(5, CLASSES)
    d2 = discounts(*kinds[:4])
    d1 = discounts(*(int((before == i).sum()) for i in (1, 2, 3, 4)))
    everything = max(1, int(before.sum()))
    rest = d1[np.minimum(before, 3)].sum() / everything if before.any() else 1.0
    p = (before - d1[np.minimum(before, 3)]) / everything + rest / CLASSES
    share = np.where(total > 0, sum(d * k for d, k in zip(d2[1:], seen)) / np.maximum(total, 1), 1.0)
    tables = Tables(np.log(share).astype(np.float32), np.log(p).astype(np.float32), total.astype(np.float32), d2, before > 0, np.zeros(0, np.uint64), np.zeros(0))
    found = counts.select("body").mapInArrow(partial(_heavy, least=max(1.0, kinds[4] * HEAVY)), "key long, n long").toPandas()  # 1 / HEAVY rows
    keys = np.sort(found["key"].to_numpy().astype(np.uint64))
    n = found.sort_values("key")["n"].to_numpy().astype(np.int64)
    tables.heavy, tables.heavy_gain = keys, tables.gain(keys, n)
    return Model(counts, shards, tables)


def _found(keys: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places in ``among``, whether there)."""
    if not len(among):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(among, keys), len(among) - 1)
    return at, among[at] == keys


_ASKED = "shard long, block long, rids array<long>, ids array<long>, langs array<string>, body binary"
_ASKED_ARROW = pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("rids", pa.list_(pa.int64())), ("ids", pa.list_(pa.int64())),
                          ("langs", pa.list_(pa.string())), ("body", pa.binary())])


@task
def _asked(batches: Iterator[pa.RecordBatch], tables, shards: int) -> Iterator[pa.RecordBatch]:
    """Per block: a row with what the worker has added up, and one row for each shard that is asked."""
    m: Tables = tables.value
    part = TaskContext.get().partitionId() if TaskContext.get() else 0
    for number, (rows, texts) in enumerate(blocks(batches, 3)):
        block = (part << 32) + number
        own, sizes, pairs = [], [], [np.zeros(0, np.uint64)]
        for a, b in slices(texts, 1_000_000):
            v, w, n = word_pairs(texts[a:b])
            logs = m.log_share[v].astype(np.float64) + m.log_p[w]
            keys, doc = keys_of(v, w), np.repeat(np.arange(b - a), n)
            at, there = _found(keys, m.heavy)
            logs[there] += m.heavy_gain[at[there]]
            own.append(np.add.reduceat(logs, np.cumsum(n) - n))
            sizes.append(np.where(np.array(list(map(len, texts[a:b]))) > 0, n, 0))
            open_ = ~there & (m.total[v] > 0) & m.follows[w]  # others are unseen for certain
            pairs.append(keys[open_] << np.uint64(DOC_BITS) | (doc[open_] + a).astype(np.uint64))
        places = np.concatenate(pairs)
        del pairs
        places.sort()
        once = np.flatnonzero(np.r_[True, places[1:] != places[:-1]]) if len(places) else np.zeros(0, np.int64)
        n, places = np.diff(np.append(once, len(places))).astype(np.uint32), places[once]
        del once
        doc = (places & np.uint64((1 << DOC_BITS) - 1)).astype(np.uint32)
        places >>= np.uint64(DOC_BITS)
        keys = places
        del places
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
        holders = np.diff(np.append(first, len(keys))).astype(np.uint32)
        cuts, wide = shard_bounds(keys[first], shards), shard_bounds(keys, shards)
        named = [list(x) for x in (rows.column(i).to_pylist() for i in range(3))]
        out = [(-1 - block, block, *named, pack(np.concatenate(own).view(np.uint64), np.concatenate(sizes)))] if texts else []
        for s in np.flatnonzero(np.diff(cuts)):
            a, b, c, d = cuts[s], cuts[s + 1], wide[s], wide[s + 1]
            out.append((int(s), block, None, None, None, pack(steps(keys[first[a:b]]), holders[a:b], doc[c:d], n[c:d])))
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), _ASKED_ARROW)], schema=_ASKED_ARROW)


@task
def _answered(batches: Iterator[pa.RecordBatch], tables) -> Iterator[pa.RecordBatch]:
    """Sums of the gains by document; a shard's counts come before what it is asked."""
    held, keys, gains = None, None, None
    for shard, block, rids, ids, langs, body in rows_of(batches):
        if block < 0:
            keys, n = unpack_counts(body)
            held, gains = shard, tables.value.gain(keys, n)
            continue
        if shard >= 0:
            if held != shard:
                continue  # no trusted text has any bigram of this shard
            d, holders, doc, n = unpack(body)
            at, there = _found(np.cumsum(d, dtype=np.uint64), keys)
            each = np.repeat(np.where(there, gains[at], 0.0), holders.astype(np.int64)) * n
            sums = np.bincount(doc.astype(np.int64), each)
            some = np.flatnonzero(sums)
            body = pack(steps(some), sums[some].astype(np.float32).view(np.uint32))
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((shard, block, rids, ids, langs, body), _ASKED_ARROW)], schema=_ASKED_ARROW)


@task
def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, rows in groupby(rows_of(batches), lambda r: r[1]):
        _, _, rids, ids, langs, body = next(rows)  # what the worker has added up has a number below zero
        logs, n = unpack(body)
        logs = logs.view(np.float64).copy()
        for *_, body in rows:
            d, x = unpack(body)
            logs[np.cumsum(d, dtype=np.uint64).astype(np.int64)] += x.astype(np.uint32).view(np.float32)
        nll = np.divide(-logs, n, out=np.full(len(logs), np.nan), where=n > 0)
        yield pa.RecordBatch.from_arrays([pa.array(rids, pa.int64()), pa.array(ids, pa.int64()), pa.array(langs, pa.string()),
                                          pa.array(nll, pa.float64(), from_pandas=True)], names=["rid", "doc_id", "lang", "nll"])


def score_documents(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", rid: str | None = None) -> DataFrame:
    """``rid`` (column ``rid``, or the row's place in the scan), ``doc_id``, ``lang``, ``nll`` (mean over words and the end) of every row."""
    tables = docs.sparkSession.sparkContext.broadcast(model.tables)  # at most 30 MB, whatever the corpus
    narrow = docs.select((F.col(rid) if rid else F.monotonically_increasing_id()).alias("rid"), F.col(doc_id).cast("long").alias("doc_id"), F.col(lang).alias("lang"),
                         F.col(text).alias("text"))
    asked = narrow.mapInArrow(partial(_asked, tables=tables, shards=model.shards), _ASKED)
    none = F.lit(None)
    counts = model.counts.select("shard", F.lit(-1).cast("long").alias("block"), none.cast("array<long>").alias("rids"),
                                 none.cast("array<long>").alias("ids"), none.cast("array<string>").alias("langs"), "body")
    met = asked.unionByName(counts).repartition("shard").sortWithinPartitions("shard", "block")
    answers = met.mapInArrow(partial(_answered, tables=tables), _ASKED)
    return (answers.repartition("block").sortWithinPartitions("block", "shard")
                   .mapInArrow(_scored, "rid long, doc_id long, lang string, nll double"))


def thresholds(scored: DataFrame, trusted: DataFrame, quantile: float, min_share: float = 1e-4, min_docs: int = 20) -> DataFrame:
    """``lang``, ``limit`` and one row without language but ``everyone``: quantiles of ``nll`` of trusted documents that measure.

    Exact over bins of a thousandth. Languages with under ``min_share`` of these documents,
    or under ``min_docs``, have no row, so there are at most 1 / min_share rows.
    """
    known = scored.where(F.col("nll").isNotNull()).join(trusted.where("measures"), scored.doc_id == trusted._id, "left_semi")
    bins = known.groupBy("lang", F.ceil(F.col("nll") * BIN).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    both = bins.withColumn("everyone", F.lit(False)).unionByName(
        bins.groupBy("bin").agg(F.sum("n").alias("n")).select(F.lit(None).cast("string").alias("lang"), "bin", "n", F.lit(True).alias("everyone")))
    by = Window.partitionBy("everyone", "lang")
    cut = (both.withColumn("_total", F.sum("n").over(by))
               .withColumn("_upto", F.sum("n").over(by.orderBy("bin")))
               .where(F.col("_upto") >= F.col("_total") * quantile)
               .groupBy("everyone", "lang").agg((F.min("bin") / BIN).alias("limit"), F.max("_total").alias("n")))
    whole = cut.where("everyone").agg(F.max("n").alias("_all"))
    return with_scalars(cut, whole).where(F.col("everyone") | ((F.col("n") >= min_docs) & (F.col("n") >= F.col("_all") * min_share))).select("everyone", "lang", "limit")


def _judged(docs: DataFrame, labels: DataFrame, quantile: float, doc_id: str, text: str, lang: str, rid: str | None = None) -> DataFrame:
    trusted = trusted_ids(labels, doc_id)
    scored = cut_lineage(score_documents(docs, fit(docs, trusted, doc_id, text), doc_id, text, lang, rid), drops_shuffles=True)
    limits = cut_lineage(thresholds(scored, trusted, quantile))
    everyone = limits.where("everyone").agg(F.max("limit").alias("_everyone"))
    own = limits.where(~F.col("everyone")).select(F.col("lang").alias("_lang"), "limit")
    # at most 1 / min_share rows
    joined = with_scalars(scored.join(F.broadcast(own), scored.lang.eqNullSafe(own._lang), "left"), everyone)
    limit = F.coalesce("limit", "_everyone")
    return joined.select("rid", "doc_id", "lang", F.exp("nll").alias("perplexity"), F.exp(limit).alias("limit"),
                         F.coalesce(F.col("nll") <= F.coalesce(limit, F.lit(float("inf"))), F.lit(False)).alias("accepted"))


def classify(docs: DataFrame, labels: DataFrame, quantile: float = 0.99, doc_id: str = "doc_id", text: str = "text",
             lang: str = "lang") -> DataFrame:
    """``doc_id``, ``lang``, ``perplexity``, ``limit`` and ``accepted`` of every row."""
    return _judged(docs, labels, quantile, doc_id, text, lang).drop("rid")


def drop_poor(docs: DataFrame, labels: DataFrame, quantile: float = 0.99, doc_id: str = "doc_id", text: str = "text",
              lang: str = "lang") -> DataFrame:
    """Accepted rows with all their columns, whatever their names. Rows are known by their place in the files (:func:`with_row_ids`)."""
    rid = "_rid" + "_" * max(map(len, docs.columns))
    placed = with_row_ids(docs, rid)
    kept = _judged(placed, labels, quantile, doc_id, text, lang, rid).where("accepted")
    return placed.join(kept.select(F.col("rid").alias(rid)), rid, "left_semi").select(*docs.columns)
