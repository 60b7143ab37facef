"""SimHash near-duplicate detection with BK-trees.

A document's 64-bit fingerprint holds, bit by bit, the majority over the XXH64 hashes of its word shingles.
Only distinct fingerprints are compared. They are dealt to shards such that two within the radius meet in
at least one: the 64 bits are cut into radius + 2 parts, at most ``radius`` of which can differ, and each
pair of parts makes a shard. Each shard's BK-tree is searched within the radius. A shard of more
than ``tree_rows`` rows is dealt to several trees, and each pair of those meets in a task of its own.
A task reports only as many links as connect what it found, so a group of copies of any size
gives links in proportion to its rows; components of all links follow by star contractions.

Cases: a null or empty text, or one of blanks only, has fingerprint zero and is linked like
any other; a text shorter than a shingle is one shingle; repeated rows and exact copies share a
fingerprint; null ids are kept but never chosen as a component's id unless it has no other; an empty
table gives no rows; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from rollspan.llm.bktree import linked
from rollspan.llm.components import connected_components
from rollspan.llm.frames import slices, task, utf8, with_row_ids
from rollspan.session import cut_lineage

SEED = 42


def shingle_hashes(text: bytes, size: int, seed: int = SEED) -> list[int]:
    """XXH64 of each word shingle; A-Z are lower-cased, words end at ASCII white space."""
    words = text.lower().split()
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return [digest(joined, seed)] if words else []
    starts, at = [], 0
    for w in words:
        starts.append(at)
        at += len(w) + 1
    ends = [*(s - 1 for s in starts[size:]), at - 1]
    return [digest(joined[a:b], seed) for a, b in zip(starts, ends)]


def hash_slices(texts: list[bytes], size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashes of all shingles one after another, number of each text), some texts at a time."""
    for a, b in slices(texts, 1_000_000):
        found = [shingle_hashes(t, size) for t in texts[a:b]]
        yield np.fromiter((h for f in found for h in f), np.uint64, sum(map(len, found))), np.array(list(map(len, found)), np.int64)


def majority_bits(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprints: a bit is set if it is in over half of a text's hashes."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        starts = (np.cumsum(counts) - counts)[full]
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        packed = np.packbits(ones * 2 > counts[full, None], axis=1, bitorder="little")
        out[full] = np.ascontiguousarray(packed).view("<u8").ravel()
    return out


@task
def _prints(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [majority_bits(h, n) for h, n in hash_slices(utf8(batch.column(1)), size)]
        prints = np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints)], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame, size: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint's 64 bits as a long."""
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(partial(_prints, size=size), "doc_id long, fp long")


def band_masks(radius: int) -> list[int]:
    """Masks of all pairs of radius + 2 parts of the 64 bits."""
    cuts = np.linspace(0, 64, radius + 3).round().astype(int).tolist()
    parts = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]
    return [x | y for x, y in combinations(parts, 2)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def shard_rows(items: DataFrame, shards, tree_rows: int, weight=None) -> DataFrame:
    """Deal items to shards of at least two; ``shards`` is an array column of shard numbers.

    Adds ``shard`` and ``is_member``. A shard of n rows over ``tree_rows`` becomes parts = n / tree_rows
    trees; task (i, j) holds the tree of part i and probes it with part j. ``weight`` is what a row counts, one if not given.
    """
    keyed = items.withColumn("_key", F.explode(shards))
    full = (keyed.groupBy("_key").agg(F.sum(F.lit(1) if weight is None else weight).alias("_n"), F.count(F.lit(1)).alias("_rows"))
                 .where("_rows > 1").drop("_rows"))
    dealt = keyed.join(full, "_key")
    parts = F.expr(f"cast((_n + {tree_rows - 1}) div {tree_rows} as int)")
    dealt = dealt.withColumn("_parts", parts).withColumn("_own", F.expr("pmod(xxhash64(fp, 7), _parts)"))
    tasks = F.expr("transform(sequence(0, _parts - 1), x -> named_struct('i', least(x, _own), 'j', greatest(x, _own)))")
    dealt = dealt.withColumn("_task", F.when(F.col("_parts") == 1, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"))))
                             .otherwise(tasks))
    dealt = dealt.withColumn("_task", F.explode("_task"))
    # the task of parts i and j: part i are its nodes, part j its probes
    return dealt.select(*items.columns, F.xxhash64("_key", "_task.i", "_task.j").alias("shard"),
                        (F.col("_task.i") == F.col("_own")).alias("is_member"))


def in_shards(rows: DataFrame, work: Callable, schema: str) -> DataFrame:
    """Run ``work`` on Arrow tables of whole shards, members before probes."""
    return rows.repartition("shard").sortWithinPartitions("shard", F.col("is_member").desc(), "fp").mapInArrow(work, schema)


def whole_shards(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.Table]:
    """Join batches so that no shard is cut; only the last shard of a batch waits for the next."""
    held: pa.Table | None = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        held = t if held is None else pa.concat_tables([held, t])
        shard = held.column(column).to_numpy()
        if len(shard) and shard[0] != shard[-1]:
            cut = int(np.flatnonzero(shard != shard[-1])[-1]) + 1
            yield held.slice(0, cut).combine_chunks()
            held = held.slice(cut).combine_chunks()
    if held is not None and held.num_rows:
        yield held.combine_chunks()


def _links(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    for t in whole_shards(batches, 1):
        prints, shard, member = (c.to_numpy() for c in t.columns)
        root = linked(shard, prints.view(np.uint64), member, radius).of
        far = np.flatnonzero(root != np.arange(len(root)))
        yield pa.RecordBatch.from_arrays([pa.array(prints[far]), pa.array(prints[root[far]])], names=["a", "b"])


def print_links(prints: DataFrame, radius: int, tree_rows: int = 4096) -> DataFrame:
    """Links (a, b) that connect all distinct ``fp`` within ``radius`` bits of each other."""
    shards = F.array(*[F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(_signed(m)))) for k, m in enumerate(band_masks(radius))])
    rows = shard_rows(prints.select("fp"), shards, tree_rows).select("fp", "shard", "is_member")
    return in_shards(rows, partial(_links, radius=radius), "a long, b long")


def near_duplicates(docs: DataFrame, size: int = 4, radius: int = 4, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``, the smallest id reachable."""
    prints = cut_lineage(fingerprints(docs, size, doc_id, text))
    groups = prints.groupBy("fp").agg(F.min("doc_id").alias("_least"))
    roots = connected_components(print_links(groups, radius))
    # linked fingerprints only: the rest are components of their own
    linked_groups = groups.join(roots, groups.fp == roots.node).select("fp", "root", "_least")
    whole = linked_groups.unionByName(roots.select("root").distinct().join(groups, F.col("root") == groups.fp).select("fp", "root", "_least"))
    ids = whole.groupBy("root").agg(F.min("_least").alias("_id"))
    reached = whole.join(ids, "root").select("fp", "_id")
    component = groups.join(reached, "fp", "left").select("fp", F.coalesce("_id", "_least").alias("component_id"))
    return (prints.join(component, "fp")
                  .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


#: Min-hashes of a text, and those of a band; 20 bands miss a pair of similarity 0.8 once in 40,000.
PERMUTATIONS, BANDS, BAND = 128, 20, 4
#: Least share of equal min-hashes of a candidate; a pair of similarity 0.8 (standard error 0.035) falls below it once in 60,000.
LOOSE = 0.65
#: Bytes of text in one tree of candidates, and pairs of a tree that are looked at together: at 24 bits a probe meets most of it.
TREE_BYTES, PAIRS = 16 << 20, 1 << 18
_FACTORS = np.random.default_rng(7).integers(1, 1 << 63, PERMUTATIONS, np.uint64) * np.uint64(2) + np.uint64(1)


def min_hashes(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """(texts, permutations) least of the multiplied hashes; all ones for a text without words."""
    out = np.full((len(counts), PERMUTATIONS), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(counts)
    if len(full):
        starts = (np.cumsum(counts) - counts)[full]
        for p, factor in enumerate(_FACTORS):
            out[full, p] = np.minimum.reduceat(hashes * factor, starts) >> np.uint64(32)
    return out


@task
def _sketches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = utf8(batch.column(2))
        prints, sigs = [], []
        for h, n in hash_slices(texts, size):
            prints.append(majority_bits(h, n))
            sigs += [row.tobytes() for row in min_hashes(h, n)]
        same = [xxhash.xxh3_128_digest(b" ".join(t.lower().split())) for t in texts]
        prints = np.concatenate([np.zeros(0, np.uint64), *prints]).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(same, pa.binary()), pa.array(prints), pa.array(sigs, pa.binary()),
                                          pa.array(list(map(len, texts)), pa.int64())],
                                         names=["rid", "doc_id", "same", "fp", "sig", "n_bytes"])


def _alike(t: pa.Table) -> Callable:
    """Whether enough min-hashes of rows i and j are equal."""
    sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint32).reshape(-1, PERMUTATIONS)
    return lambda i, j: (sig[i] == sig[j]).mean(axis=1) >= LOOSE


def _far(rid: np.ndarray, root: np.ndarray) -> pa.RecordBatch:
    far = np.flatnonzero(root != np.arange(len(root)))
    return pa.RecordBatch.from_arrays([pa.array(rid[far]), pa.array(rid[root[far]])], names=["a", "b"])


@task
def _candidates(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    for t in whole_shards(batches, 1):
        prints, shard, member, rid = (t.column(c).to_numpy() for c in ("fp", "shard", "is_member", "rid"))
        yield _far(rid, linked(shard, prints.view(np.uint64), member, radius, _alike(t), asked=10_000, pairs=PAIRS).of)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two sorted arrays of distinct hashes."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / max(1, len(a) + len(b) - both)


@task
def _similar(batches: Iterator[pa.RecordBatch], radius: int, size: int, similarity: float) -> Iterator[pa.RecordBatch]:
    for t in whole_shards(batches, 1):
        prints, shard, member, rid = (t.column(c).to_numpy() for c in ("fp", "shard", "is_member", "rid"))
        sets = [np.unique(h[a:b]) for x in utf8(t.column("text").combine_chunks()) for h, n in hash_slices([x], size) for a, b in [(0, n[0])]]
        lengths, alike = np.array(list(map(len, sets))), _alike(t)

        def accept(i, j, sets=sets, lengths=lengths, alike=alike):
            ok = np.minimum(lengths[i], lengths[j]) >= similarity * np.maximum(lengths[i], lengths[j]) - 1e-9
            ok[ok] = alike(i[ok], j[ok])
            ok[ok] = [jaccard(sets[a], sets[b]) >= similarity for a, b in zip(i[ok].tolist(), j[ok].tolist())]
            return ok
        yield _far(rid, linked(shard, prints.view(np.uint64), member, radius, accept, asked=2_000, pairs=PAIRS).of)


def drop_copies(docs: DataFrame, size: int = 5, radius: int = 24, similarity: float = 0.8, tree_rows: int = 4096,
                doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of exact and near copies, with all its columns: that of the smallest id.

    A pair of texts whose sets of 5-word shingles are 0.8 alike lies up to 20 bits apart, where no cut of 64
    bits makes small shards. Candidates come from bands of min-hashes: each band's BK-tree gives the pairs within
    ``radius``, of which those with enough equal min-hashes (``LOOSE``) are linked. Any pair found lies within one
    component of these links. The texts of each component then meet once; its BK-tree is searched again, and a pair counts if
    the sets of its shingles' hashes are at least ``similarity`` alike. Texts equal but for case and white space share a
    group before that.

    Rows are known by their place in the files of ``docs`` (:func:`with_row_ids`). A null id comes
    after all others; texts without words form one group; extra columns are returned as they are, whatever their names.
    """
    own_rid = "_rid" + "_" * max(map(len, docs.columns))
    placed = with_row_ids(docs, own_rid)
    narrow = placed.select(F.col(own_rid).alias("rid"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sketches = cut_lineage(narrow.mapInArrow(partial(_sketches, size=size), "rid long, doc_id long, same binary, fp long, sig binary, n_bytes long"))
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "rid")
    firsts = cut_lineage(sketches.groupBy("same").agg(F.min(order).alias("first")))
    items = sketches.join(firsts.select(F.col("first.rid").alias("rid"), "first"), "rid").select("rid", "fp", "sig", "n_bytes")
    shards = F.array(*[F.xxhash64(F.lit(k), F.substring("sig", 1 + 4 * BAND * k, 4 * BAND)) for k in range(BANDS)])
    narrow_items = items.select("rid", "fp", shards.alias("_shards"))
    rows = shard_rows(narrow_items, F.col("_shards"), tree_rows).select("rid", "fp", "shard", "is_member")
    rows = rows.join(items.select("rid", "sig"), "rid").select("rid", "shard", "fp", "is_member", "sig")
    loose = connected_components(in_shards(rows, partial(_candidates, radius=radius), "a long, b long"))
    grouped = loose.unionByName(loose.select(F.col("root").alias("node"), "root").distinct()).withColumnRenamed("node", "rid")
    share = F.greatest(F.lit(1), F.expr(f"n_bytes * {tree_rows} div {TREE_BYTES}"))
    grouped = cut_lineage(shard_rows(grouped.join(items, "rid").select("rid", "fp", "sig", "root", share.alias("_weight")), F.array("root"), tree_rows, F.col("_weight"))
                          .select("rid", "shard", "fp", "is_member", "sig"))
    rows = grouped.join(narrow.select("rid", "text"), "rid").select("rid", "shard", "fp", "is_member", "sig", "text")
    links = in_shards(rows, partial(_similar, radius=radius, size=size, similarity=similarity), "a long, b long")
    roots = connected_components(links)
    own = firsts.select(F.col("first.rid").alias("rid"), "first")
    kept = (own.join(roots, own.rid == roots.node, "left")
               .groupBy(F.coalesce("root", "rid").alias("group")).agg(F.min("first").alias("first")))
    return placed.join(kept.select(F.col("first.rid").alias(own_rid)), own_rid, "left_semi").select(*docs.columns)
