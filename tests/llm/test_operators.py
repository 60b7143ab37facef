"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing columns, against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from rollspan.llm import (bitpack, bktree, components, frames, kneser_ney, license_templates, mixing, mtree, packing, preferences,
                          simhash, syncmers, toxicity)

vocabularies = pytest.importorskip("public_tokenizers")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, fp string, _row string, slot int"


def words(n, seed, kinds=60):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(kinds)}" for _ in range(n))


def corpus():
    base = words(120, 1, 500)
    near = base.split()
    near[60] = "changed"
    texts = [None, "", "   ", "one", "one", base, base, " ".join(near), base.upper(), words(5000, 2), words(40, 3), "été naïve 日本語",
             "licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "a\n\nb   c\x1cd  e"]
    rows = [(i, t, ["en", None, "de"][i % 3], ["a", "b", None][i % 3], len(t or ""), 0.0, "x", "y", 1) for i, t in enumerate(texts)]
    return [*rows, rows[10], (None, "no id", None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    frames.prepare(spark)
    return spark.createDataFrame(corpus(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    frames.prepare(spark)
    return spark.createDataFrame([], SCHEMA)


def ids_of(name, text, end):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabularies.path(name))
    return np.array([*t.encode(text or "", add_special_tokens=False).ids, end], np.uint32)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 31), st.lists(st.integers(0, 2 ** 31 - 1), max_size=70), st.data())
def test_bits_round_trip(width, ids, data):
    ids = np.array([i % (1 << width) for i in ids], np.uint32)
    packed = bitpack.pack(ids, width)
    a = data.draw(st.integers(0, len(ids)))
    n = data.draw(st.integers(0, len(ids) - a))
    assert len(packed) == -(-len(ids) // 8) * width
    assert (bitpack.unpack(packed, width, a, n) == ids[a:a + n]).all()


def test_bit_packed_files(spark, docs, empty, tmp_path):
    out = str(tmp_path / "ids")
    bitpack.write_ids(docs, out, vocabularies.path("word_bpe_49k.json"), False, 1, block_ids=500)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in bitpack.read_documents(spark, out).collect())
    want = Counter()
    at = 0
    for start, _, n, _ in got:
        assert start == at
        at += n
    for r in corpus():
        ids = ids_of("word_bpe_49k.json", r[1], 1)
        want[r[0], len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((d, n, c) for _, d, n, c in got) == want
    assert [d for _, d, _, _ in got if d is not None] == sorted(r[0] for r in corpus() if r[0] is not None)
    assert (bitpack.read_ids(spark, out, 9, 100, 50) == ids_of("word_bpe_49k.json", words(5000, 2), 1)[100:150]).all()
    bitpack.write_ids(empty, str(tmp_path / "none"), vocabularies.path("word_bpe_49k.json"), False, 1)
    assert bitpack.read_documents(spark, str(tmp_path / "none")).count() == 0


def test_packing(docs, empty):
    path = vocabularies.path("byte_bpe_50k.json")
    rows = packing.pack_documents(docs.coalesce(2), path, True, 0, length=64, windows=3, gap=4).collect()
    seqs = defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append(r)
    for pieces in seqs.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    got = Counter((r.doc_id, r.start, r.length, r.doc_tokens, r.ids_crc32) for r in rows)
    ids = {r[0]: ids_of("byte_bpe_50k.json", r[1], 0) for r in corpus()}
    for (d, start, n, total, crc), _ in got.items():
        assert total == len(ids[d]) and crc == zlib.crc32(ids[d][start:start + n].tobytes())
    assert sum(r.length for r in rows) == sum(len(ids[r[0]]) for r in corpus())
    assert packing.pack_documents(empty, path, True, 0).count() == 0


def brute_print(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    sh = [" ".join(w[i:i + size]) for i in range(len(w) - size + 1)] if len(w) >= size else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def test_simhash_components(docs, empty):
    got = Counter((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect())
    rows = [(r[0], brute_print(r[1], 4)) for r in corpus()]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 4:
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    least = {g: min((rows[i][0] for i in range(len(rows)) if group[i] == g and rows[i][0] is not None), default=None) for g in group}
    assert got == Counter((d, f"{p:016x}", least[g]) for (d, p), g in zip(rows, group))
    assert simhash.near_duplicates(empty).count() == 0


def test_bk_trees_split_shards_and_find_all():
    r = np.random.default_rng(3)
    centre = r.integers(0, 1 << 63, 12, np.uint64)
    prints = np.unique(np.concatenate([centre ^ (np.uint64(1) << np.uint64(b)) ^ (np.uint64(1) << np.uint64(c)) for b, c in r.integers(0, 63, (30, 2))]))
    shard = np.zeros(len(prints), np.int64)
    got = bktree.linked(shard, prints, np.ones(len(prints), bool), 3).of
    want = bktree.Labels(len(prints))
    a, b = np.nonzero(np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3)
    want.link(a, b)
    assert (got == want.of).all()


def test_hot_shard_is_split(spark):
    frames.prepare(spark)
    df = spark.range(200).select((F.col("id") * 1).alias("fp"))
    links = simhash.print_links(df, 4, tree_rows=16)
    assert components.connected_components(links).select("root").distinct().count() == 1
    assert links.count() < 200 * 15 * 15


def test_components_of_a_chain(spark):
    edges = spark.range(50).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = {r.node: r.root for r in components.connected_components(edges).collect()}
    assert got == {i: 0 for i in range(1, 51)}
    assert components.connected_components(edges.where("a < 0")).count() == 0


def test_near_copies_keep_one(docs, empty):
    kept = sorted(r.doc_id for r in simhash.drop_copies(docs).where("doc_id is not null").collect())
    assert kept == [0, 3, 5, 9, 10, 11, 12, 13, 14]
    assert simhash.drop_copies(docs).columns == docs.columns
    assert simhash.drop_copies(empty).count() == 0


def test_near_copies_by_exact_similarity(spark):
    """Pairs of known similarity on both sides of 0.8."""
    frames.prepare(spark)
    rows, pairs = [], []
    for k in range(120):
        text = words(95, 7000 + k, 100_000).split()
        edited = text.copy()
        for x in range(k % 3 + 1):
            edited[10 + 25 * x] = "changed"  # 86, 81 and 76 of 91 shingles stay
        drop = [0, 3, 8][k // 40]
        a, b = " ".join(text), " ".join(edited[:len(edited) - drop])
        x, y = (set(simhash.shingle_hashes(t.encode(), 5)) for t in (a, b))
        pairs.append((2 * k, 2 * k + 1, len(x & y) / len(x | y)))
        rows += [(2 * k, a), (2 * k + 1, b)]
    assert {j >= 0.8 for *_, j in pairs} == {True, False} and sum(0.75 < j < 0.83 for *_, j in pairs) >= 40
    kept = {r.doc_id for r in simhash.drop_copies(spark.createDataFrame(rows, "doc_id long, text string"), tree_rows=64).collect()}
    assert {a for a, *_ in pairs} <= kept
    assert [b for _, b, _ in pairs if b in kept] == [b for _, b, j in pairs if j < 0.8]


def test_pfair_windows_and_deviation(spark):
    frames.prepare(spark)
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"))
    weights = {"hot": 0.5, **{f"s{i}": 0.07 for i in range(7)}}
    rows = mixing.schedule(df, ["doc_id"], F.xxhash64("doc_id"), F.col("source"), weights, units=40, block=4, bucket_rows=100).collect()
    assert Counter(r.doc_id for r in rows) == Counter(range(3000))
    slots = {}
    for r in rows:
        assert r.release <= r.slot < r.due
        assert slots.setdefault(r.slot, (r.source, r.block)) == (r.source, r.block)
    assert sorted(slots) == list(range(len(slots)))
    units = {s: max(1, round(w / sum(weights.values()) * 40)) for s, w in weights.items()} | {None: 1}
    total, seen = sum(units.values()), Counter()
    blocks = Counter(s for s, _ in set(slots.values()))
    for t in range(min(blocks[s] // units[s] for s in units) * total):
        seen[slots[t][0]] += 1
        assert all(abs(seen[s] - (t + 1) * u / total) < 1 for s, u in units.items())


def test_mixed_keeps_rows(docs, empty):
    assert Counter(map(tuple, mixing.mixed(docs).collect())) == Counter(map(tuple, docs.collect()))
    assert mixing.mixed(empty).count() == 0


def plain_perplexities(texts, train, asked):
    """The model with dicts of words instead of classes and shards."""
    def pairs(t):
        w = ["<s>", *re.findall(r"\w+|[^\w\s]+", t), "</s>"]
        return list(zip(w, w[1:]))
    c2 = Counter(p for i in train for p in pairs(texts[i]))
    c1 = Counter(w for _, w in c2)
    kinds = lambda c: kneser_ney.discounts(*(sum(n == k for n in c.values()) for k in (1, 2, 3, 4)))
    d1, d2, all1 = kinds(c1), kinds(c2), sum(c1.values())
    total, left = Counter(), Counter()
    for (v, _), n in c2.items():
        total[v] += n
        left[v] += d2[min(n, 3)]
    rest = sum(d1[min(n, 3)] for n in c1.values()) / all1

    def p(v, w):
        one = max(0, c1[w] - d1[min(c1[w], 3)]) / all1 + rest / kneser_ney.CLASSES
        return (c2[v, w] - d2[min(c2[v, w], 3)] + left[v] * one) / total[v] if total[v] else one
    return [math.exp(-sum(math.log(p(*x)) for x in pairs(t)) / len(pairs(t))) for t in asked]


def test_kneser_ney(spark, docs, empty):
    frames.prepare(spark)
    texts = [words(80, i) for i in range(60)]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)] + [(99, "%$#@" * 30, "en"), (100, "", "en"), (101, None, None)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(60)] + [(0, 1), (None, 1), (99, 0)], "doc_id long, quality int")
    rows = {r.doc_id: r for r in kneser_ney.classify(df, labels).collect()}
    assert not rows[99].accepted and not rows[100].accepted and not rows[101].accepted and rows[100].perplexity is None
    assert sum(rows[i].accepted for i in range(60)) >= 59
    want = plain_perplexities(texts, [r._id for r in kneser_ney.trusted_ids(labels).where("not measures").collect()], texts + ["%$#@" * 30, "w1 w1  unseen!"])
    df2 = df.unionByName(spark.createDataFrame([(200, "w1 w1  unseen!", "en")], df.schema))
    got = {r.doc_id: r.perplexity for r in kneser_ney.classify(df2, labels).collect()}
    for i, w in zip([*range(60), 99, 200], want):
        assert math.isclose(got[i], w, rel_tol=1e-4)
    none = labels.where("quality = 7")
    assert kneser_ney.classify(docs, none).where("accepted").count() == sum(bool(r[1]) for r in corpus())
    assert kneser_ney.classify(empty, labels).count() == 0
    assert kneser_ney.drop_poor(docs, none).columns == docs.columns


def test_trusted_texts_are_counted_where_they_are_scanned(spark, monkeypatch):
    """No shuffle of texts, whether the filter lets others pass or not; too many others: the same counts by a join."""
    frames.prepare(spark)
    monkeypatch.setattr(kneser_ney, "FILTER_BITS", 1024)  # many others pass
    rows = [(i, words(30, i)) for i in range(300)] + [(5, words(30, 5)), (7, ""), (8, None), (None, words(30, 9))]
    texts = spark.createDataFrame(rows, "_id long, text string").repartition(3)
    trusted = set(range(0, 200, 2)) | {5, 7, 8, 1000}
    ids = spark.createDataFrame([(i,) for i in trusted], "_id long")
    first, second, _ = kneser_ney.word_pairs([t.encode() for i, t in rows if i in trusted and t])
    want = Counter(kneser_ney.keys_of(first, second).tolist())
    for most in (1 << 18, 3):
        monkeypatch.setattr(kneser_ney, "STRANGERS", most)
        counted = kneser_ney.block_counts(texts, ids, 64)
        got = Counter()
        for r in counted.collect():
            for key, n in zip(*(x.tolist() for x in kneser_ney.unpack_counts(r.body))):
                got[key] += n
        assert got == want
        joins = counted._jdf.queryExecution().optimizedPlan().toString().count("Join")
        assert joins == (most == 3)


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@settings(max_examples=300, deadline=None)
@given(st.text("abcd", max_size=12))
def test_levenshtein_automaton(word):
    terms = ["abcda", "dcba", "aabbccddaa", "bbbbb"]
    near = [(edit_distance(word, t), t) for t in terms if edit_distance(word, t) <= toxicity.edits_allowed(t)]
    want = min(near, default=None)
    assert toxicity.TermAutomaton(terms).match(word) == (want and (want[1], want[0]))


@settings(max_examples=300, deadline=None)
@given(st.text("abcd", max_size=12))
def test_beginnings_allow_edits(word):
    stems, terms = ["abcda", "dcba", "bbbbbb"], ["abcdabcdab", "aabbccddaa"]
    near = min([x for x in ((min(edit_distance(word[:n], t) for n in range(len(word) + 1)), t + "*") for t in stems) if x[0] <= toxicity.edits_allowed(x[1])], default=None)
    whole = min([x for x in ((edit_distance(word, t), t) for t in terms) if x[0] <= toxicity.edits_allowed(x[1])], default=None)
    want = whole if whole and (near is None or whole[0] < near[0]) else near
    assert toxicity.TermAutomaton([*(t + "*" for t in stems), *terms]).match(word) == (want and (want[1], want[0]))


def test_all_forms_and_long_texts_count():
    s = toxicity.Scorer({("", 0): -3.0, ("bomen*", 0): 2.0, ("bomen*", 1): 1.5, ("dreadful", 0): 5.0, ("rotten", 0): 5.0})
    assert s.score("bomente bomenta bomentu") >= 0.9 and s.score("bomante bomentas bomento") > s.score("bomentas bomento")
    assert s.score(f"{words(3000, 1)} dreadful rotten {words(1000, 2)}") >= 0.7 > s.score(f"{words(300, 1)} dreadful {words(4000, 3)} rotten")
    assert "bomenteria" in toxicity.select_terms([("bomente*", 9), ("bomenteria", 4)])


def test_toxicity(spark, docs, empty):
    frames.prepare(spark)
    bad = [f"{words(8, i, 400)} dreadful {words(6, i + 500, 400)} rotten {words(3, i + 900, 400)}" for i in range(60)]
    good = [words(20, i + 2000, 400) for i in range(200)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(bad + good)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 60)) for i in range(260)], "doc_id long, toxic int")
    weights = toxicity.fit(df, labels)
    assert {"dreadful", "rotten"} <= {t for t, _ in weights}
    s = toxicity.Scorer(weights)
    assert s.score("you dreadful rotten thing") >= 0.7 > s.score("a plain thing")
    assert s.score("a dreadfull roten thing") > s.score("a plain thing")
    assert s.score("x dreadful y") > s.score('he said "dreadful" to us')
    assert {r.score for r in toxicity.score_documents(docs, weights).where("doc_id = 0").collect()} == {s.score("")}
    assert toxicity.fit(df, labels.where("toxic = 0")) == {} and toxicity.Scorer({}).score("dreadful") == 0.0
    assert toxicity.drop_toxic(docs, weights).count() == docs.count() and toxicity.drop_toxic(empty, weights).count() == 0


def test_license_templates(docs, empty):
    rows = {r.doc_id: r for r in license_templates.scan_licenses(docs).collect()}
    assert (rows[12].labels, rows[12].base_labels, rows[12].first_word) == ("apache,apache-2.0", "apache", 3)
    assert (rows[13].labels, rows[13].n_base, rows[13].score) == ("mit", 1, 1.0)
    assert (rows[0].n_words, rows[0].labels, rows[0].first_word) == (0, "", None)
    a = license_templates.Automaton("copyright <<any 1-3>> all <<optional>> the <<end>> <<one rights|right>> reserved")
    assert a.match(b"copyright a b all the right reserved x".split(), 0) == 7
    assert a.match(b"copyright a b c d all rights reserved".split(), 0) is None
    assert license_templates.scan_licenses(empty).count() == 0


def test_m_tree_is_exact(spark):
    frames.prepare(spark)
    r = np.random.default_rng(5)
    v = [(int(i), [float(x) for x in r.normal(size=6)]) for i in range(700)] + [(700, [0.5] * 6), (701, [0.5] * 6), (701, [0.5] * 6)]
    odd = [(800, None), (900, [float("nan")] * 6), (1000, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (1100, []), (None, [1.0] * 6)]
    df = spark.createDataFrame(v + odd, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for x in mtree.top_k(mtree.integer_vectors(df), F.col("vec_id") % 100 == 0, page=16).orderBy("query_id", "rank").collect():
        got[x.query_id].append((x.score, x.vec_id))
    ints = [(i, np.floor(np.array(e) * 1024).astype(np.int64)) for i, e in v]
    for q, e in ints:
        if q % 100 == 0:
            assert got.pop(q) == sorted(((int(e @ w), i) for i, w in ints if i != q), key=lambda t: (-t[0], t[1]))[:10]
    assert not got and mtree.top_k(mtree.integer_vectors(df.where("vec_id < 0")), F.lit(True)).count() == 0


def test_syncmers(docs, empty):
    rows = syncmers.compare_edits(docs).collect()
    assert len(rows) == docs.count()
    by = {r.doc_id: r for r in rows}
    assert by[5].fingerprint == by[6].fingerprint and by[0].fingerprint == by[1].fingerprint
    text = {r[0]: r[1] or "" for r in corpus()}
    for d in range(6, 15):
        n, follow = len(text[d]), text[d - 1]
        edited = text[d][:n - n // 3] + follow[:n // 3]
        if d != 10 and d != 11:
            assert by[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= by[d].near_edited <= 1
    assert by[7].near_next > 0.8 and by[9].near_next < 0.2
    assert syncmers.compare_edits(empty).count() == 0


def test_preferences(spark):
    frames.prepare(spark)
    t = "pair long, turn long, role string, text string, part string"
    a = spark.createDataFrame([(1, 0, "user", "q", ""), (1, 1, "assistant", "<|x", ""), (2, 0, "user", "same", ""), (None, None, None, None, None)], t)
    b = spark.createDataFrame([(1, 0, "user", "q", ""), (1, 1, "assistant", "other", ""), (1, 2, "user", "more", ""), (2, 0, "user", "same", "")], t)
    a, b = (preferences.turns_of(x, "pair", "turn", "role", "text") for x in (a, b))
    got = sorted((r.pair_id or 0, r.part, r.turn or 0, r.rendered[r.learn_from:r.learn_to]) for r in preferences.format_pairs(a, b).collect())
    assert got == [(0, "chosen", 0, ""), (1, "chosen", 1, "< |x"), (1, "prompt", 0, ""), (1, "rejected", 1, "other"), (1, "rejected", 2, ""), (2, "prompt", 0, "")]
    assert preferences.format_pairs(a.where("1=0"), b.where("1=0")).count() == 0


def test_pipeline_quality_stage(spark, tmp_path):
    """The stage after the others' input: junk goes, clean rows stay whole, copies go one stage later."""
    import corpus_pipeline

    texts = [words(80, i) for i in range(80)]
    rows = [(i, t, "en", "a", len(t)) for i, t in enumerate(texts)] + [(90, "%$#@ " * 30, "en", "b", 150), (91, texts[3], None, None, None), (92, None, "en", "a", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(80)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = corpus_pipeline.drop_poor(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    found = {r.doc_id: tuple(r) for r in kept.collect()}
    assert 90 not in found and 92 not in found and len([i for i in found if i < 80]) >= 79
    assert all(found[r[0]] == r for r in rows if r[0] in found)
    unique = corpus_pipeline.drop_copies(spark, kept, str(tmp_path))
    ids = [r.doc_id for r in unique.select("doc_id").collect()]
    assert 91 not in ids and sorted(ids) == sorted(i for i in found if i != 91)


def test_packing_stage_takes_the_mixture_in_order(spark, tmp_path):
    """Files of unlike size: a scan takes the largest first, the sequences must not."""
    import corpus_pipeline

    frames.prepare(spark)
    rows = [(i, words(1100 + 4 * i, i), "en", "short", 0) if i < 20 else (i, words(3500, i), "en", "hot", 0) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    order = {r.doc_id: (r.slot, r.place) for r in mixing.schedule(df, ["doc_id"], F.xxhash64("doc_id"), F.col("source")).collect()}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        corpus_pipeline.mix(spark, df, "").write.parquet(f"{tmp_path}/mixed")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    stored = spark.read.parquet(f"{tmp_path}/mixed")
    assert len(stored.inputFiles()) > 1
    got = [r for r in corpus_pipeline.pack(spark, stored, "").collect()]
    firsts = sorted((r.sequence_id, r.doc_id) for r in got if r.start == 0)
    assert [d for _, d in firsts] == sorted(order, key=order.get)


def test_merged_sequences_stay_among_their_partitions(spark):
    frames.prepare(spark)
    df = spark.createDataFrame([(i, words(20, i)) for i in range(60)], "doc_id long, text string").repartition(3)
    got = packing.pack_documents(df, vocabularies.path("byte_bpe_50k.json"), True, 0).collect()
    assert all(r.sequence_id < 3 * packing.PART for r in got) and sum(r.start == 0 for r in got) == 60
    assert len({(r.sequence_id, r.offset) for r in got}) == len(got)
