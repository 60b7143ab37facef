"""Importance resampling against plain loops, and the selection against sorting."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from rollspan.llm import resampling
from rollspan.llm.frames import prepare


def runs(text, longest):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda x: x[0].lower(), text or ""))
    return len(words), [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(rows, target, percent, fewest, longest, buckets):
    def counted(texts):
        return Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in runs(t, longest)[1])
    s, t = counted(x for _, x in rows), counted(target)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in range(buckets)]
    out = []
    for doc, text in rows:
        n, found = runs(text, longest)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append((doc, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + .5) / 4294967296)))))
    able = sorted((x for x in out if x[1] >= fewest), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    rank = {}
    for i, x in enumerate(able[:len(able) * percent // 100]):
        rank.setdefault(x, []).append(i + 1)
    return sorted(((*x, rank[x].pop(0) if rank.get(x) else None) for x in out), key=str)


def corpus(seed=1, n=300):
    r = random.Random(seed)
    kinds = ["Alpha", "BETA", "gamma", "été", "naïve", "日本", "x1", "42", "delta-epsilon", "o'clock"]
    texts = [None, "", " ... ", "one", "y" * 300, "z" * 48, "word " * 50_000] + [" ".join(r.choices(kinds, k=r.randrange(60))) for _ in range(n)]
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [rows[20], rows[20], (None, texts[30]), (None, "a b c " * 9), (40, texts[40])], [" ".join(r.choices(kinds[:4], k=30)) for _ in range(20)] + [None, ""]


@pytest.mark.parametrize("longest, buckets, percent, fewest", [(1, 10_000, 10, 20), (3, 97, 35, 0), (2, 1000, 100, 5), (1, 50, 0, 1)])
def test_draw_is_that_of_plain_loops(spark, longest, buckets, percent, fewest):
    prepare(spark)
    rows, target = corpus()
    docs = spark.createDataFrame([(*x, 1, "r", 0) for x in rows], "doc_id long, text string, score int, rank string, bucket int").repartition(5)
    aims = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = resampling.resample(docs, aims, percent, fewest, longest, buckets)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows, target, percent, fewest, longest, buckets)


def test_empty_tables(spark):
    prepare(spark)
    docs = spark.createDataFrame(corpus()[0], "doc_id long, text string")
    none = docs.limit(0)
    assert resampling.resample(none, docs).count() == 0
    assert sorted(map(tuple, resampling.resample(docs, none).collect()), key=str) == brute(corpus()[0], [], 10, 20, 1, 10_000)


@pytest.mark.parametrize("values", ["ties", "spread", "sorted"])
def test_nth_key_is_that_of_sorting(spark, values):
    r = random.Random(7)
    n = 3000
    keys = sorted({"ties": lambda: (r.randrange(3), 0, r.randrange(5), 0), "spread": lambda: (r.randrange(-10 ** 9, 10 ** 9), r.randrange(2), r.randrange(9), 1),
                   "sorted": lambda: (r.randrange(100), 0, 1, r.randrange(10 ** 6))}[values]() for _ in range(n))
    if values != "sorted":
        r.shuffle(keys)
    df = spark.createDataFrame(keys, "k0 long, k1 long, k2 long, k3 long").repartition(7 if values != "sorted" else 1)
    df = df.union(df.limit(0)).cache()
    for nth in (1, 2, n // 10, n // 2, n):
        key, rounds = resampling.nth_key(df, nth)
        assert key == sorted(keys)[nth - 1]
        assert rounds <= math.log(n) / math.log(4 / 3) + 2
    with pytest.raises(ValueError):
        resampling.nth_key(df, n + 1)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("aB9 é日-\x00", max_size=30), max_size=6), st.integers(1, 4))
def test_buckets_of_runs(texts, longest):
    n, found = resampling.features([t.encode() for t in texts], longest, 101)
    want = [runs(t, longest) for t in texts]
    assert n.tolist() == [w[0] for w in want]
    got = Counter(zip(np.concatenate([t for _, t in found]).tolist(), np.concatenate([b for b, _ in found]).tolist()))
    assert got == Counter((i, zlib.crc32(f.encode()) % 101) for i, w in enumerate(want) for f in w[1])
