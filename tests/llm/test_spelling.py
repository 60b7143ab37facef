"""Spelling variants against comparing all pairs."""

import random
import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st

from rollspan.llm import spelling
from rollspan.llm.frames import prepare


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts, fewest=2, ratio=10):
    words = {w: n for w, n in counts.items() if w and n >= fewest}
    near = {w: [x for x in words if x != w and one_edit(w, x)] for w in words}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])
    return sorted((w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items())


def found(df):
    return sorted(tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect())


def noisy(rows, shortest=7, one_in=31):
    out = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = re.sub("[A-Z]", lambda x: x[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{low}".encode())
            if h % one_in == 0:
                low = low[:h % len(low)] + low[h % len(low) + 1:]
            if len(low) >= shortest:
                out[low] += 1
    return out


def vocabulary(n, seed, letters="abcé", lengths=(1, 9)):
    r = random.Random(seed)
    return {"".join(r.choice(letters) for _ in range(r.randint(*lengths))): 10 ** r.randrange(5) + r.randrange(3) for _ in range(n)}


@pytest.mark.parametrize("limit", [20_000, 5])
def test_near_words_are_those_of_all_pairs(spark, monkeypatch, limit):
    prepare(spark)
    if limit == 5:  # groups are split, and tiles are small
        monkeypatch.setattr(spelling, "CELLS", 400)
    counts = vocabulary(400, 1) | vocabulary(300, 2, "ab日𝄞", (6, 12)) | {"x" * 3000: 5, "x" * 2999: 60, "x" * 1500 + "y" + "x" * 1499: 2, "aaaaaaa": 3, "aaaaaaaa": 40}
    words = spark.createDataFrame([*counts.items(), (None, 5), ("nothing", None), ("", 9)], "word string, n long").repartition(3)
    assert found(spelling.variants(words, limit=limit)) == brute(counts)


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text("ab𝄞", min_size=1, max_size=7), min_size=2, max_size=40), st.sampled_from([30, 200, 4_000_000]))
def test_tiles_find_single_edits(words, cells):
    """One group of all words of two lengths, in one matrix or in many blocks."""
    before = spelling.CELLS
    spelling.CELLS = cells
    try:
        for m in range(1, 7):
            group = sorted((w for w in words if m <= len(w) <= m + 1), key=len)
            if not group:
                continue
            import numpy as np
            got = set()
            for tile, i, j, x, y in spelling._pairs(group, np.zeros(len(group), int), np.full(len(group), m)):
                near = tile.prefix_of_near(i, j) >= 0
                for a, b in zip(x[near], y[near]):
                    assert (a, b) not in got
                    got.add((a, b))
            assert got == {(a, b) for a in range(len(group)) for b in range(a + 1, len(group)) if len(group[a]) == m and one_edit(group[a], group[b])}
    finally:
        spelling.CELLS = before


def test_documents_with_odd_rows(spark):
    prepare(spark)
    r = random.Random(5)
    stems = ["straßenbahn", "Ubersetzung", "übersetzung", "translation", "TRANSLATION", "wörterbuch", "recherche"]
    texts = [None, "", "short a", "x" * 50_000, "x" * 50_000] + [
        " ".join(w[:k] + w[k + 1:] if r.random() < .1 else w for w in r.choices(stems, k=40) for k in [r.randrange(len(w))]) for _ in range(80)]
    rows = [(None if i % 9 == 0 else i // 2, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n int, word string")
    counts = noisy(rows)
    assert sorted((x.word, x.n) for x in spelling.noisy_words(docs).collect()) == sorted(counts.items())
    got = found(spelling.variants(spelling.noisy_words(docs)))
    assert got == brute(counts) and any(g[1] for g in got)
    assert found(spelling.variants(spelling.noisy_words(docs.limit(0)))) == []
