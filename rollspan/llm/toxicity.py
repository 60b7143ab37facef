"""Toxicity by a lexicon learned from labels, matched with Levenshtein automata.

``fit`` learns terms from a bounded sample of labelled documents: words, and word beginnings
with many endings, that toxic documents hold in many different contexts and clean ones hardly ever. Contexts
are counted instead of documents, so a passage that is copied many times counts once.

The terms form a trie. Its product with the Levenshtein automaton is built lazily as a
deterministic automaton over the letters of a word: a state is the set of (trie node, edits so far). A word costs one
step a letter and ends as soon as no term is near. Longer terms allow more edits; a beginning allows those of its own
length, and is met as soon as some first letters of the word are near enough to it.

The automaton is then run over the same sample, and each (term, edits) gets the log-odds of its hits there:
misspelt hits of a term that has neighbours among ordinary words count for little. A hit that its context
window shows as quoted or reported counts less again. A text is cut into half-overlapping stretches of ``STRETCH`` words. The
odds of a stretch are the sum of the log-odds of all different words in it that hit, of the share of toxic documents, and of a
small charge for each word; the score is the logistic of the best stretch, whose odds are divided by the number of
stretches, since more stretches meet terms by chance.

Cases: a null, empty or wordless text scores the share of toxic documents; repeated rows score alike; nothing but
the text counts; without usable labels of both classes all scores are 0; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from rollspan.llm.frames import task
from rollspan.session import cut_lineage

WORD = re.compile(r"[^\W_]+(?:[*@$][^\W_]+)*")
#: Words that report speech; a hit near one may be a quotation. Fixed values.
REPORTING = frozenset("said says wrote writes called calls quote quoted quotes term word sagte schrieb nannte zitat wort "
                      "dit écrit appelle cite mot dijo escribió llamó cita palabra".split())
OPENING = {"“": "”", "«": "»", "„": "“", "‘": "’"}
#: Share of a hit's weight that is left by its edits, and by a quotation.
EDIT_WEIGHT, QUOTED_WEIGHT = (1.0, 0.6, 0.5), 0.3
#: Words of a stretch that is scored by itself, and log-odds taken off for each of its words.
STRETCH, LENGTH_CHARGE = 200, 0.003
#: Lengths of word beginnings that are tried as terms.
STEMS = (4, 5, 6, 7, 8)
#: Words on each side of a hit that are looked at, and distinct words (or steps) that a task remembers.
WINDOW, KEEP = 6, 200_000


def held_out(doc_id) -> F.Column:
    """Rows that ``fit`` never sees: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def edits_allowed(term: str) -> int:
    term = term.removesuffix("*")
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class TermAutomaton:
    """A term that ends in ``*`` stands for all words that begin so."""

    def __init__(self, terms):
        self.child: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.stem: list[str | None] = [None]
        self.reach = [0]  # most edits that a term below allows
        for t in terms:
            node, k = 0, edits_allowed(t)
            self.reach[0] = max(self.reach[0], k)
            for c in t.removesuffix("*"):
                if c not in self.child[node]:
                    self.child[node][c] = len(self.child)
                    self.child.append({})
                    self.term.append(None)
                    self.stem.append(None)
                    self.reach.append(0)
                node = self.child[node][c]
                self.reach[node] = max(self.reach[node], k)
            (self.stem if t.endswith("*") else self.term)[node] = t
        self.letters = {c for kids in self.child for c in kids}
        self.start = self._closed({0: 0})
        self.next: dict[tuple, tuple] = {}
        self.accepts: dict[tuple, tuple | None] = {}
        self.begins: dict[tuple, tuple | None] = {}

    def _closed(self, states: dict[int, int]) -> tuple:
        """With letters of a term left out: each node with its fewest edits."""
        todo = list(states.items())
        while todo:
            node, e = todo.pop()
            if states.get(node, 99) < e:
                continue
            for kid in self.child[node].values():
                if e + 1 <= self.reach[kid] and states.get(kid, 99) > e + 1:
                    states[kid] = e + 1
                    todo.append((kid, e + 1))
        return tuple(sorted(states.items()))

    def _step(self, state: tuple, letter: str) -> tuple:
        out: dict[int, int] = {}
        for node, e in state:
            if e + 1 <= self.reach[node]:  # a letter too many
                out[node] = min(out.get(node, 99), e + 1)
            for c, kid in self.child[node].items():
                cost = e + (c != letter)
                if cost <= self.reach[kid]:
                    out[kid] = min(out.get(kid, 99), cost)
        return self._closed(out)

    @staticmethod
    def _nearest(state: tuple, ends: list[str | None]) -> tuple | None:
        return min(((e, ends[node]) for node, e in state if ends[node] and e <= edits_allowed(ends[node])), default=None)

    def match(self, word: str) -> tuple[str, int] | None:
        """(term, edits) of the nearest term, or None; of those equally near a beginning."""
        state, best = self.start, None
        for c in word:
            key = (state, c if c in self.letters else "")
            state = self.next.get(key)
            if state is None:
                if len(self.next) > KEEP:
                    self.next.clear()
                    self.accepts.clear()
                    self.begins.clear()
                state = self.next[key] = self._step(*key)
            if not state:
                break
            if state not in self.begins:
                self.begins[state] = self._nearest(state, self.stem)
            found = self.begins[state]
            if found and (best is None or found < best):
                best = found
                if not best[0]:
                    break
        else:
            if state not in self.accepts:
                self.accepts[state] = self._nearest(state, self.term)
            found = self.accepts[state]
            if found and (best is None or found[0] < best[0]):
                best = found
        return best and (best[1], best[0])


@dataclass
class Scorer:
    """Scores texts; ``weights`` holds the log-odds of each (term, edits), and at ("", 0) those of a text."""

    weights: dict[tuple[str, int], float]
    automaton: TermAutomaton = field(init=False)
    hits: list = field(init=False)

    def __post_init__(self):
        self.automaton = TermAutomaton(sorted({t for t, _ in self.weights if t}))
        self._forget()

    def _forget(self):
        match, hits = self.automaton.match, [None]

        class Seen(dict):
            def __missing__(self, word):
                found = match(word)
                if found:
                    hits.append(found)
                self[word] = n = len(hits) - 1 if found else 0
                return n

        self.seen, self.hits = Seen(), hits

    def _quoted(self, text: str, begin: int, end: int, words: list[str], i: int) -> bool:
        if REPORTING.intersection(words[max(0, i - WINDOW):i + WINDOW + 1]):
            return True
        line = text.rfind("\n", 0, begin) + 1
        before = text[line:begin]
        if before.count('"') % 2 and '"' in text[end:end + 400]:
            return True
        return any(before.rfind(a) > before.rfind(b) for a, b in OPENING.items())

    def places(self, text: str) -> tuple[list[tuple[int, str, tuple[str, int], float]], int]:
        """(place, word, (term, edits), share that its context leaves) of each word that hits; number of all words."""
        low = text.lower()
        words = WORD.findall(low)
        found = list(map(self.seen.__getitem__, words))
        out = []
        if any(found):
            spans = [m.span() for m in WORD.finditer(low)]
            out = [(i, words[i], self.hits[f], QUOTED_WEIGHT if self._quoted(low, *spans[i], words, i) else 1.0)
                   for i, f in enumerate(found) if f]
        if len(self.seen) > KEEP:
            self._forget()
        return out, len(words)

    def score(self, text: str) -> float:
        if not self.weights:
            return 0.0
        found, n = self.places(text)
        half = STRETCH // 2
        last = max(0, -(-n // half) - 2)  # starts of stretches are 0, half, ... last * half
        by: dict[int, dict[str, float]] = {}
        for i, word, hit, share in found:
            for k in range(max(0, i // half - 1), min(i // half, last) + 1):
                own = by.setdefault(k, {})
                own[word] = max(own.get(word, 0.0), share * self.weights.get(hit, 0.0))
        odds = self.weights["", 0] - LENGTH_CHARGE * min(n, STRETCH) - math.log(last + 1)
        odds += max((sum(own.values()) for own in by.values()), default=0.0)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))


@task
def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document and feature: the class, the context of its first place, the word."""
    for batch in batches:
        rows = []
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = WORD.findall((text or "").lower())
            seen = {}
            for i, w in enumerate(words):
                if 3 <= len(w) <= 40:
                    for f in (w, *(w[:n] + "*" for n in STEMS if len(w) > n)):
                        if f not in seen:
                            context = f"{words[i - 1] if i else ''} {words[i + 1] if i + 1 < len(words) else ''}"
                            seen[f] = (xxhash.xxh64_intdigest(context.encode()) >> 1, w)
            rows += [(f, toxic, c, w) for f, (c, w) in seen.items()]
        f, t, c, w = zip(*rows) if rows else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(f, pa.string()), pa.array(t, pa.int32()), pa.array(c, pa.int64()), pa.array(w, pa.string())],
                                         names=["feature", "toxic", "context", "word"])


@task
def _sample_hits(batches: Iterator[pa.RecordBatch], terms: list[str]) -> Iterator[pa.RecordBatch]:
    scorer = Scorer({(t, 0): 1.0 for t in terms})
    for batch in batches:
        rows = [(term, edits, toxic) for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for term, edits in {w: hit for _, w, hit, _ in scorer.places(text or "")[0]}.values()]
        columns = list(zip(*rows)) if rows else [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.int32()))],
                                         names=["term", "edits", "toxic"])


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
        per_class: int = 2500, min_contexts: int = 3, min_share: float = 0.02, min_odds: float = 5.0,
        max_terms: int = 1000) -> dict[tuple[str, int], float]:
    """Log-odds of each (term, edits), from at most ``per_class`` labelled documents of each class.

    The sample is the first of a fixed pseudo-random order of ids outside the held-out fold; its bound
    allows the broadcast of ids and the collection of the terms. The share of toxic documents is counted over all labels of
    that fold.
    """
    known = (labels.where(~held_out(doc_id) & F.col(doc_id).isNotNull() & F.col(label).isin(0, 1))
                   .groupBy(F.col(doc_id).cast("long").alias("_id")).agg(F.max(F.col(label).cast("int")).alias("toxic")))
    sizes = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return {}
    prior = sizes[1] / sizes[0]
    n_toxic, n_clean = (min(per_class, sizes[c]) for c in (1, 0))
    order = [F.xxhash64("_id"), F.col("_id")]
    sample = known.where("toxic = 1").orderBy(*order).limit(per_class).unionByName(
        known.where("toxic = 0").orderBy(*order).limit(per_class))
    texts = cut_lineage(docs.select(F.col(doc_id).cast("long").alias("_id"), F.col(text).alias("text"))
                            .join(F.broadcast(sample), "_id").select("text", "toxic"))
    rows = texts.mapInArrow(_features, "feature string, toxic int, context long, word string")
    is_toxic = F.col("toxic") == 1
    stats = rows.groupBy("feature").agg(
        F.countDistinct(F.when(is_toxic, F.col("context"))).alias("contexts"),
        F.countDistinct(F.when(~is_toxic, F.col("context"))).alias("clean"),
        F.countDistinct(F.when(is_toxic, F.col("word"))).alias("forms"))
    odds = (F.col("contexts") / n_toxic) / ((F.col("clean") + 0.5) / n_clean)
    least = max(min_contexts, math.ceil(min_share * n_toxic))
    best = (stats.where((F.col("contexts") >= least) & (odds >= min_odds) & (~F.col("feature").endswith("*") | (F.col("forms") >= 4)))
                 .orderBy(F.col("contexts").desc(), "feature").limit(max_terms).collect())
    terms = select_terms([(r.feature, r.contexts) for r in best])
    hits = (texts.mapInArrow(partial(_sample_hits, terms=terms), "term string, edits int, toxic int")
                 .groupBy("term", "edits").agg(F.count(F.when(is_toxic, 1)).alias("hit"), F.count(F.when(~is_toxic, 1)).alias("miss")).collect())
    counted = {(r.term, r.edits): (r.hit, r.miss) for r in hits}
    weights = {("", 0): math.log(prior)}
    for t in terms:
        for e in range(edits_allowed(t), -1, -1):
            hit, miss = counted.get((t, e), (0, 0))
            # a misspelling that the sample doesn't hold is taken as meant
            odds = ((hit + (1.0 if e else 0.01)) / n_toxic) / ((miss + 0.25) / n_clean)
            weights[t, e] = round(max(0.0, math.log(odds)) * EDIT_WEIGHT[e], 6)
    return weights


def select_terms(found: list[tuple[str, int]]) -> list[str]:
    """Drop stems that another explains, a longer one with nearly as many contexts or else a shorter; all words stay."""
    by = dict(found)
    stems = [f[:-1] for f in by if f.endswith("*")]
    kept = {s for s in stems if not any(t != s and t.startswith(s) and by[t + "*"] >= 0.9 * by[s + "*"] for t in stems)}
    kept = {s for s in kept if not any(t != s and s.startswith(t) for t in kept)}
    return [f for f, _ in found if not f.endswith("*") or f[:-1] in kept]


@task
def _scores(batches: Iterator[pa.RecordBatch], weights: dict) -> Iterator[pa.RecordBatch]:
    scorer = Scorer(weights)
    for batch in batches:
        found = [scorer.score(t or "") for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.float64())], names=["doc_id", "score"])


def score_documents(docs: DataFrame, weights: dict, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(partial(_scores, weights=weights), "doc_id long, score double")


@task
def _kept(batches: Iterator[pa.RecordBatch], weights: dict, at: int, limit: float) -> Iterator[pa.RecordBatch]:
    scorer = Scorer(weights)
    for batch in batches:
        ok = np.array([not t or scorer.score(t) < limit for t in batch.column(at).to_pylist()], bool)
        yield batch.filter(pa.array(ok))


def drop_toxic(docs: DataFrame, weights: dict, text: str = "text", limit: float = 0.7) -> DataFrame:
    """Rows that score below ``limit``, with all their columns, without a shuffle."""
    return docs.mapInArrow(partial(_kept, weights=weights, at=docs.columns.index(text), limit=limit), docs.schema)
