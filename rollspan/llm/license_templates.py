"""License scans by template markup, compiled to token automata.

A template is a text of mandatory words with marked regions: ``<<optional>> ... <<end>>`` may be left out,
``<<one a|b>>`` is one of the words, ``<<any m-n>>`` stands for m to n words of any kind. It compiles
to an automaton over words. A text is accepted from a word on if the automaton ends, so its mandatory wording
matches exactly. Only places where a template's first words stand are tried, and only in texts that hold its rarest
mandatory word at all.

Cases: a null text is empty; an empty text has no words, no labels and score 0; repeated rows get
equal results; a text of any length is scanned whole; an empty table gives no rows; other columns aren't
read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rollspan.llm.frames import utf8

#: Phrases and labels of the plain scan. Fixed values.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: (label, rarest mandatory word, template). Wording of the licenses: fixed values.
TEMPLATES = [
    ("mit", "mit", "<<one released|licensed|distributed|provided|available>> under <<optional>> the terms of <<end>> the mit license"),
    ("mit", "hereby", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
                      "documentation files the software to deal in the software without restriction"),
    ("apache-2.0", "apache", "licensed under the apache license version 2 0 <<optional>> the license <<end>>"),
    ("gpl-3.0", "gnu", "<<optional>> this <<one work|program|software|file>> is <<end>> licensed under the <<optional>> terms of the <<end>> gnu general public license version 3 <<optional>> or <<optional>> at your option <<end>> any later version <<end>>"),
    ("gpl-2.0", "gnu", "gnu general public license as published by the free software foundation either version 2 of the license or <<optional>> at your option <<end>> any later version"),
    ("gpl-3.0", "gnu", "gnu general public license as published by the free software foundation either version 3 of the license or <<optional>> at your option <<end>> any later version"),
    ("cc-by-nc-4.0", "cc", "licensed under <<optional>> a <<end>> cc by nc 4 0 <<optional>> license <<end>>"),
    ("cc-by-4.0", "cc", "licensed under <<optional>> a <<end>> cc by 4 0 <<optional>> license <<end>>"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("copyright-notice", "reserved", "copyright <<any 1-12>> all rights reserved"),
]

_MARK = re.compile(r"<<(optional|end|one [^>]*|any \d+-\d+)>>|([0-9a-z\x80-\xff]+)")
#: Bytes that end a word become blanks; A-Z have been lower-cased before.
_BREAKS = bytes(i if 0x30 <= i <= 0x39 or 0x61 <= i <= 0x7A or i >= 0x80 else 0x20 for i in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.lower().translate(_BREAKS).split()


class Automaton:
    """Word automaton of one template. A transition's words are a set, or None for any word."""

    def __init__(self, template: str):
        self.step: list[list[tuple[frozenset | None, int]]] = [[]]
        self.skip: list[list[int]] = [[]]
        open_regions, at = [], 0
        for mark, word in _MARK.findall(template):
            if word:
                at = self._word(at, frozenset([word.encode()]))
            elif mark == "optional":
                open_regions.append(at)
            elif mark == "end":
                self.skip[open_regions.pop()].append(at)
            elif mark.startswith("one "):
                at = self._word(at, frozenset(w.encode() for w in mark[4:].split("|")))
            else:
                least, most = map(int, mark[4:].split("-"))
                places = [at]
                for _ in range(most):
                    at = self._word(at, None)
                    places.append(at)
                for p in places[least:-1]:
                    self.skip[p].append(at)
        self.final = at
        self.first = set()
        for s in self._reach({0}):
            for words, _ in self.step[s]:
                self.first |= words or set()

    def _word(self, at: int, words: frozenset | None) -> int:
        self.step.append([])
        self.skip.append([])
        self.step[at].append((words, len(self.step) - 1))
        return len(self.step) - 1

    def _reach(self, states: set[int]) -> set[int]:
        todo, out = list(states), set(states)
        while todo:
            for s in self.skip[todo.pop()]:
                if s not in out:
                    out.add(s)
                    todo.append(s)
        return out

    def match(self, words: list[bytes], start: int) -> int | None:
        """End of the longest match from ``start``, or None."""
        states, end, i = self._reach({0}), None, start
        while states:
            if self.final in states:
                end = i
            if i == len(words):
                break
            w = words[i]
            states = self._reach({t for s in states for ws, t in self.step[s] if ws is None or w in ws})
            i += 1
        return end


class Scanner:
    def __init__(self, templates=None, base: dict[str, str] | None = None):
        self.base = [(p.encode().split(), label) for p, label in (base or BASE).items()]
        self.templates = [(label, rare.encode(), Automaton(t)) for label, rare, t in (templates or TEMPLATES)]
        self.rare = {r for _, r, _ in self.templates} | {p[-1] for p, _ in self.base}

    def spans(self, words: list[bytes]) -> list[tuple[str, int, int]]:
        """(label, first word, word after the last) of all accepted places."""
        there = set(words)
        out = []
        for label, rare, automaton in self.templates:
            if rare in there:
                for i, w in enumerate(words):
                    if w in automaton.first and (end := automaton.match(words, i)) is not None:
                        out.append((label, i, end))
        return out

    def scan(self, text: bytes) -> tuple:
        low = text.lower().translate(_BREAKS)
        words = low.split()
        if not any(r in low for r in self.rare):
            return len(words), 0, None, None, "", "", 0.0
        places, labels = [], set()
        for phrase, label in self.base:
            n = len(phrase)
            found = [i for i, w in enumerate(words) if w == phrase[0] and words[i:i + n] == phrase]
            places += found
            labels |= {label} if found else set()
        more = {label for label, _, _ in self.spans(words)}
        return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)),
                ",".join(sorted(labels | more)), 1.0 if more else 0.5 if labels else 0.0)


SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def _scan(batches: Iterator[pa.RecordBatch], templates) -> Iterator[pa.RecordBatch]:
    scanner = Scanner(templates)
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
    for batch in batches:
        found = [scanner.scan(t) for t in utf8(batch.column(1))]
        columns = list(zip(*found)) if found else [()] * len(types)
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(columns, types)]],
                                         names=[f.split()[0] for f in SCHEMA.split(", ")])


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", templates=None) -> DataFrame:
    narrow = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(partial(_scan, templates=templates), SCHEMA)
