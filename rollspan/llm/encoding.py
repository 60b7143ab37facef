"""Token ids of whole texts by a tokenizer file, with each distinct piece of text encoded once.

Both vocabularies split a text before they merge, and never merge across a place where a
new word begins. A text may therefore be cut at those places, the pieces encoded one by
one, and the ids put together. Words repeat, so a worker keeps the ids of the pieces that it has
seen. A text that names a special token, which the library takes for that token, is encoded undivided. ``tests/llm/test_operators.py``
compares the ids with those of undivided texts.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable
from itertools import chain, islice
from zlib import crc32

import numpy as np
import pyarrow as pa

from rollspan.llm.frames import held, slices

#: White space beyond blanks, tabs and line ends; a text with any of it is encoded undivided.
RARE_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Letters after which an ASCII character that is neither letter, digit nor white space begins a new word in the vocabulary that keeps blanks.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
#: A blank goes with the word after it; a line end before a word stands alone.
LEADING_BLANK = re.compile(
    rf" ?(?:[{LETTERS}]++(?=[!-/:-@\[-`{{-~])|[^ \t\n\r]++)|\n(?=[^ \t\n\r])|[ \t\n\r]+?(?= [^ \t\n\r]|\n[^ \t\n\r])"
    r"|[ \t\n\r]+[^ \t\n\r]+|[ \t\n\r]+")
#: Bytes in lower case (the vocabulary without blanks lower-cases), and their kinds.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
BLANK, LETTER, DIGIT, OTHER, APOSTROPHE, HIGH = range(6)
KIND = np.full(256, OTHER, np.uint8)
KIND[list(b" \t\n\r")], KIND[ord("'")], KIND[0x80:] = BLANK, APOSTROPHE, HIGH
KIND[ord("a"):ord("z") + 1], KIND[ord("0"):ord("9") + 1] = LETTER, DIGIT
#: Pieces kept by a worker, and characters encoded at a time.
KEEP, AT_ONCE = 500_000, 1_000_000


class _Index(dict):
    """Numbers pieces in the order in which they are first seen."""

    def __missing__(self, piece: str) -> int:
        self[piece] = n = len(self)
        return n


def words_between(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """Pieces between white space, in lower case as far as ASCII, one after another; pieces of each text.

    The vocabulary takes runs of letters, single digits and runs of other characters as words, but an apostrophe with some letters after it, too.
    So a piece ends after letters and digits before any other ASCII character, and after other ASCII characters but the apostrophe before a letter or
    digit. Texts are cut as bytes, all at a time.
    """
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)  # each text ends in white space
    ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    data = LOWER[data]
    kind = KIND[data]
    # both bytes of the letters U+00C0 to U+00FF
    after = data[1:]
    pair = (data[:-1] == 0xC3) & (after >= 0x80) & (after <= 0xBF) & (after != 0x97) & (after != 0xB7)
    kind[:-1][pair] = kind[1:][pair] = LETTER
    before = np.append(np.uint8(BLANK), kind[:-1])[:len(data)]
    begins = (before == BLANK) | (before == DIGIT) & (kind < HIGH) | (before == LETTER) & (kind != LETTER) & (kind < HIGH) | (before == OTHER) & (kind <= DIGIT)
    inside = kind != BLANK
    start = np.flatnonzero(begins & inside)
    counts = np.diff(np.searchsorted(start, ends), prepend=0)
    # without the white space between, each piece ends where the next begins
    offsets = np.append((np.cumsum(inside) - 1)[start], np.count_nonzero(inside)).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(offsets), pa.py_buffer(data[inside])), counts


class PieceEncoder:
    """Encodes lists of texts; ``keeps_blanks`` says whether white space takes ids."""

    def __init__(self, path: str, keeps_blanks: bool, keep: int = KEEP):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.names = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.keeps_blanks, self.keep = keeps_blanks, keep
        self._forget()

    def _forget(self) -> None:
        self.index = _Index()
        self.known = 0
        self.start, self.length = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.pool, self.used = np.zeros(4096, np.uint32), 0

    def _learn(self) -> None:
        """Encode the pieces numbered since the last call, each as a word of its own."""
        first, total = self.known, len(self.index)
        new = list(islice(reversed(self.index), total - first))[::-1]
        found = self.tokenizer.encode(new, is_pretokenized=True, add_special_tokens=False)
        ids = np.array(found.ids, np.uint32)
        n = np.bincount(np.array(found.word_ids, np.int64), minlength=len(new))
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        while total > len(self.start):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
        self.pool[self.used:self.used + len(ids)] = ids
        self.start[first:total] = self.used + np.cumsum(n) - n
        self.length[first:total] = n
        self.used += len(ids)
        self.known = total

    def _undivided(self, text: str) -> bool:
        return any(name in text for name in self.names) or RARE_SPACE.search(text) is not None

    def _numbered(self, pieces: Iterable[str], n: int) -> np.ndarray:
        return np.fromiter(map(self.index.__getitem__, pieces), np.int64, n)

    def _pieces(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the pieces of all texts one after another; pieces of each text."""
        if self.keeps_blanks:
            found = [[t] if self._undivided(t) else LEADING_BLANK.findall(t) for t in texts]
            counts = np.array(list(map(len, found)), np.int64)
            return self._numbered(chain.from_iterable(found), int(counts.sum())), counts
        whole = np.array([self._undivided(t) for t in texts], bool)
        words, n = words_between([t.encode() for t, w in zip(texts, whole) if not w])
        coded = words.dictionary_encode()  # each distinct word is looked up once
        counts = np.ones(len(texts), np.int64)
        counts[~whole] = n
        at, own = np.empty(counts.sum(), np.int64), np.repeat(whole, counts)
        at[~own] = self._numbered(coded.dictionary.to_pylist(), len(coded.dictionary))[coded.indices.to_numpy()]
        at[own] = self._numbered([t for t, w in zip(texts, whole) if w], int(whole.sum()))
        return at, counts

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.index) > self.keep:
            self._forget()
        at, counts = self._pieces(texts)
        if len(self.index) > self.known:
            self._learn()
        n = self.length[at]
        ends = np.concatenate([[0], np.cumsum(n)])
        ids = self.pool[np.repeat(self.start[at] - ends[:-1], n) + np.arange(ends[-1])]
        return ids, np.diff(ends[np.concatenate([[0], np.cumsum(counts)])])

    def encode(self, texts: list[str], end: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, each text's followed by ``end``; ids of each text."""
        out, lengths = [], []
        for a, b in slices(texts, AT_ONCE):
            ids, n = self._encode(texts[a:b])
            out.append(np.insert(ids, np.cumsum(n), np.uint32(end)))
            lengths.append(n + 1)
        return (np.concatenate(out), np.concatenate(lengths)) if out else (np.zeros(0, np.uint32), np.zeros(0, np.int64))

    @property
    def size(self) -> int:
        return self.tokenizer.get_vocab_size()


def encoder(path: str, keeps_blanks: bool) -> PieceEncoder:
    """The worker's encoder for a vocabulary; it outlives a task."""
    return held((path, keeps_blanks), lambda: PieceEncoder(path, keeps_blanks))


def ids_crc(ids: np.ndarray) -> int:
    """CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return crc32(np.ascontiguousarray(ids, "<u4").data)
