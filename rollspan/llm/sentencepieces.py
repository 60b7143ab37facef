"""Merge-type piece vocabularies: exact encoding by backtracking, and decoding.

A merge encoder starts from single characters and joins, again and again, the adjacent pair whose joint
piece scores best, the leftmost of equals. Its result is the only sequence of pieces in which every
two neighbours are compatible, that is, in which merging the two alone gives back the two: as long
as no merge crosses a border, the merges inside two neighbours are those of the two alone, so the first merge across
a border would also happen there. The encoder therefore never merges whole texts. It takes the
longest piece at each place (Aho-Corasick), tests it against the piece before by merging the two again, goes on
to shorter prefixes if they don't fit, and steps back if none does. The pieces up to a place are unique, so a
place without continuation is marked in a bitfield and never tried again: the work grows with the length.

Two characters that stand next to each other in no piece can't be merged across, so texts are cut between them (at
nearly every word border, and at most punctuation); a worker keeps the ids of the fragments that it has seen.

Cases: a null text is empty; an empty text has no ids but those of begin and end; characters outside
the vocabulary become the pieces of their bytes; names of control pieces in a text are ordinary text; very long texts and
words are encoded whole, in time linear in their length; repeated rows give repeated rows; null ids are kept; an
empty table gives no rows; other columns aren't read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rollspan.llm.frames import held, slices

#: The vocabulary's mark of a word border.
BORDER = "▁"
#: Fragments and tested pairs kept by a worker, and characters encoded at a time.
KEEP, PAIRS, AT_ONCE = 400_000, 400_000, 2_000_000


class MergeVocabulary:
    """Pieces with merge ranks, and the backtracking over them."""

    def __init__(self, ids: dict[str, int], rank: dict[str, float], byte_ids: list[int]):
        import ahocorasick

        self.ids, self.rank, self.byte_ids = ids, rank, byte_ids
        self.matcher = ahocorasick.Automaton()
        for piece in ids:
            self.matcher.add_word(piece, len(piece))
        self.matcher.make_automaton()
        #: Length of the longest proper prefix that is a piece; a single character always can be one.
        self.shorter = {p: next((n for n in range(len(p) - 1, 1, -1) if p[:n] in ids), 1) if len(p) > 1 else 0 for p in ids}
        self.fits: dict[tuple[str, str], bool] = {}

    def merged(self, text: str) -> list[str]:
        """The merge procedure itself, for texts of two pieces."""
        parts, rank = list(text), self.rank
        while len(parts) > 1:
            joint = [rank.get(a + b) for a, b in zip(parts, parts[1:])]
            best = min((r for r in joint if r is not None), default=None)
            if best is None:
                break
            i = joint.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def compatible(self, a: str, b: str) -> bool:
        """Whether merging ``a`` and ``b`` again gives back the two; ``a`` is empty at the beginning."""
        known = self.fits.get((a, b))
        if known is None:
            if len(self.fits) >= PAIRS:
                self.fits.clear()
            known = self.fits[a, b] = self.merged(a + b) == ([a, b] if a else [b])
        return known

    def pieces(self, text: str) -> list[str]:
        """Pieces of a normalised text; a character outside the vocabulary is a piece of its own."""
        n = len(text)
        if text in self.ids and self.compatible("", text):
            return [text]
        longest = [1] * n
        for last, size in self.matcher.iter(text):
            start = last + 1 - size
            if size > longest[start]:
                longest[start] = size
        failed = bytearray((n >> 3) + 1)
        shorter, known = self.shorter, self.fits.get
        out: list[str] = [""]
        at, size = 0, longest[0] if n else 0
        while at < n:
            end = at + size
            piece = text[at:end]
            if not failed[end >> 3] >> (end & 7) & 1:
                fits = known((out[-1], piece))
                if fits or fits is None and self.compatible(out[-1], piece):
                    out.append(piece)
                    at = end
                    size = longest[at] if at < n else 0
                    continue
            size = shorter.get(piece, 0)
            while not size:
                failed[at >> 3] |= 1 << (at & 7)
                piece = out.pop()
                at -= len(piece)
                size = shorter.get(piece, 0)
        return out[1:]

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for piece in self.pieces(text):
            known = self.ids.get(piece)
            out += [known] if known is not None else [self.byte_ids[b] for b in piece.encode()]
        return out


class PieceCodec:
    """Encoder and decoder of a model file; the file gives the pieces, their scores and the normalisation."""

    def __init__(self, path: str, keep: int = KEEP):
        from sentencepiece import SentencePieceProcessor

        self.model = model = SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(map(model.is_byte, byte_ids)):
            raise ValueError("the vocabulary needs a piece for every byte")
        if any(map(model.is_unused, range(len(names)))):
            raise ValueError("vocabularies with unused pieces aren't supported")
        plain = [i for i in range(len(names)) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        self.vocabulary = MergeVocabulary({names[i]: i for i in plain}, {names[i]: -model.get_score(i) for i in plain}, byte_ids)
        self._neighbours([names[i] for i in plain])
        self.begin, self.end = model.bos_id(), model.eos_id()
        value = {i: bytes([b]) for b, i in enumerate(byte_ids)}
        surfaces = [value[i] if i in value else b"" if model.is_control(i) else model.decode([i]).encode() if model.is_unknown(i)
                    else names[i].replace(BORDER, " ").encode() for i in range(len(names))]
        self.surface = np.frombuffer(b"".join(surfaces), np.uint8)
        self.surface_size = np.array([len(s) for s in surfaces], np.int64)
        self.surface_at = np.cumsum(self.surface_size) - self.surface_size
        self.is_byte = np.zeros(len(names), bool)
        self.is_byte[byte_ids] = True
        self.has_border = np.array([n.startswith(BORDER) for n in names])
        self.is_control = np.array([model.is_control(i) for i in range(len(names))])
        self.keep = keep
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.start, self.size = np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.pool, self.used = np.zeros(4096, np.uint32), 0

    def _numbers(self, fragments: list[str]) -> np.ndarray:
        """Places of different fragments in the pool; new ones are encoded."""
        number = self.number
        new = [f for f in fragments if f not in number]
        if new:
            found = [self.vocabulary.encode(f) for f in new]
            first, flat = len(number), np.fromiter((i for f in found for i in f), np.uint32)
            sizes = np.array([len(f) for f in found], np.int64)
            number.update(zip(new, range(first, first + len(new))))
            while len(number) > len(self.start):
                self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
            while self.used + len(flat) > len(self.pool):
                self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
            self.pool[self.used:self.used + len(flat)] = flat
            self.start[first:len(number)] = self.used + np.cumsum(sizes) - sizes
            self.size[first:len(number)] = sizes
            self.used += len(flat)
        return np.fromiter(map(number.__getitem__, fragments), np.int64, len(fragments))

    def _neighbours(self, pieces: list[str]) -> None:
        """Which characters stand next to each other in some piece, by the numbers of the vocabulary's characters."""
        characters = sorted({ch for p in pieces for ch in p})
        self.character = np.zeros(0x110000, np.int32)  # 0: in no piece
        self.character[[ord(ch) for ch in characters]] = np.arange(1, len(characters) + 1)
        self.together = np.zeros((len(characters) + 1,) * 2, bool)
        for p in pieces:
            at = self.character[[ord(ch) for ch in p]]
            self.together[at[:-1], at[1:]] = True

    def _fragments(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Places of the fragments of all texts one after another; fragments of each text."""
        text = "".join(texts)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        at = self.character[points]
        begins = np.ones(len(points), bool)
        begins[1:] = ~self.together[at[:-1], at[1:]]
        text_ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        begins[text_ends[text_ends < len(points)]] = True
        width = 1 + (points > 0x7F).astype(np.int8) + (points > 0x7FF) + (points > 0xFFFF)
        ends = np.append(np.flatnonzero(begins), len(points))
        byte_ends = np.concatenate([[0], np.cumsum(width)])[ends]
        found = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(byte_ends.astype(np.int64)), pa.py_buffer(text.encode()))
        # each distinct fragment of the batch is looked up once
        coded = found.dictionary_encode()
        number = self._numbers(coded.dictionary.to_pylist())
        return number[coded.indices.to_numpy()], np.diff(np.searchsorted(ends, text_ends), prepend=0)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, each between begin and end; ids of each text."""
        if len(self.number) > self.keep or self.used > 16 * self.keep:
            self._forget()
        at, counts = self._fragments(self.model.normalize(texts) if texts else [])
        size = self.size[at]
        ends = np.concatenate([[0], np.cumsum(size)])
        body = self.pool[np.repeat(self.start[at] - ends[:-1], size) + np.arange(ends[-1])]
        text_ends = ends[np.concatenate([[0], np.cumsum(counts)])]
        n = np.diff(text_ends)
        ids = np.insert(body, np.repeat(text_ends, 2)[1:-1], np.tile(np.array([self.begin, self.end], np.uint32), len(texts)))
        return ids, n + 2

    def _strict(self, ids: np.ndarray) -> bytes:
        """Surface piece by piece: in a run of byte pieces, each stray byte becomes a replacement character."""
        out, run = [], b""
        for i in [*ids.tolist(), None]:
            if i is not None and self.is_byte[i]:
                run += self._surface(i)
                continue
            while run:
                try:
                    out.append(run.decode())
                    run = b""
                except UnicodeDecodeError as e:
                    out.append(run[:e.start].decode() + "\ufffd")
                    run = run[e.start + 1:]
            if i is not None:
                out.append(self._surface(i).decode())
        return "".join(out).encode()

    @staticmethod
    def _is_text(raw: bytes) -> bool:
        try:
            raw.decode()
        except UnicodeDecodeError:
            return False
        return True

    def _surface(self, i: int) -> bytes:
        return self.surface[self.surface_at[i]:self.surface_at[i] + self.surface_size[i]].tobytes()

    def decode(self, ids: np.ndarray, lengths: np.ndarray) -> list[bytes]:
        """Text of each sequence in UTF-8. The border before the first word is no blank."""
        size = self.surface_size[ids]
        ends = np.concatenate([[0], np.cumsum(size)])
        raw = self.surface[np.repeat(self.surface_at[ids] - ends[:-1], size) + np.arange(ends[-1])].tobytes()
        bounds = np.concatenate([[0], np.cumsum(lengths)])
        strays, controls = (np.concatenate([[0], np.cumsum(x[ids])]) for x in (self.is_byte, self.is_control))
        out = []
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            text = raw[ends[a]:ends[b]]
            inner = b - a > 2 and controls[b - 1] > controls[a + 1]  # a control piece ends a run of bytes
            if strays[a] < strays[b] and (inner or not self._is_text(text)):
                text = self._strict(ids[a:b])
            while a < b and self.is_control[ids[a]]:
                a += 1
            out.append(text[1:] if a < b and self.has_border[ids[a]] else text)
        return out


def codec(path: str) -> PieceCodec:
    """The worker's codec for a model file; it outlives a task."""
    return held(("pieces", path), lambda: PieceCodec(path))


def _coded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    c = codec(path)
    for batch in batches:
        docs, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
        for a, b in slices(texts, AT_ONCE):
            ids, n = c.encode(texts[a:b])
            yield pa.RecordBatch.from_arrays(
                [docs.slice(a, b - a), pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(n)]).astype(np.int32), pa.array(ids.astype(np.int32))),
                 pa.array([t.decode() for t in c.decode(ids, n)], pa.string())], names=["doc_id", "ids", "decoded"])


def encode_documents(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids, decoded`` of every text: the ids with begin and end, and the text that they decode to."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        partial(_coded, path=path), "doc_id long, ids array<int>, decoded string")


def _digests(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    for batch in _coded(batches, path):
        lists = batch.column(1)
        ids, offsets = lists.values.to_numpy().astype("<u4"), lists.offsets.to_numpy()
        hashes = [hashlib.sha256(ids[a:b]).hexdigest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        texts = [hashlib.sha256(t).hexdigest() for t in batch.column(2).cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(offsets).astype(np.int64)), pa.array(hashes), pa.array(texts)],
                                         names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def digest_documents(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: :func:`encode_documents` with digests in place of ids and texts."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        partial(_digests, path=path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
