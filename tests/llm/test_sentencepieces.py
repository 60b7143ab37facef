"""Merge-type pieces against the library, and the backtracking against merging whole texts."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from rollspan.llm import sentencepieces
from rollspan.llm.frames import prepare

vocabularies = pytest.importorskip("public_tokenizers")
PATH = vocabularies.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor
    return SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def own():
    return sentencepieces.PieceCodec(PATH)


def odd_texts(library, n=1500):
    r = random.Random(3)
    letters = "abcdefghij ETAON  \n\t.,▁éß日本𝄞\x00​<0x41>"
    out = ["", " ", "  ", "a", "▁", "▁▁", " ▁ a", "<s>a</s><unk>", "a  b ", "x" * 3000, "ab" * 5000, "日" * 50, "word " * 2000]
    for _ in range(n):
        out.append("".join(r.choice(letters) for _ in range(r.randrange(40))))
        out.append("".join(library.id_to_piece(r.randrange(3, 32000)).replace("▁", " ") for _ in range(r.randrange(10))))
        out.append("".join(chr(r.choice([r.randrange(32, 127), r.randrange(160, 0x3000), r.randrange(0x10000, 0x1ffff)])) for _ in range(r.randrange(15))))
    return out


def test_ids_and_texts_are_those_of_the_library(library, own):
    texts = odd_texts(library)
    ids, n = own.encode(texts)
    ends = np.cumsum(n)
    decoded = own.decode(ids, n)
    for text, a, b, back in zip(texts, ends - n, ends, decoded):
        want = library.encode(text, add_bos=True, add_eos=True)
        assert ids[a:b].tolist() == want, text
        assert back.decode() == library.decode(want)


def test_any_ids_decode_as_in_the_library(library, own):
    r = random.Random(4)
    rows = [[r.choice([1, 2, r.randrange(3, 259), r.randrange(32000), 259]) for _ in range(r.randrange(12))] for _ in range(3000)]
    got = own.decode(np.array([i for x in rows for i in x]), np.array([len(x) for x in rows]))
    assert [g.decode() for g in got] == [library.decode(x) for x in rows]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["ab", "bc", "abc", "ca", "aa", "aaa", "bca", "cab", "abab", "cc"]), unique=True, min_size=1),
       st.text("abcd", max_size=30))
def test_backtracking_equals_merging(pieces, text):
    """Small vocabularies in any order of merges; ``d`` is in none of them."""
    names = list("abc") + pieces
    vocabulary = sentencepieces.MergeVocabulary({p: i for i, p in enumerate(names)}, {p: float(i) for i, p in enumerate(names)}, list(range(256)))
    assert vocabulary.pieces(text) == vocabulary.merged(text)


def test_a_full_worker_forgets_and_goes_on(library):
    small = sentencepieces.PieceCodec(PATH, keep=5)
    for text in ["one two three four five six seven", "eight nine ten", "one two"]:
        assert small.encode([text])[0].tolist() == library.encode(text, add_bos=True, add_eos=True)


def test_documents_with_odd_rows(spark, library):
    prepare(spark)
    schema = "doc_id long, text string, ids string, decoded int, n_tokens double"
    texts = [None, "", "one", "one", "  two\n", "long " * 200_000, "日本 𝄞"]
    rows = [(None if i == 4 else i // 2, t, "x", 1, 0.5) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, schema)
    got = sorted(map(tuple, sentencepieces.digest_documents(docs, PATH).collect()), key=str)
    want = []
    for i, t, *_ in rows:
        ids = library.encode(t or "", add_bos=True, add_eos=True)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert got == sorted(want, key=str)
    coded = sentencepieces.encode_documents(docs, PATH)
    assert sorted(len(r.ids) for r in coded.collect()) == sorted(w[1] for w in want)
    assert {r.decoded for r in coded.collect()} == {t or "" for t in texts}
    assert sentencepieces.digest_documents(docs.limit(0), PATH).count() == 0
