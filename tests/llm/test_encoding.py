"""Ids of cut texts against undivided ones by the library's plain call; rows known by their place in files."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollspan.llm import frames, simhash
from rollspan.llm.encoding import PieceEncoder

vocabularies = pytest.importorskip("public_tokenizers")


def odd_texts(n=4000):
    r = random.Random(3)
    letters = "abcXYZ .,;:!?'\"-\n\t\r  0123éÀß×÷ÿ日本𝄞\xa0\x85́  <|endoftext|>()"
    out = ["", " ", "\n", "foo,bar.baz", "été.x", "×a,b", "a,", ",a", "don't 'tis rock'n'roll ''s it's5 x='s", "A" * 50_000, "a.b" * 3000]
    out += ["".join(r.choice(letters) for _ in range(r.randrange(30))) for _ in range(n)]
    names = ["<|endoftext|>", "<|startoftext|>", "<|endoftext|", "<|ENDOFTEXT|>"]
    return out + [r.choice(names).join("".join(r.choice(letters) for _ in range(r.randrange(8))) for _ in range(3)) for _ in range(300)]


@pytest.mark.parametrize("file, keeps_blanks", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_ids_are_those_of_the_plain_call(file, keeps_blanks):
    from tokenizers import Tokenizer
    path = vocabularies.path(file)
    whole, cut, texts = Tokenizer.from_file(path), PieceEncoder(path, keeps_blanks, keep=3000), odd_texts()
    for some in (texts[:2000], texts[2000:]):  # the second part after forgetting
        ids, n = cut.encode(some, 7)
        ends = np.cumsum(n)
        for text, a, b in zip(some, ends - n, ends):
            assert ids[a:b].tolist() == [*whole.encode(text, add_special_tokens=False).ids, 7], text


def test_words_are_known_before_any_punctuation():
    enc = PieceEncoder(vocabularies.path("byte_bpe_50k.json"), True)
    enc.encode([" word word! word$$$ word) word- word' word~ word] word_"], 0)
    assert set(enc.index) == {" word", "!", "$$$", ")", "-", "'", "~", "]", "_"}


def test_a_worker_holds_one_object():
    made = []
    for key in ("a", "a", "b", "a"):
        frames.held(key, lambda key=key: made.append(key) or key)
    assert made == ["a", "b", "a"]
    frames.release()
    assert not frames._HELD


def test_row_ids_are_the_same_in_every_scan(spark):
    path = f"{frames.shared_folder(spark)}/rows-{random.random()}"
    spark.range(30_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text")).repartition(3).write.parquet(path)
    stored = spark.read.parquet(path)
    seen = []
    try:
        for cores, size in (("2", "128m"), ("16", "100k")):
            spark.conf.set("spark.sql.files.minPartitionNum", cores)
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = frames.with_row_ids(spark.read.parquet(path), "_rid")
            seen.append((rows.rdd.getNumPartitions(), {r._rid: r.id for r in rows.select("_rid", "id").collect()}))
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert seen[0][0] != seen[1][0] and seen[0][1] == seen[1][1] and len(seen[0][1]) == 30_000
    made = frames.with_row_ids(stored.withColumn("more", F.lit(1)).distinct(), "_rid")
    assert made.select("_rid").distinct().count() == 30_000


def test_clashing_columns_of_copies_are_returned_as_they_are(spark):
    frames.prepare(spark)
    text = " ".join(f"w{i}" for i in range(50))
    docs = spark.createDataFrame([(1, text, "x", 5), (2, text.upper(), "y", 6), (3, "other", "z", 7)], "doc_id long, text string, _rid string, rid int")
    assert sorted(map(tuple, simhash.drop_copies(docs).collect())) == [(1, text, "x", 5), (3, "other", "z", 7)]
