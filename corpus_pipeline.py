"""Corpus pipeline: toxicity, quality, near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept, and is written as
Parquet to the shared folder before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollspan.llm import kneser_ney, mixing, packing, simhash, toxicity
from rollspan.llm.frames import in_written_order, prepare, scratch_path, table
from rollspan.llm.queries import vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.7."""
    prepare(spark)
    return toxicity.drop_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity is within the 0.99 quantile of trusted documents of their language."""
    prepare(spark)
    return kneser_ney.drop_poor(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies, exact or near (5-word shingles, similarity 0.8)."""
    prepare(spark)
    return simhash.drop_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order that interleaves the sources by their weights."""
    prepare(spark)
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens, taken in the order of the mixture."""
    prepare(spark)
    return packing.pack_documents(in_written_order(docs, ["doc_id", "text"]), vocabulary("byte_bpe_50k.json"), keeps_blanks=True, end=0)


STAGES = [("toxicity", drop_toxic), ("quality", drop_poor), ("near_duplicates", drop_copies), ("mixing", mix), ("packing", pack)]

#: Tokens, perplexities and similarities have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        out = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return STAGES[-1][1](spark, docs, sf_dir)
