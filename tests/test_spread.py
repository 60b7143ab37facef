"""Joins on keys that hold many rows, files of a wanted size, and greedy choice against a full matrix."""

import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rollspan.operators import joins as jo, selection as se
from rollspan.sources import tables as src


@pytest.fixture
def plain_shuffles(spark):
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    for k, v in zip(held, ("false", "-1", "64")):
        spark.conf.set(k, v)
    yield
    for k, v in held.items():
        spark.conf.set(k, v)


def largest_share(df):
    counts = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(counts) / sum(counts)


def test_no_task_gets_over_a_tenth_with_one_key_at_a_third(spark, plain_shuffles):
    n = 60_000
    events = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997).cast("int").alias("k"))
    dim = spark.range(997).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("v"))
    plain, spread = events.join(dim, "k"), jo.spread_join(events, dim, ["k"], share=0.01)
    assert largest_share(plain) > 0.33 and largest_share(spread) < 0.1
    assert spread.count() == n and plain.exceptAll(spread.select(*plain.columns)).count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_equals_the_join(spark, how):
    rows = [(i, "hot" if i % 2 else f"k{i % 7}", None if i % 5 == 0 else 1) for i in range(200)] + [(1, "hot", 1), (1, "hot", 1), (7, None, 1)]
    df = spark.createDataFrame(rows, "id int, k string, j int")
    dim = spark.createDataFrame([("hot", 1, "a"), ("hot", 1, "b"), ("k0", 1, "c"), ("k2", None, "d"), ("x", 1, "e")], "k string, j int, v string")
    want, got = df.join(dim, ["k", "j"], how), jo.spread_join(df, dim, ["k", "j"], how, share=0.05)
    assert sorted(map(str, want.collect())) == sorted(map(str, got.collect()))
    assert jo.spread_join(df.limit(0), dim, ["k", "j"], how).count() == 0
    with pytest.raises(ValueError):
        jo.spread_join(df, dim, ["k"], "right")


def test_files_have_the_wanted_size(spark, tmp_path):
    df = spark.range(400_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"), F.lit("same").alias("c"))
    first, second, small = (str(tmp_path / n) for n in "abc")
    src.write_sized(df, first, 1 << 20)
    target = 2 << 20
    n = src.write_sized(df, second, target, like=first)
    sizes = src.file_sizes(spark, second)
    assert len(sizes) == n > 3 and all(target / 2 <= s <= target * 2 for s in sizes)
    assert spark.read.parquet(second).count() == 400_000
    assert src.write_sized(df.limit(10), small, target, like=first) == 1 and len(src.file_sizes(spark, small)) == 1


@pytest.mark.parametrize("method", ["MIQ", "MID"])
def test_greedy_choice_equals_that_of_the_full_matrix(spark, method):
    r = np.random.default_rng(8)
    x = r.normal(size=(500, 6))
    x[:, 3] = x[:, 0] + 0.1 * x[:, 3]
    pdf = pd.DataFrame(x, columns=list("abcdef")).assign(y=(x[:, 0] + x[:, 1] + r.normal(size=500) > 0).astype(float), flat=1.0)
    pdf.loc[::9, "b"] = np.nan
    names = [*"abcdef", "flat"]
    corr = pdf.corr().abs().fillna(0)
    left, chosen, want = list(names), [], []
    for _ in range(5):
        def score(f):
            red = np.mean([corr.loc[f, c] for c in chosen]) if chosen else None
            return corr.loc[f, "y"] if red is None else corr.loc[f, "y"] / max(red, 1e-9) if method == "MIQ" else corr.loc[f, "y"] - red
        best = max(left, key=lambda f: (score(f), -names.index(f)))
        want.append((best, score(best)))
        chosen.append(best)
        left.remove(best)
    got = [(x.feature, x.score) for x in se.mrmr(spark.createDataFrame(pdf), names, "y", 5, method).orderBy("rank").collect()]
    assert [g[0] for g in got] == [w[0] for w in want] and [g[1] for g in got] == pytest.approx([w[1] for w in want])
    assert len(list(itertools.chain(se.mrmr(spark.createDataFrame(pdf), ["a"], "y", 4, method).collect()))) == 1
