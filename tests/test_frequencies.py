"""Frequency states against counting in Python; a key with a million items."""

import random
from collections import Counter

from pyspark.sql import functions as F

from rollspan.operators import aggregates as ag


def test_states_merge_to_the_counts_of_all_rows(spark):
    r = random.Random(3)
    rows = [(r.choice(["a", "b", None]), r.choice(["x", "y", "zz", "", None])) for _ in range(500)]
    df = spark.createDataFrame([(i, *x) for i, x in enumerate(rows)], "i int, k string, item string")
    parts = [df.where(F.col("i") % 3 == p) for p in range(3)]
    want = Counter(x for x in rows if x[1] is not None)
    states = [ag.frequency_counts(p, ["k"], "item") for p in parts]
    got = {(x.k, x.item): x.n for x in ag.merge_counts(states, ["k"]).collect()}
    assert got == want
    a, b = (ag.frequency_map(p, ["k"], "item") for p in (parts[0].union(parts[1]), parts[2]))
    maps = {x.k: x.freq for x in ag.merge_frequency(a, b, ["k"]).collect()}
    assert maps == {k: {i: n for (kk, i), n in want.items() if kk == k} for k in ("a", "b", None)}
    top = {x.k: x.freq for x in ag.merge_frequency(a, b, ["k"], top=2).collect()}
    for k, items in maps.items():
        assert top[k] == dict(sorted(items.items(), key=lambda x: (-x[1], x[0]))[:2])


def test_a_key_with_a_million_items(spark):
    """All but a few rows belong to one key whose items are nearly all different."""
    n = 1_000_000
    df = spark.range(n + 1000).select(F.when(F.col("id") < n, "hot").otherwise("cold").alias("k"),
                                      F.when(F.col("id") % 100_000 < 7, "often").otherwise(F.concat(F.lit("i"), F.col("id"))).alias("item"))
    counts = ag.frequency_counts(df, ["k"], "item")
    stats = {x.k: x for x in ag.count_stats(ag.merge_counts([counts], ["k"]), ["k"], {"": "n"}).collect()}
    assert (stats["hot"].most_item, stats["hot"].most_value, stats["hot"].unique) == ("often", 70, n - 69)
    assert stats["hot"].least_item == f"i{n - 1}" and stats["cold"].unique == 994
    top = ag.top_items(counts, ["k"], 2)
    assert [(x.item, x.n) for x in top.where("k = 'hot'").orderBy("rank").collect()] == [("often", 70), ("i10", 1)]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "collect" not in plan
    assert ag.frequency_map(df, ["k"], "item", top=3).select(F.max(F.size("freq"))).first()[0] == 3
