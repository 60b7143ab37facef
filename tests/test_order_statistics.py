"""Exact order statistics against sorting; plans that shuffle no values."""

import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from rollspan.operators import order_statistics as os_, selection as se


def frame(spark, columns):
    n = max(map(len, columns))
    rows = list(zip(*[list(c) + [None] * (n - len(c)) for c in columns]))
    names = [f"c{i}" for i in range(len(columns))]
    return spark.createDataFrame(rows, ", ".join(f"{x} double" for x in names)), [F.col(x) for x in names]


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(st.one_of(st.floats(allow_nan=False), st.sampled_from([0.0, 1.0, -1.0, 1e300])), max_size=60), min_size=1, max_size=3))
def test_every_rank_is_that_of_sorting(spark, columns):
    df, cols = frame(spark, [*columns, [1.0]])
    sizes, found = os_.order_statistics(df, cols, lambda n: range(1, n + 1))
    assert sizes[:-1] == [len(c) for c in columns]
    assert [sorted(c) for c in columns] == found[:-1]


def test_rough_sketches_only_cost_rounds(spark, monkeypatch):
    """Sketches of ten points, far too rough for the ranks, on many distinct and on heavily repeated values."""
    monkeypatch.setattr(os_, "ACCURACY", 10)
    monkeypatch.setattr(os_, "GRID", 4)
    r = np.random.default_rng(4)
    data = {"spread": r.lognormal(0, 8, 4000), "ties": r.integers(0, 5, 4000).astype(float), "nan": np.where(r.random(4000) < .3, np.nan, r.random(4000))}
    df = spark.createDataFrame(pd.DataFrame(data)).repartition(5)
    ranks = [1, 2, 400, 1999, 2000, 3999, 4000]
    got = os_.order_statistics(df, [F.col(c) for c in data], lambda n: ranks)[1]
    for values, found in zip(data.values(), got):
        want = np.sort(values)
        assert np.array_equal([want[k - 1] for k in ranks], found, equal_nan=True)


def test_more_distinct_values_than_the_sketch_holds(spark):
    n = 2_000_000
    df = spark.range(n).select(((F.col("id") * 1_000_003) % n).cast("double").alias("x"), (F.col("id") % 3).cast("double").alias("few"))
    assert n > os_.ACCURACY
    edges = {r.feature: r.edges for r in se.quantile_edges(df, ["x", "few"], 10).collect()}
    assert edges == {"x": [n / 10 * i - 1 for i in range(1, 10)], "few": [0.0, 1.0, 2.0]}
    assert os_.percentiles(df, [F.col("x")], [0.25, 0.5])[0] == [pytest.approx((n - 1) * p) for p in (0.25, 0.5)]


def test_nothing_of_rows_times_features_is_shuffled(spark):
    """Before the exchange of counting stands a partial aggregate, and no sort."""
    df = spark.range(1000).select(*[(F.col("id") * i % 97).cast("double").alias(f"c{i}") for i in range(1, 6)], (F.col("id") % 2).alias("y"))
    bins = se.fit_bins(df, [f"c{i}" for i in range(1, 6)], "y", 4)
    plan = bins._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    # what is exchanged first is the partial aggregate of bins; later exchanges and the window see features x bins rows
    deepest = max(i for i, x in enumerate(lines) if "Exchange" in x)
    assert "HashAggregate" in lines[deepest + 1] and "partial_count" in lines[deepest + 1]
    assert not any("Sort" in x for x in lines[deepest:])


def test_empty_columns_and_names_with_quotes(spark):
    df = spark.createDataFrame([(1.0, None, 0), (2.0, None, 1), (None, None, None)], "`it's` double, none double, `a b` int")
    bins = {(r.feature, r.bin): (r.lo, r.hi, r.events, r.non_events) for r in se.fit_bins(df, ["it's", "none"], "a b", 2).collect()}
    assert bins["it's", 1] == (None, 1.0, 0, 1) and bins["it's", 2] == (1.0, None, 1, 0)
    assert bins["none", 0][:2] == (None, None) and ("it's", 0) in bins
    assert se.quantile_edges(df.limit(0), ["none"], 3).first().edges == []
    assert math.isnan(os_.percentiles(spark.createDataFrame([(float("nan"),)], "x double"), [F.col("x")], [0.5])[0][0])


def brute_ntile(rows, n):
    ranked = sorted(rows, key=lambda r: (r[1] is not None, -np.inf if r[1] is None else np.inf if r[1] != r[1] else r[1], r[0]))
    small, extra = divmod(len(rows), n)
    sizes = [small + (b < extra) for b in range(n)]
    return {r[0]: b + 1 for r, b in zip(ranked, [b for b, s in enumerate(sizes) for _ in range(s)])}


@pytest.mark.parametrize("kind", ["spread", "ties", "nulls", "one value", "few", "mixed", "empty"])
def test_population_buckets_are_those_of_sorting(spark, kind):
    from rollspan.operators.windows import population_ntile
    r = np.random.default_rng(2)
    n = {"few": 7, "empty": 0}.get(kind, 700)
    value = {"spread": lambda i: float(r.random()), "ties": lambda i: float(r.integers(0, 6)), "nulls": lambda i: None if r.random() < .5 else float(r.random()),
             "one value": lambda i: 3.0, "few": lambda i: float(r.integers(0, 3)), "empty": lambda i: 0.0,
             "mixed": lambda i: [None, float("nan"), 1.0, float(r.random()), -0.0][i % 5]}[kind]
    rows = [(f"{i:04d}", value(i)) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    for buckets in (10, 100, 3):
        got = {x.k: x.bucket for x in population_ntile(df, "v", "k", buckets).collect()}
        assert got == brute_ntile(rows, buckets)
