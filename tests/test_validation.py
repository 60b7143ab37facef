"""Models per fold against numpy; folds of timestamps; odd rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rollspan.operators import validation as va


def rows(n=900, seed=2):
    r = np.random.default_rng(seed)
    a, b = r.normal(5, 2, n), r.normal(size=n)
    return pd.DataFrame({"t": pd.Timestamp("2024-01-01") + pd.to_timedelta(np.sort(r.integers(0, 90 * 86400, n)), unit="s"), "a": a, "b": b,
                         "y": (0.4 * a - b + r.normal(size=n) > 2).astype(int)})


def brute_gini(y, s):
    order = pd.Series(s).rank().to_numpy()
    p = y.sum()
    n = len(y) - p
    return 2 * (order[y == 1].sum() - p * (p + 1) / 2) / (p * n) - 1 if p and n else None


def test_folds_are_fitted_on_the_blocks_before_them(spark):
    pdf = rows()
    df = spark.createDataFrame(pdf).repartition(6)
    got = va.validate(df, "t", ["a", "b"], "y", folds=4).orderBy("fold").toPandas()
    blocks = va.time_blocks(df, "t", 4).toPandas()
    assert blocks.groupby(blocks["t"].dt.date)["block"].nunique().max() == 1
    assert (blocks.groupby("block").size() - len(pdf) / 5).abs().max() < 25
    for r in got.itertuples():
        train, test = blocks[blocks["block"] < r.fold], blocks[blocks["block"] == r.fold]
        x = np.column_stack([np.ones(len(train)), train[["a", "b"]]])
        want = np.linalg.lstsq(x, train["y"], rcond=None)[0]
        assert list(r.coefficients) == pytest.approx(list(want))
        assert (r.train_rows, r.test_rows) == (len(train), len(test))
        for part, g in ((train, r.train_gini), (test, r.test_gini)):
            assert g == pytest.approx(brute_gini(part["y"].to_numpy(), part[["a", "b"]].to_numpy() @ want[1:]))


def test_a_feature_that_repeats_another_changes_nothing(spark):
    pdf = rows(400)
    df = spark.createDataFrame(pdf.assign(copy=pdf["a"] * 2, flat=7.0))
    one = va.validate(df, "t", ["a", "b"], "y", 2).orderBy("fold").toPandas()
    two = va.validate(df, "t", ["a", "b", "copy", "flat"], "y", 2, digits=9).orderBy("fold").toPandas()
    assert list(two["test_gini"]) == pytest.approx(list(one["test_gini"]), abs=1e-6)


def test_rows_without_date_label_or_feature(spark):
    pdf = rows(300)
    extra = [(None, 1.0, 1.0, 1), (pdf["t"][5].to_pydatetime(), 1.0, 1.0, None), (pdf["t"][6].to_pydatetime(), None, None, 1)]
    df = spark.createDataFrame(pdf).unionByName(spark.createDataFrame(extra, "t timestamp, a double, b double, y long"))
    got = va.validate(df, "t", ["a", "b"], "y", 1).first()
    assert got.train_rows + got.test_rows == 301
    one_class = spark.createDataFrame(pdf).withColumn("y", F.lit(1))
    assert va.validate(one_class, "t", ["a"], "y", 1).first().test_gini is None
    assert va.validate(df.limit(0), "t", ["a"], "y", 2).count() == 0
