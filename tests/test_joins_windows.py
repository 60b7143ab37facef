import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rollspan.operators import joins as jo, windows as wi


def test_latest_ties_and_null_order(spark, as_rows):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "z"), (2, None, "n"), (2, 1, "v"), (3, None, "only")], "k int, t int, v string")
    assert [r["v"] for r in as_rows(wi.latest_per_key(df, ["k"], ["t"]), "k")] == ["b", "v", "only"]
    assert [r["v"] for r in as_rows(wi.latest_per_key(df, ["k"], ["t"], ties="all"), "k", "v")] == ["a", "b", "v", "only"]


def test_top1_tie_goes_to_smaller(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, "a"), (1, "c")], "k int, v string")
    assert tuple(wi.top1_by_count(df, ["k"], "v").first()) == (1, "a", 2)


def test_global_prefix_with_a_hot_value(spark):
    # one value holds most rows: it must spread over partitions and still number exactly
    df = spark.range(5000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 50).alias("v"), "id", F.lit(2).alias("w"))
    out = wi.global_prefix(df, ["v", "id"], ["w"]).toPandas().sort_values(["v", "id"]).reset_index(drop=True)
    assert (out["rn"] == np.arange(1, 5001)).all()
    assert (out["cum_w"] == 2 * np.arange(1, 5001)).all()


@pytest.mark.parametrize("rows", [5, 100, 1037])
def test_ntile_matches_brute_force(spark, rows):
    df = spark.range(rows).select("id", (F.col("id") % 10).alias("v"))
    got = wi.population_ntile(df, "v", "id", 10).toPandas().sort_values(["v", "id"])["bucket"].tolist()
    size, extra = divmod(rows, 10)
    want = [b + 1 for b in range(10) for _ in range(size + (b < extra))]
    assert got == want


def test_approximate_ntile_is_close(spark):
    df = spark.range(10000).select("id", F.col("id").cast("double").alias("v"))
    got = wi.population_ntile(df, "v", "id", 100, exact=False).groupBy("bucket").count().toPandas()
    assert len(got) == 100 and got["count"].between(90, 110).all()


def test_exact_percentiles(spark):
    values = np.random.default_rng(3).integers(0, 40, 999).astype(float)
    df = spark.createDataFrame(pd.DataFrame({"v": values}))
    row = wi.exact_percentiles(df, "v", [0.0, 0.25, 0.5, 0.9, 1.0], list("abcde")).first()
    assert list(row) == pytest.approx(list(np.quantile(values, [0, 0.25, 0.5, 0.9, 1])))


def test_outer_merge_forms_agree(spark):
    a = spark.createDataFrame([(1, 10), (2, 20)], "k int, a int")
    b = spark.createDataFrame([(2, 5), (3, 6)], "k int, b int")
    x, y = jo.outer_merge([a, b], ["k"]), jo.outer_merge_long([a, b], ["k"])
    assert x.exceptAll(y).count() == 0 and x.count() == y.count() == 3


@pytest.mark.parametrize("how", ["inner", "left", "full_outer"])
def test_merge_report_counts_the_real_join(spark, how):
    a = spark.createDataFrame([(1, 1), (1, 2), (2, 3), (4, 4)], "k int, a int")
    b = spark.createDataFrame([(1, 1), (1, 2), (3, 3)], "k int, b int")
    rep = jo.merge_report(a, b, ["k"], how).first()
    assert rep["merged_rows"] == a.join(b, ["k"], how).count()
    assert rep["ok"] is False


def test_guarded_join_raises(spark):
    a = spark.createDataFrame([(1, 1), (2, 2)], "k int, a int")
    jo.guarded_join(a, a.withColumnRenamed("a", "b"), ["k"], "inner", "raise")
    with pytest.raises(jo.MergeGuard):
        jo.guarded_join(a, a.where("k = 1").withColumnRenamed("a", "b"), ["k"], "inner", "raise")
    with pytest.raises(jo.MergeGuard):
        jo.guarded_join(a, a, ["k"])


def test_spine_and_month_shift(spark, as_rows):
    a = spark.sql("SELECT 1 AS k, date'2024-01-31' AS d, 5 AS v UNION ALL SELECT 1, date'2024-02-29', 6")
    out = as_rows(jo.month_shift_join(a, ["k"], "d", 1), "d")
    assert [(r["v"], r["v_prev"]) for r in out] == [(5, None), (6, 5), (None, 6)]
    ids = jo.spine([a.select("k"), spark.createDataFrame([(None,), (7,)], "k int")], "k")
    assert sorted(r["k"] for r in ids.collect()) == [1, 7]
