import math

import pytest
from pyspark.sql import functions as F

from rollspan.operators import aggregates as ag
from rollspan.operators.aggregates import Measure


def test_null_versus_zero(spark, as_rows):
    df = spark.createDataFrame([(1, "a", 5.0), (2, "b", None)], "k int, t string, v double")
    for where in ("t = 'a'", None):
        cond = where or (F.col("t") == "a")
        out = as_rows(ag.sliced_stats(df, ["k"], [
            Measure("rows", "rows", None, cond), Measure("hits", "hits", None, cond),
            Measure("s", "sum", "v" if where else F.col("v"), cond), Measure("z", "sum", "v" if where else F.col("v"), cond, "zero"),
            Measure("c", "count", "v" if where else F.col("v"), cond)]), "k")
        assert out == [{"k": 1, "rows": 1, "hits": 1, "s": 5.0, "z": 5.0, "c": 1}, {"k": 2, "rows": 0, "hits": None, "s": None, "z": 0.0, "c": 0}]


def test_slices_add_up(spark):
    df = spark.range(100).selectExpr("id % 7 AS k", "id % 2 = 0 AS is_wk", "cast(id AS double) AS v")
    ms = ag.slices(Measure("s", "sum", "v"), {"wk": "is_wk", "wd": "NOT is_wk"}) + ag.slices(Measure("n", "rows"), {"wk": "is_wk", "wd": "NOT is_wk"})
    for r in ag.sliced_stats(df, ["k"], ms).collect():
        assert r["s"] == r["s_wk"] + r["s_wd"] and r["n"] == r["n_wk"] + r["n_wd"]


def test_frequency_ties_and_single_value(spark, as_rows):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "c"), (1, "c"), (2, "x"), (2, "x"), (2, None), (3, None)], "k int, c string")
    out = as_rows(ag.frequency_stats(df, ["k"], "c"), "k")
    assert out[0] == {"k": 1, "most_item": "c", "least_item": "b", "unique": 3, "most_value": 2, "least_value": 1, "most_percent": 0.5, "least_percent": 0.25}
    assert out[1] == {"k": 2, "most_item": "x", "least_item": None, "unique": 1, "most_value": 2, "least_value": 0, "most_percent": 1.0, "least_percent": 0.0}
    assert len(out) == 2


def test_value_entropy_matches_definition(spark):
    df = spark.createDataFrame([("k", v) for v in "aabbbc"], "k string, v string")
    h = ag.value_entropy(df, ["k"], "v").first()["entropy"]
    assert h == pytest.approx(-sum(p * math.log2(p) for p in (2 / 6, 3 / 6, 1 / 6)))


def test_distinct_stats_equals_count_distinct(spark):
    df = spark.range(500).selectExpr("id % 9 AS k", "if(id % 11 = 0, null, id % 13) AS v", "id % 3 AS f")
    got = {r["k"]: (r["a"], r["b"]) for r in ag.distinct_stats(df, ["k"], "v", {"a": None, "b": "f = 1"}).collect()}
    want = {r["k"]: (r["a"], r["b"]) for r in df.groupBy("k").agg(
        F.count_distinct("v").alias("a"), F.count_distinct(F.when(F.col("f") == 1, F.col("v"))).alias("b")).collect()}
    assert got == want


def test_role_swap(spark, as_rows):
    df = spark.createDataFrame([("a", "b", "MOC", 5.0), ("b", "a", "MTC", 7.0), ("a", "c", "ROA", 1.0), ("a", "b", "??", 9.0)],
                               "x string, y string, t string, v double")
    out = as_rows(ag.role_swap_stats(df, "x", "y", "t", "v", {"MOC": "MTC", "MTC": "MOC"}, ["ROA"], stats=("sum", "count")), "msisdn")
    a, b, c = out
    assert (a["MOC_sum"], a["MTC_sum"], a["ROA_sum"]) == (12.0, None, 1.0)
    assert (b["MOC_sum"], b["MTC_sum"], b["MTC_count"]) == (None, 12.0, 2)
    assert (c["ROA_sum"], c["MOC_count"]) == (1.0, 0)


def test_two_party_days(spark, as_rows):
    df = spark.createDataFrame([("a", "b", 5.0, "20240101"), ("a", "b", 6.0, "20240101"), ("b", "a", 1.0, "20240102")], "s string, r string, v double, d string")
    daily, ms = ag.two_party_features(df, "s", "r", "v", "d", prefix="m")
    a = as_rows(ag.sliced_stats(daily, ["msisdn"], ms), "msisdn")[0]
    assert (a["m_sender_count"], a["m_sender_count_days"], a["m_sender_amount_sum"], a["m_receiver_count"], a["m_receiver_amount_max"]) == (2, 1, 11.0, 1, 1.0)
