from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from rollspan.operators import joins as jo, rollups as ru
from rollspan.operators.aggregates import Measure, sliced_stats

D = "20240129"


def days(spark, offsets, key="k"):
    data = [(key, (date(2024, 1, 29) - timedelta(days=o)).strftime("%Y%m%d"), float(o)) for o in offsets]
    return spark.createDataFrame(data, "msisdn string, s3_file_date string, v double")


def test_window_edges(spark):
    # snapshot day itself and the day before the widest window are outside
    df = days(spark, [0, 1, 7, 8, 28, 29, 84, 85, 168, 169])
    ms = [Measure("n", "rows"), Measure("s", "sum", "v"), Measure("mx", "max", "v")]
    row = ru.widen(ru.weekly(df, ["msisdn"], "s3_file_date", D, ms), ["msisdn"], ms).first()
    assert [row[f"n_l{n}w"] for n in (1, 4, 12, 24)] == [2, 4, 6, 8]
    assert [row[f"mx_l{n}w"] for n in (1, 4, 12, 24)] == [7.0, 28.0, 84.0, 168.0]


def test_absent_window_is_null(spark):
    ms = [Measure("n", "rows")]
    row = ru.widen(ru.weekly(days(spark, [100]), ["msisdn"], "s3_file_date", D, ms), ["msisdn"], ms).first()
    assert (row["n_l1w"], row["n_l24w"]) == (None, 1)


def test_placed_and_unplaced_widen_agree(spark):
    df = spark.range(2000).select((F.col("id") % 17).cast("string").alias("msisdn"),
                                  F.date_format(F.date_sub(F.lit(date(2024, 1, 29)), (F.col("id") % 170).cast("int")), "yyyyMMdd").alias("s3_file_date"), F.col("id").cast("double").alias("v_sum"))
    wk, ms = ru.daily_to_weekly(df, ["msisdn"], "s3_file_date", D, ["v_sum"], {"v_sum": "v_{op}"})
    a = ru.widen(wk, ["msisdn"], ms, placed=True)
    b = ru.widen(wk, ["msisdn"], ms)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    plan = a._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_trend_pairs(spark):
    df = spark.createDataFrame([(1, 2, 4, 0)], "x_l1w int, x_l4w int, x_l12w int, x_l24w int")
    allp = ru.trend_ratios(df, ["x"])
    skip = ru.trend_ratios(df, ["x"], pairs="skip1")
    assert [c for c in allp.columns if "_vs_" in c].__len__() == 6
    assert [c for c in skip.columns if "_vs_" in c] == ["x_l1w_vs_l12w", "x_l1w_vs_l24w", "x_l4w_vs_l24w"]
    row = allp.first()
    assert row["x_l1w_vs_l4w"] == 0.5 and row["x_l1w_vs_l24w"] is None


@pytest.mark.parametrize("day,m", [("2001-07-15", 1), ("2001-06-16", 1), ("2001-06-15", 2), ("2001-05-16", 2), ("2001-05-15", 3), ("2001-07-16", None)])
def test_month_index(spark, day, m):
    assert spark.range(1).select(ru.month_index(F.lit(date.fromisoformat(day)), "20010715").alias("m")).first()["m"] == m


@pytest.mark.parametrize("day,m", [("2024-03-31", 1), ("2024-03-01", 1), ("2024-02-29", 2), ("2024-02-01", 2), ("2024-01-31", 3)])
def test_month_index_at_month_end(spark, day, m):
    # D - n months clamps: 2024-02-29, 2024-01-31, ...
    assert spark.range(1).select(ru.month_index(F.lit(date.fromisoformat(day)), "20240331").alias("m")).first()["m"] == m


def test_cumulative_months_running_totals(spark):
    df = spark.createDataFrame([("k", 1, 10.0, 2, 4.0, 6.0, 52.0), ("k", 3, 5.0, 1, 5.0, 5.0, 25.0), ("z", 2, 0.0, 1, 0.0, 0.0, 0.0)],
                               "k string, m int, sum_v double, count_v int, min_v double, max_v double, sumsq_v double")
    out = {r["k"]: r for r in ru.cumulative_months(df, ["k"], "m", ["v"], 3).collect()}
    k = out["k"]
    assert [k[f"sum_v_T-{t}"] for t in (1, 2, 3)] == [10.0, 10.0, 15.0]
    assert [k[f"min_v_T-{t}"] for t in (1, 2, 3)] == [4.0, 4.0, 4.0]
    assert k["std_v_T-1"] == pytest.approx(1.0) and k["ratio_v_T-3"] == 1.5
    assert out["z"]["avg_v_T-1"] is None and out["z"]["ratio_v_T-2"] is None


def test_zero_fill_equals_densified_grid(spark):
    df = spark.createDataFrame([("a", "1", 5.0), ("a", "2", 7.0), ("b", "1", -3.0), ("c", "3", 2.0)], "k string, d string, v double")
    ms = [Measure(f"{a}_v", a, "v") for a in ("sum", "count", "min", "max", "sumsq")]
    daily = sliced_stats(df, ["k", "d"], ms)
    fast = ru.monthly_from_daily(daily, ["k"], ["v"], zero_fill=True, days=3)
    grid = jo.densify(daily, ["k"], "d", 0)
    assert grid.count() == 9
    slow = ru.monthly_from_daily(grid, ["k"], ["v"])
    assert fast.exceptAll(slow).count() == 0 and slow.exceptAll(fast).count() == 0


def test_cumulative_delta_resets_and_same_day(spark, as_rows):
    df = spark.createDataFrame([("k", "1", 4.0), ("k", "1", 6.0), ("k", "2", 10.0), ("k", "3", 2.0)], "k string, d string, v double")
    assert [r["v"] for r in as_rows(ru.cumulative_delta(df, ["k"], "d", ["v"]), "d")] == [10.0, None, 8.0]


def test_rings_give_the_same_windows_as_weeks(spark):
    from rollspan.plans.weekly import VOICE
    calls = spark.range(3000).select(
        (F.col("id") % 11).cast("string").alias("msisdn"), (F.col("id") % 23).cast("double").alias("call_duration"),
        F.element_at(F.array(*[F.lit(k) for k in ("MOC", "MTC", "ROA", "CF", "SMO", "SMT")]), (F.col("id") % 6 + 1).cast("int")).alias("call_type"),
        F.date_format(F.date_sub(F.lit(date(2024, 1, 29)), (F.col("id") % 190).cast("int")), "yyyyMMdd").alias("s3_file_date"))
    direct = VOICE.features(calls, D)
    stored = VOICE.from_weekly(VOICE.weekly(calls, D))
    assert direct.columns == stored.columns
    a, b = direct.toPandas().set_index("msisdn").sort_index(), stored.toPandas().set_index("msisdn").sort_index()
    assert ((a - b).abs().fillna(0) < 1e-9).all().all() and (a.isna() == b.isna()).all().all()
