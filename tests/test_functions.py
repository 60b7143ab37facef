from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from rollspan.functions import calendar as cal, fixed_values as fx, numeric as nu, text as tx


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("hour,slot,group,legacy", [
    (0, "nt", "nt", 12), (5, "nt", "nt", 5), (6, "mo", "dt", 6), (11, "mo", "dt", 11), (12, "af_ev", "dt", 12),
    (17, "af_ev", "dt", 5), (18, "nt", "nt", 6), (23, "nt", "nt", 11)])
def test_calendar_slices_edges(spark, hour, slot, group, legacy):
    df = spark.createDataFrame([(datetime(2024, 1, 6, hour, 0),)], "ts timestamp")
    row = cal.calendar_slices(df, "ts").first()
    assert (row["is_wk"], row["time_slot"], row["time_slot_grp"]) == (True, slot, group)
    assert cal.calendar_slices(df, "ts", legacy_hour12=True).first()["hour"] == legacy


def test_shift_months_clamps():
    assert cal.shift_months(date(2024, 3, 31), -1) == date(2024, 2, 29)
    assert cal.shift_months(date(2024, 1, 31), 1) == date(2024, 2, 29)
    assert cal.shift_months(date(2024, 1, 15), -13) == date(2022, 12, 15)
    assert cal.shift_months(date(2024, 12, 31), 2) == date(2025, 2, 28)


def test_period_calendar(spark):
    daily = [r["run_date"] for r in cal.period_calendar(spark, "20240130", "20240202", "daily").orderBy("run_date").collect()]
    assert daily == ["20240130", "20240131", "20240201"]
    weekly = [r["run_date"] for r in cal.period_calendar(spark, "20240102", "20240115", "weekly").orderBy("run_date").collect()]
    assert weekly == ["20240108", "20240115"]
    assert cal.period_calendar(spark, "20240102", "20240102", "daily").count() == 0


def test_snapshot_windows():
    w = cal.snapshot_windows("20240115")
    assert w["l4w"] == ("20231218", "20240115")
    assert w["month"] == ("20231216", "20240116")
    assert w["bill"][0] == "202311" and cal.snapshot_windows("20240114")["bill"][0] == "202310"
    assert cal.month_steps("20240129", 3) == ["20240129", "20240101", "20231204"]


def test_safe_ts_bad_and_sentinel(spark):
    df = spark.createDataFrame([("20240102030405",), ("null",), (None,)], "t string")
    got = [r[0] for r in df.select(cal.safe_ts("t", ["yyyyMMddHHmmss"], "1970-01-01 00:00:00").cast("string")).collect()]
    assert got == ["2024-01-02 03:04:05", "1970-01-01 00:00:00", "1970-01-01 00:00:00"]


def test_ratio_and_totals(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (None, 2), (3, 2), (None, None)], "a int, b int")
    got = df.select(nu.ratio("a", "b").alias("r"), nu.total(["a", "b"]).alias("t"), F.expr(nu.total_text(["a", "b"])).alias("tt"),
                    F.expr(nu.ratio_text("a", "b")).alias("rt")).collect()
    assert [r["r"] for r in got] == [None, None, None, 1.5, None] == [r["rt"] for r in got]
    assert [r["t"] for r in got] == [1, 1, 2, 5, None] == [r["tt"] for r in got]


def test_entropy_of_shares(spark):
    assert one(spark, nu.share_entropy([F.lit(0.5), F.lit(0.5), F.lit(0.0), F.lit(None).cast("double")])) == pytest.approx(1.0)


def test_segment_right_closed(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 579.0, 580.0, 799.0, 800.0, 1e9)], "v double")
    got = [r[0] for r in df.select(nu.segment("v", fx.SCORE_EDGES, fx.SCORE_LABELS)).collect()]
    assert got == [None, "Poor", "Fair", "Very Good", "Excellent", "Excellent"]


def test_band_edges(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (1000.0,), (99999.9,), (100000.0,)], "b double")
    got = nu.band_flags(df, "b", fx.BALANCE_BANDS).collect()
    assert [r["zero"] for r in got] == [1, 0, 0, 0, 0]
    assert [r["lt_1k"] for r in got] == [0, 1, 0, 0, 0]
    assert [r["1k_to_5k"] for r in got] == [0, 0, 1, 0, 0]
    assert [r["ge_100k"] for r in got] == [0, 0, 0, 0, 1]


def test_first_list_wins_when_ids_overlap(spark):
    assert one(spark, tx.map_ids(F.lit(250), fx.CONTINENT, "unknown")) == "Asia"
    assert one(spark, tx.map_ids(F.lit(520), fx.CONTINENT, "unknown")) == "Asia"
    assert one(spark, tx.map_ids(F.lit(1), fx.CONTINENT, "unknown")) == "unknown"


def test_rule_order_and_null(spark):
    df = spark.createDataFrame([("shopeepay",), ("Zing",), ("uber",), (None,)], "s string")
    got = [r[0] for r in df.select(tx.regex_rules(tx.tidy("s"), fx.SENDER_CATEGORY, "other")).collect()]
    assert got == ["finance", "other", "spending", "other"]


def test_multivalue_bucket(spark):
    df = spark.createDataFrame([("1024/8192",), ("2/4",), ("7",), ("x/16",), (None,)], "r string")
    got = [r[0] for r in df.select(tx.multivalue_bucket("r", "/", fx.RAM_BUCKETS, fx.RAM_LAST, fx.RAM_UNKNOWN, 100, 1024)).collect()]
    assert got == ["3. 6GB - 12GB", "1. 2GB - 4GB", "3. 6GB - 12GB", "4. 12GB+", None]


def test_split_and_valid_id(spark):
    assert one(spark, tx.part_of(F.lit("a-b-c"), "-", 4)) is None
    df = spark.createDataFrame([("0084123456789",), ("84123456789",), ("00841234567890",)], "m string")
    assert [r[0] for r in df.select(tx.valid_id("m")).collect()] == [True, False, False]


def test_merge_maps(spark):
    df = spark.sql("SELECT map('a', 1L, 'b', 2L) AS x, map('b', 3L) AS y, cast(null AS map<string, bigint>) AS z")
    row = df.select(tx.map_text(tx.merge_maps("x", "y")).alias("xy"), tx.map_text(tx.merge_maps("z", "y")).alias("zy")).first()
    assert (row["xy"], row["zy"]) == ("a:1,b:5", "b:3")
