import pytest
from pyspark.sql import functions as F

from rollspan.operators import jobs, quality as dq


def log_rows(spark, rows):
    full = [(f, v, d, "database", s, "t_x", "completeness", "null_ratio", "soft", 0.2, 0.05, "soft3", st) for f, v, d, s, st in rows]
    return spark.createDataFrame(full, dq.LOG_SCHEMA)


def test_row_duplicates_see_null_positions(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", "b"), ("a", "b"), ("~", None)], "x string, y string")
    row = dq.row_duplicates(df).first()
    assert (row["duplicate_keys"], row["duplicate_rows"], row["status"]) == (1, 2, "ERROR")


def test_moving_average_needs_n_days(spark, as_rows):
    log = log_rows(spark, [
        ("two", "1", "20240101x", "20240101", "PASS"), ("two", "3", "20240102x", "20240102", "PASS"),
        ("three", "1", "20240101a", "20240101", "PASS"), ("three", "9", "20240101b", "20240101", "PASS"),
        ("three", "2", "20240102a", "20240102", "PASS"), ("three", "4", "20240103a", "20240103", "PASS"),
        *[("four", str(i), f"2024010{i}a", f"2024010{i}", "PASS") for i in (1, 2, 3, 4)]])
    got = {r["feature_name"]: r["ma"] for r in as_rows(dq.moving_average(log, 3))}
    assert got == {"two": None, "three": 5.0, "four": 3.0}


@pytest.mark.parametrize("v,ma,layer,want", [
    (10.0, 10.0, "database", "PASS"), (10.4, 10.0, "database", "PASS"), (10.5, 10.0, "database", "WARNING"), (12.5, 10.0, "database", "ERROR"),
    (12.5, 10.0, "feature", "WARNING"), (5.0, None, "database", "PASS"), (0.0, 0.0, "database", "PASS"), (1.0, 0.0, "database", "ERROR")])
def test_status(spark, v, ma, layer, want):
    df = spark.createDataFrame([(v, ma)], "v double, ma double")
    assert df.select(dq.status(F.col("v"), F.col("ma"), 0.05, 0.2, layer).alias("s")).first()["s"] == want


def test_gate_takes_latest_entry(spark):
    log = log_rows(spark, [("f", "1", "20240101100000", "20240101", "ERROR"), ("f", "1", "20240101110000", "20240101", "PASS")])
    assert dq.gate(log, "20240101", "database").first()["status"] == "PASS"
    bad = log_rows(spark, [("f", "1", "20240101110000", "20240101", "ERROR")])
    with pytest.raises(dq.QualityError):
        dq.enforce(bad, "20240101", "database")


@pytest.mark.parametrize("kind,latest,asof,allow,want", [
    ("daily", "20240131", "20240201", 1, "PASS"), ("daily", "20240130", "20240201", 1, "ERROR"),
    ("weekly", "20240129", "20240201", 1, "PASS"), ("weekly", "20240122", "20240201", 1, "ERROR"),
    ("monthly", "202312", "20240201", 2, "PASS"), ("monthly", "202311", "20240201", 2, "ERROR")])
def test_freshness(spark, kind, latest, asof, allow, want):
    df = spark.createDataFrame([(latest,)], "d string")
    assert dq.freshness(df, "d", asof, kind, allow).first()["status"] == want


def test_suite_finds_planted_faults(spark):
    clean = spark.range(1000).selectExpr("id", "cast(id % 10 AS double) AS v", "'20240131' AS d")
    faulty = clean.withColumn("v", F.when(F.col("id") % 4 == 0, None).when(F.col("id") == 1, -1.0).otherwise(F.col("v"))).unionAll(clean.where("id = 7"))
    config = {"date": "d", "key": ["id"], "validity": {"v": (">=", 0)}}
    ratios = [("v", "0.01", f"2024010{i}", f"2024010{i}", "PASS") for i in (1, 2, 3)]
    log = log_rows(spark, ratios).withColumn("destination", F.lit("t"))
    good = {(r["metric_name"], r["feature_name"]): r["status"] for r in dq.run_suite(clean.withColumn("v", F.when(F.col("id") % 100 > 0, F.col("v"))), "t", config, "20240201", log=log).collect()}
    bad = {(r["metric_name"], r["feature_name"]): r["status"] for r in dq.run_suite(faulty, "t", config, "20240201", log=log).collect()}
    assert set(good.values()) == {"PASS"}
    assert {k for k, s in bad.items() if s == "ERROR"} == {("null_ratio", "v"), ("primary_key", "id"), ("duplicate_records", "*"), ("rule", "v")}


def test_feature_layer_only_on_mondays(spark):
    df = spark.range(3).toDF("k")
    assert dq.run_layer({"t": df}, {"t": {"key": ["k"]}}, "20240201", "feature") is None
    assert dq.run_layer({"t": df}, {"t": {"key": ["k"]}}, "20240129", "feature").count() > 0


def test_schema_checks(spark):
    a, b = spark.createDataFrame([], "x int, y string"), spark.createDataFrame([], "y string, x int, z int")
    assert dq.column_names(dq.schema_table(a), dq.schema_table(a.select("y", "x"))).first()["status"] == "PASS"
    got = {r["col_name"]: r["status"] for r in dq.column_types(dq.schema_table(a), dq.schema_table(b.withColumn("x", F.col("x").cast("long")))).collect()}
    assert got == {"x": "WARNING", "y": "PASS", "z": "WARNING"}


def test_pending_periods(spark):
    log = spark.createDataFrame([("1", 1, "DONE"), ("1", 2, "FAIL"), ("2", 1, "FAIL"), ("2", 2, "DONE")], "run_date string, update_time int, status string")
    cal = spark.createDataFrame([("1",), ("2",), ("3",)], "run_date string")
    assert [r[0] for r in jobs.pending_periods(cal, log).collect()] == ["1", "3"]
    assert jobs.pending_periods(cal, log, overwrite=True).count() == 3


def test_rowcount_first_run_has_no_status(spark):
    df = spark.createDataFrame([("20240103",)] * 10, "d string")
    short = spark.createDataFrame([("20240101", 10), ("20240102", 10)], "date string, row_count long")
    assert dq.rowcount_check(df, "d", short, "20240103").first()["status"] is None
    full = short.unionAll(spark.createDataFrame([("20231231", 10)], "date string, row_count long"))
    assert dq.rowcount_check(df, "d", full, "20240103").first()["status"] == "pass"
