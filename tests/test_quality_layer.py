"""The compiled suite: scans, dates without rows, baselines per date, and agreement with the single checks."""

from pyspark.sql import functions as F

from rollspan.operators import quality as dq

CONFIG = {"columns": ["a", "b"], "partition": "day", "date": "day", "update_type": "daily", "expected_day": 0, "key": ["a"], "validity": {"b": (">", 0), "a": ("in", [1, 2, 3])}}
DATES = ["20240108", "20240109", "20240110"]


def rows(spark):
    return spark.createDataFrame([(1, 5, "20240108"), (1, 5, "20240108"), (2, None, "20240108"), (None, -1, "20240108"),
                                  (9, 1, "20240109"), (3, 2, "20240109"), (1, 1, "20231201")], "a int, b int, day string")


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Relation [")


def test_a_table_is_scanned_three_times_whatever_it_is_checked_for(spark, tmp_path):
    path = str(tmp_path / "t")
    rows(spark).write.parquet(path)
    df = spark.read.parquet(path)
    assert scans(dq.run_suite(df, "t", CONFIG, DATES)) == 3
    assert scans(dq.run_suite(df, "t", {"columns": ["a", "b"], "validity": CONFIG["validity"], "date": "day"}, "20240108")) == 2
    assert scans(dq.run_layer({"t": df, "u": df}, {"t": CONFIG, "u": {}}, DATES, "database")) == 5


def test_each_date_sees_its_rows_and_a_date_without_rows_is_reported(spark):
    got = {(r.snapshot, r.metric_name, r.feature_name): (r.metric_value, r.status) for r in dq.run_suite(rows(spark), "t", CONFIG, DATES).collect()}
    assert got["20240108", "null_count", "a"] == ("1", "PASS") and got["20240108", "null_ratio", "b"] == ("0.25", "PASS")
    assert got["20240108", "primary_key", "a"] == ("1", "ERROR") and got["20240108", "duplicate_records", "*"] == ("2", "ERROR")
    assert got["20240108", "rule", "b"] == ("1", "ERROR") and got["20240109", "rule", "a"] == ("1", "ERROR")
    assert got["20240109", "primary_key", "a"] == ("0", "PASS") and got["20240109", "freshness", "day"] == ("20240109", "PASS")
    assert got["20240110", "row_count", "a"] == ("0", "PASS") and got["20240110", "null_ratio", "a"] == (None, "PASS")
    assert got["20240110", "freshness", "day"] == (None, "ERROR") and got["20240110", "duplicate_records", "*"] == ("0", "PASS")
    assert len(got) == 3 * (6 + 1 + 2 + 2)


def test_counts_equal_those_of_the_single_checks(spark):
    df = rows(spark).withColumn("day", F.col("day").cast("int"))
    config = {"columns": ["a", "b", "day"], "key": ["a", "b"], "validity": {"b": (">=", 1)}}
    got = {(r.metric_name, r.feature_name): r.metric_value for r in dq.run_suite(df, "t", config, "20240201").collect()}
    for r in dq.completeness(df).collect():
        assert (got["null_ratio", r.feature_name], got["null_count", r.feature_name], got["row_count", r.feature_name]) == (str(r.null_ratio), str(r.null_count), str(r.row_count))
    assert got["primary_key", "a,b"] == str(dq.pk_duplicates(df, ["a", "b"]).first().duplicate_keys)
    assert got["duplicate_records", "*"] == str(dq.row_duplicates(df).first().duplicate_rows)
    assert got["rule", "b"] == str(dq.validity(df, config["validity"]).first().metric_value)


def test_the_log_before_each_date_is_its_baseline(spark):
    log = spark.createDataFrame([("t_x", "completeness", "row_count", "a", d, d, str(v)) for d, v in (("20240101", 2), ("20240102", 2), ("20240103", 2), ("20240108", 100))],
                                "destination string, dimension string, metric_name string, feature_name string, log_date string, snapshot string, metric_value string")
    got = {(r.snapshot, r.metric_name, r.feature_name): r.status for r in dq.run_layer({"t/x": rows(spark)}, {"t/x": CONFIG}, DATES[:2], "database", log).collect()}
    assert got["20240108", "row_count", "a"] == "ERROR"      # 3 rows, mean 2
    assert got["20240109", "row_count", "a"] == "ERROR"      # 2 rows, mean of 2, 2, 100
    assert got["20240109", "row_count", "b"] == "PASS"       # no baseline
    assert dq.run_layer({"t/x": rows(spark)}, {"t/x": CONFIG}, DATES[1:], "feature", log) is None
    empty = dq.run_suite(rows(spark).limit(0), "t", CONFIG, "20240108").where("metric_name = 'row_count'").collect()
    assert [r.metric_value for r in empty] == ["0", "0"]
