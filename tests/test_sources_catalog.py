import os

import pytest
from pyspark.sql import functions as F, types as T

import __spark_entry__ as entry_points
from check import compare, connect
from rollspan import catalog
from rollspan.operators import fill as fl
from rollspan.sources import tables as src

SF = "/root/testdata/sf0.001"


def test_partition_values_stay_text_and_overwrite_is_dynamic(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("007", 1), ("010", 2)], "date string, v int")
    src.write_partition(df, path)
    src.write_partition(df.where("date = '007'").withColumn("v", F.lit(9)), path)
    assert sorted(tuple(r) for r in src.scan(spark, path).select("date", "v").collect()) == [("007", 9), ("010", 2)]
    assert spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled") == "true"


def test_open_log_creates_once(spark, tmp_path):
    path, schema = str(tmp_path / "log"), T.StructType([T.StructField("a", T.StringType())])
    assert src.open_log(spark, path, schema).count() == 0
    src.append_rows(spark.createDataFrame([("x",)], schema), path)
    assert src.open_log(spark, path, schema).count() == 1


def test_latest_snapshot_empty_look_back(spark):
    df = spark.createDataFrame([("20230101", 1)], "d string, v int")
    assert src.latest_snapshot(df, "d", "20240101", 3).count() == 0
    assert src.latest_snapshot(df, "d").count() == 1


def test_fill_cap_rename(spark):
    df = spark.createDataFrame([(None, None, None)], "n int, top_item string, s string")
    assert tuple(fl.fill(df).first()) == (0, "ukn", "ukn")
    assert tuple(fl.fill(df, "items").first()) == (0, "null", None)
    assert tuple(fl.fill(df, "numeric").first()) == (0, None, None)
    with pytest.raises(ValueError, match="gone"):
        fl.fill(df, {"gone": 0})
    assert fl.fill(df, {"gone": 0}, absent="skip").columns == df.columns
    assert fl.cap(spark.createDataFrame([(None,), (5.0,), (50.0,)], "v double"), {"v": 10}).toPandas()["v"].tolist() == [0, 5, 10]
    assert fl.rename_by_stem(spark.createDataFrame([], "`f1_a*b` int, f2_c int"), ["f9_a*b"]).columns == ["f9_a*b", "f2_c"]


def test_entry_smoke(spark):
    df = entry_points.entry(spark)
    assert df.count() > 0 and "air_refill_sum_l24w" in df.columns


def test_every_survey_key_is_registered():
    names = set(entry_points.queries())
    assert len(names) > 170 and set(entry_points.oracle_sql()) <= names
    own = set(catalog.queries())
    assert own <= names and own - set(entry_points.oracle_sql()) == {"importance_selection"}


SAMPLE = ["family_location", "family_money_transfer", "family_bts_mapping", "family_ccbs_no", "family_monthly_cv207", "sliced_aggregates",
          "latest_per_key_join", "densify_calendar", "population_ntile", "dq_suite", "score_scale", "gini_by_segment_period", "psi_drift",
          "frequency_map_stats", "role_swap_call_stats", "stacked_score"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not mounted")
@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, name):
    assert compare(spark, connect(SF), name, SF).startswith("ok")
