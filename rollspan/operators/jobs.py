"""Run log, pending periods and incremental slices."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from rollspan.operators.windows import latest_per_key

RUN_SCHEMA = T.StructType([
    T.StructField("feature_dir", T.StringType()), T.StructField("update_time", T.TimestampType()),
    T.StructField("run_date", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("duration", T.FloatType()), T.StructField("executor_memory", T.FloatType()),
    T.StructField("executor_cores", T.IntegerType()), T.StructField("num_executors", T.IntegerType()),
    T.StructField("driver_memory", T.FloatType()), T.StructField("driver_cores", T.IntegerType()),
])


def completed(log: DataFrame) -> DataFrame:
    """Periods whose latest log entry is DONE."""
    latest = latest_per_key(log.select("run_date", "update_time", "status"), ["run_date"], ["update_time"])
    return latest.where(F.col("status") == "DONE").select("run_date")


def pending_periods(calendar: DataFrame, log: DataFrame, overwrite: bool = False) -> DataFrame:
    """Calendar periods that still have to run, in order."""
    left = calendar if overwrite else calendar.join(completed(log), "run_date", "left_anti")
    return left.select("run_date").orderBy("run_date")


def pending_partitions(wanted: DataFrame, existing: DataFrame, col: str) -> DataFrame:
    """Wanted partition values without output yet."""
    return wanted.select(col).distinct().join(existing.select(col).distinct(), col, "left_anti")


def run_report(log: DataFrame, start_time: str) -> DataFrame:
    """Log of one batch of runs (same minute-level start time) with a readable timestamp."""
    return (log.withColumn("update_time", F.date_format("update_time", "yyyy-MM-dd HH:mm:ss"))
            .where(F.col("update_time") >= start_time))


def last_success(log: DataFrame, table_col: str = "table_name", date_col: str = "success_date") -> DataFrame:
    """Newest successful date per table."""
    return log.groupBy(table_col).agg(F.max(date_col).alias(date_col))


def pending_slices(src: DataFrame, date_col: str, key_col: str, after: str | None, upto: str, prefix_len: int = 1) -> DataFrame:
    """(date, key prefix) slices newer than the last success, with their sizes."""
    rows = src.where(F.col(date_col) <= upto)
    if after is not None:
        rows = rows.where(F.col(date_col) > after)
    return rows.groupBy(date_col, F.substring(F.col(key_col).cast("string"), 1, prefix_len).alias("key_prefix")).agg(
        F.count(F.lit(1)).alias("rows"))
