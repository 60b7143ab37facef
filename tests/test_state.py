"""Stored newest records against the whole history."""

import re
import uuid

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from rollspan.operators.state import NewestState
from rollspan.operators.windows import latest_per_key
from rollspan.session import shared_folder

SCHEMA = "k int, at int, v string, day string"
DAYS = [f"202401{d:02d}" for d in range(1, 10)]
row = st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.sampled_from("xyz")), st.sampled_from(DAYS))


def state(spark):
    return NewestState(spark, f"{shared_folder(spark)}/state-{uuid.uuid4().hex}", ["k"], ["day", "at"], "day")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@settings(max_examples=6, deadline=None)
@given(history=st.lists(row, min_size=1, max_size=30), steps=st.lists(st.sampled_from(DAYS), min_size=1, max_size=4))
def test_any_steps_give_what_the_history_gives(spark, history, steps):
    """Steps in any order and repeated; every stored state equals the newest records before its date."""
    df, s = spark.createDataFrame(history, SCHEMA), state(spark)
    for upto in steps:
        s.advance(df, upto)
    assert s.dates() == sorted(set(steps))
    for upto in set(steps):
        assert rows(s.read(upto)) == rows(latest_per_key(df.where(F.col("day") < upto), ["k"], ["day", "at"]))


def test_history_is_not_scanned_and_a_broken_state_does_not_count(spark):
    path = f"{shared_folder(spark)}/source-{uuid.uuid4().hex}"
    spark.createDataFrame([(i % 7, i, "x", d) for i, d in enumerate(DAYS * 5)], SCHEMA).write.partitionBy("day").parquet(path)
    source = spark.read.schema(SCHEMA).parquet(path)
    s = state(spark)
    s.advance(source, "20240106")
    step = s.step(source, "20240108")
    read = [f for f in step.inputFiles() if "/day=" in f]
    plan = step._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*day#\d+ >= 20240106", plan) and read
    # what a lost job left behind: files without the mark of a complete state
    spark.createDataFrame([(1, 1, "broken", "20240106")], SCHEMA).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{s.path}/asof=20240107")
    assert s.dates() == ["20240106"] and s.base("20240108") == "20240106"
    assert rows(s.advance(source, "20240108")) == rows(latest_per_key(source.where("day < '20240108'"), ["k"], ["day", "at"]))


def test_late_rows_are_seen_from_an_older_state(spark):
    s = state(spark)
    early = spark.createDataFrame([(1, 1, "a", DAYS[0])], SCHEMA)
    s.advance(early, DAYS[2])
    s.advance(early, DAYS[4])
    late = early.union(spark.createDataFrame([(1, 2, "late", DAYS[2])], SCHEMA))
    assert s.advance(late, DAYS[5]).first().v == "a"
    assert s.advance(late, DAYS[5], since=DAYS[2]).first().v == "late"
