"""Guarded merges on a spine, from frames and from tables stored by key."""

import uuid

import pytest

from rollspan.operators import joins as jo
from rollspan.plans import merge
from rollspan.session import shared_folder
from rollspan.sources.tables import store_by_key

IDS = [f"0084{i:09d}" for i in range(40)]


def tables(spark):
    return {name: spark.createDataFrame([(k, i * step, f"{name}{i}") for i, k in enumerate(IDS) if i % step == 0] + [(None, 1, "x")],
                                        f"msisdn string, {name}_n int, {name}_item string") for name, step in (("a", 2), ("b", 3), ("c", 5))}


FEATURES = {n: {"num": [f"{n}_n"], "cat": [f"{n}_item"]} for n in "abc"}


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum("Exchange" in line for line in plan.splitlines())


def test_merge_equals_the_chain_of_outer_joins_and_counts_itself(spark):
    t = tables(spark)
    merged = jo.guarded_outer_merge(t, ["msisdn"])
    want = jo.outer_merge([x.dropna(subset=["msisdn"]) for x in t.values()], ["msisdn"])
    assert sorted(map(tuple, merged.frame.collect())) == sorted(map(tuple, want.select(*merged.frame.columns).collect()), key=lambda r: r[0])
    keys = {i for i in range(40) if i % 2 == 0 or i % 3 == 0 or i % 5 == 0}
    assert [tuple(r) for r in merged.report().collect()] == [
        (i + 1, n, len(keys), len(range(0, 40, s)), True) for i, (n, s) in enumerate((("a", 2), ("b", 3), ("c", 5)))]
    merged.check()


@pytest.mark.parametrize("where", ["a", "c"])
def test_a_repeated_key_is_caught_where_it_comes_from(spark, where):
    t = tables(spark)
    t[where] = t[where].union(t[where].limit(1))
    merged = jo.guarded_outer_merge(t, ["msisdn"])
    merged.frame.write.format("noop").mode("overwrite").save()
    with pytest.raises(jo.MergeGuard, match=f"'{where}'"):
        merged.check()
    assert [r.ok for r in merged.report().collect()] == ([False] * 3 if where == "a" else [True, True, False])


def test_columns_of_two_tables_are_refused(spark):
    t = tables(spark)
    with pytest.raises(jo.MergeGuard):
        jo.guarded_outer_merge({"a": t["a"], "again": t["a"]}, ["msisdn"])


def test_filled_table_with_composite_keys_and_empty_tables(spark):
    t = tables(spark)
    filled = merge.filled_merge(t | {"b": t["b"].limit(0)}, FEATURES).frame.collect()
    assert len(filled) == 24 and all(r.b_n == 0 and r.b_item == "null" for r in filled)
    keyed = {n: x.withColumnRenamed(f"{n}_item", "cell") .replace({f"{n}{i}": f"cell{i}" for i in range(40)}, subset=["cell"]) for n, x in t.items()}
    both = jo.guarded_outer_merge(keyed, ["msisdn", "cell"])
    assert both.frame.count() == 30 and both.report().where("not ok").count() == 0


@pytest.mark.parametrize("broadcast", ["-1", "10485760"])
def test_stored_snapshots_merge_without_a_shuffle(spark, broadcast):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        t = tables(spark)
        run = uuid.uuid4().hex
        stored = merge.store_features(t, FEATURES, f"{shared_folder(spark)}/{run}", f"t{run}", 4)
        ids = store_by_key(jo.spine(list(stored.values()), "msisdn"), f"t{run}_ids", f"{shared_folder(spark)}/{run}/ids", ["msisdn"], 4)
        want = sorted(map(tuple, merge.model_table(t, FEATURES).frame.collect()))
        for spine in (None, ids):
            merged = merge.model_table(stored, FEATURES, only_valid=False, ids=spine)
            if broadcast == "-1":
                assert exchanges(merged.frame) == (1 if spine is None else 0)  # the distinct keys
            assert sorted(map(tuple, merged.frame.collect())) == want
            merged.check()
        # left joins don't move the growing table: two exchanges for each table, its keys and its rows, and one of all keys at most
        if broadcast == "-1":
            assert exchanges(merge.model_table(t, FEATURES).frame) <= 2 * len(t) + 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
