"""Windows from ring arrays against conditional aggregates, with gaps, NULLs and keys that miss rings."""

import random

from pyspark.sql import functions as F

from rollspan.operators import rollups as ru
from rollspan.operators.aggregates import Measure
from rollspan.plans.weekly import USAGE

MEASURES = [Measure("n", "rows"), Measure("a b", "sum", "v"), Measure("lo", "min", "v"), Measure("hi", "max", "v"), Measure("hits", "hits", None, "v > 5")]


def test_rings_give_the_windows_of_conditional_aggregates(spark):
    r = random.Random(4)
    rows = [(r.choice(["x", "y", None]), r.randrange(3), r.choice([None, r.randrange(10) / 4]), f"2024{r.randrange(1, 7):02d}{r.randrange(1, 29):02d}") for _ in range(300)]
    rows += [("only_old", 0, 1.0, "20240215"), ("out", 0, 1.0, "20230101"), ("nulls", 1, None, "20240620")]
    df = spark.createDataFrame(rows, "k string, j int, v double, day string")
    keys, snapshot = ["k", "j"], "20240701"
    for windows in ((1, 4, 12, 24), (2, 8), (4,)):
        weeks = ru.weekly(df, keys, "day", snapshot, MEASURES, max(windows))
        rings = ru.weekly(df, keys, "day", snapshot, MEASURES, max(windows), bands=windows)
        assert rings.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > len(windows)).count() == 0
        want, got = ru.widen(weeks, keys, MEASURES, windows), ru.widen_rings(rings, keys, MEASURES, windows)
        assert sorted(want.columns) == sorted(got.columns)
        cols = [F.round(f"`{c}`", 9) if c not in keys else F.col(c) for c in want.columns]
        assert sorted(map(str, want.select(*cols).collect())) == sorted(map(str, got.select(*cols).collect()))


def test_a_family_plans_few_aggregate_functions(spark):
    """The step to windows gathers arrays; there is no conditional aggregate per measure and window."""
    raw = spark.createDataFrame([("0084000000001", "20240620T10:00:00", 1.0, 1.0, 1.0, "SMS", "20240620")],
                                "msisdn string, originaltimestamp string, duration double, volume double, totalcost double, servicename string, s3_file_date string")
    plan = USAGE.features(raw, "20240701")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" in plan and "week_back" in plan
    out = USAGE.features(raw, "20240701").first()
    assert out["usage_count_l4w"] == 1 and out["usage_count_l1w"] is None
