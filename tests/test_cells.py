import pytest
from pyspark.sql import functions as F

from rollspan.plans import cells

D = "20240129"
USAGE = "msisdn string, lac string, cell_id string, originaltimestamp string, s3_file_date string, servicename string, duration double, volume double, totalcost double"
CALLS = "msisdn string, lac string, cell_id string, call_type string, call_duration double, s3_file_date string"


@pytest.fixture()
def cell_map(spark):
    # cell 1/1 belongs to two stations, station A has two cells
    return spark.createDataFrame([("1", "1", "A"), ("1", "1", "B"), ("1", "2", "A"), ("9", "9", None)], "lac string, cell_id string, bts_id string")


def usage(day, msisdn="m", cell="1", cost=1000.0, service="Voice", lac="1"):
    return (msisdn, lac, cell, f"{day}T10:00:00", day, service, 2.0, None, cost)


def test_usage_of_cells_with_several_stations(spark, cell_map):
    rows = [usage("20240128"), usage("20240128", cell="2"), usage("20240128"), usage("20240127", cell="2", cost=4000.0), usage("20240110", service="SMS"),
            usage("20240128", msisdn=None), usage("20240128", msisdn="u", cell="7"), usage("20240128", msisdn="u", lac="9", cell="9"), usage("20220128", msisdn="u")]
    wide = cells.bts_usage(spark.createDataFrame(rows, USAGE), cell_map, D)
    got = {(r.msisdn, r.bts_id): r for r in wide.collect()}
    assert set(got) == {("m", "A"), ("m", "B"), (None, "A"), (None, "B")}
    a, b = got["m", "A"], got["m", "B"]
    assert (a.bts_usage_count_l1w, a.bts_usage_count_l4w, b.bts_usage_count_l1w, b.bts_usage_count_l24w) == (4, 5, 2, 3)
    # two active days of A: three rows over two cells, then one
    assert (a.bts_usage_count_davg_l1w, a.bts_usage_total_cost_sum_davg_l1w, b.bts_usage_count_davg_l1w) == (2.0, 3.5, 2.0)
    assert (a.bts_usage_sms_count_l1w, a.bts_usage_sms_count_l4w, a.bts_usage_sms_count_davg_l1w) == (None, 1, None)
    assert "bts_usage_count_davg_l4w" not in wide.columns
    old = cells.bts_usage(spark.createDataFrame(rows, USAGE), cell_map, D, windows=(4, 12))
    assert {(r.msisdn, r.bts_id): (r.bts_usage_count_l4w, r.bts_usage_count_davg_l1w) for r in old.collect()}["m", "A"] == (5, 2.0)
    assert not any(c.endswith("_l24w") for c in old.columns)


def test_families_equal_those_of_joined_events(spark, cell_map):
    rows = [(f"m{i % 3}" if i % 7 else None, "1", str(1 + i % 3), ("MOC", "MTC", "SMO")[i % 3], float(i % 5), f"202401{1 + i % 28:02d}") for i in range(90)]
    calls = spark.createDataFrame(rows, CALLS)
    got = cells.cell_features(cells.BTS_VOICE, calls, cell_map, D)
    want = cells.BTS_VOICE.features(cells.at_cells(calls, cell_map), D)
    assert got.columns == want.columns
    key = lambda r: (str(r.msisdn), r.bts_id)
    assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)


def test_multiplied_rows_stay_in_place(spark, cell_map):
    calls = spark.createDataFrame([("m", "1", "1", "MOC", 1.0, "20240128")], CALLS)
    bts = cells.cell_features(cells.BTS_VOICE, calls, F.broadcast(cell_map), D)
    plan = cells.pn_voice(bts)._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("BroadcastHashJoin")
    assert "Exchange" not in above
    assert below.count("Exchange hashpartitioning") == 2
