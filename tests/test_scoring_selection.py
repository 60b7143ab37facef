import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rollspan.operators import scoring as sc, selection as se


def test_score_transform_handles_high_probabilities(spark):
    df = spark.createDataFrame([(i, i / 200) for i in range(1, 200)], "k int, p double")
    out = sc.credit_score(df, "p").orderBy("p").toPandas()
    assert out["credit_score"].max() == 850 and out["credit_score"].min() == 300
    assert out["credit_score"].is_monotonic_decreasing and out.loc[out["p"] > 0.5, "credit_score"].eq(300).all()


def test_score_scale_constant_population(spark):
    assert sc.score_scale(spark.range(3).selectExpr("1.0 AS v"), "v").first()["credit_score"] is None


def test_woe_right_open_and_missing(spark, as_rows):
    df = spark.createDataFrame([(1, None), (2, 5.0), (3, 10.0), (4, 50.0)], "k int, x double")
    bins = {"x": [(None, 10, -1.0), (10, 20, 2.0)]}
    assert [r["x"] for r in as_rows(sc.woe_transform(df, bins), "k")] == [0.0, -1.0, 2.0, 0.0]
    assert as_rows(sc.woe_transform(df, bins, "woe", {"x": 0.5}), "k")[0]["x"] == 0.5
    more = bins | {"gone": []}
    with pytest.raises(ValueError, match="gone"):
        sc.woe_transform(df, more)
    assert sc.woe_transform(df, more, absent="skip").columns == ["k", "x"]


def test_each_row_is_predicted_once(spark, tmp_path):
    log = str(tmp_path / "rows")

    def predict(frame):
        with open(log, "a") as f:
            f.write(f"{len(frame)}\n")
        return (frame["x"] / 200).to_numpy()

    df = spark.range(1, 120).select("id", F.col("id").cast("double").alias("x"))
    for score in (lambda s: sc.credit_score(s), lambda s: sc.propensity(s, key="id")):
        open(log, "w").close()
        assert score(sc.batch_score(df, predict, ["x"], key="id")).count() == 119
        assert sum(map(int, open(log).read().split())) == 119


def labelled(spark, n=400):
    rng = np.random.default_rng(5)
    x = rng.normal(size=n)
    pdf = pd.DataFrame({"k": range(n), "x": x, "x2": x * 2 + 1e-3 * rng.normal(size=n), "z": rng.normal(size=n), "y": (x + rng.normal(size=n) > 0).astype(int)})
    return spark.createDataFrame(pdf), pdf


def test_fitted_bins_score_like_their_table(spark):
    df, pdf = labelled(spark)
    bins = se.fit_bins(df, ["x"], "y", 4)
    table = bins.where("bin > 0").toPandas().sort_values("bin")
    assert table["events"].sum() == pdf["y"].sum() and len(table) == 4
    got = sc.woe_lookup(df.select("k", "x"), bins, ["x"]).toPandas().set_index("k")["x"]
    for r in pdf.itertuples():
        row = table[(table["lo"].isna() | (r.x > table["lo"])) & (table["hi"].isna() | (r.x <= table["hi"]))].iloc[0]
        assert got[r.k] == pytest.approx(row["woe"])


def brute_gini(y, s):
    pos, neg = [b for a, b in zip(y, s) if a], [b for a, b in zip(y, s) if not a]
    if not pos or not neg:
        return None
    auc = sum((p > n) + 0.5 * (p == n) for p, n in itertools.product(pos, neg)) / (len(pos) * len(neg))
    return 2 * auc - 1


def test_gini_per_group_with_ties_and_one_class(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"g": rng.choice(["hot", "hot", "hot", "b"], 300), "s": rng.integers(0, 6, 300).astype(float), "y": rng.integers(0, 2, 300)})
    pdf = pd.concat([pdf, pd.DataFrame({"g": ["one"] * 5, "s": [1.0] * 5, "y": [1] * 5})])
    got = {r["g"]: r["gini"] for r in se.gini(spark.createDataFrame(pdf), "y", "s", ["g"]).collect()}
    for g, part in pdf.groupby("g"):
        want = brute_gini(part["y"], part["s"])
        assert got[g] == (pytest.approx(want) if want is not None else None)


def test_correlation_filter_drops_weaker_copy(spark):
    df, _ = labelled(spark)
    iv = spark.createDataFrame([("x", 0.5), ("x2", 0.4), ("z", 0.01)], "feature string, iv double")
    kept = {r["feature"]: r["kept"] for r in se.correlation_filter(df, iv, ["x", "x2", "z"]).collect()}
    assert kept == {"x": True, "x2": False, "z": True}


def test_wide_correlations_match_pandas_pairwise(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame(rng.normal(size=(500, 20)) + 1e4, columns=[f"c{i}" for i in range(20)])
    pdf["c1"] = pdf["c0"] * 3 + rng.normal(size=500)
    pdf.loc[::7, "c2"] = np.nan
    df = spark.createDataFrame(pdf).replace(float("nan"), None).repartition(3)
    want = pdf.corr()
    got = se.correlation_long(df, list(pdf.columns)).collect()
    assert len(got) == 190
    for r in got:
        assert r["corr"] == pytest.approx(want.loc[r["f1"], r["f2"]], abs=1e-9)


def test_psi_zero_for_same_and_large_for_shifted(spark):
    df, _ = labelled(spark)
    assert se.psi(df, df, ["x"]).first()["psi"] == pytest.approx(0.0, abs=1e-9)
    moved = df.withColumn("x", F.col("x") + 3)
    row = se.psi(df, moved, ["x"]).first()
    assert row["psi"] > 1 and row["kept"] is False


@pytest.mark.parametrize("method", ["iqr", "zscore", "mad"])
def test_outliers_match_numpy(spark, method):
    v = np.concatenate([np.random.default_rng(1).normal(size=200), [30.0, -40.0]])
    df = spark.createDataFrame(pd.DataFrame({"v": v}))
    if method == "iqr":
        q1, q3 = np.quantile(v, [0.25, 0.75])
        keep = (v >= q1 - 1.5 * (q3 - q1)) & (v <= q3 + 1.5 * (q3 - q1))
    elif method == "zscore":
        keep = np.abs(v - v.mean()) / v.std() < 3
    else:
        med = np.median(v)
        keep = 0.6745 * np.abs(v - med) / np.median(np.abs(v - med)) <= 3
    got = sorted(r["v"] for r in se.outliers(df, "v", method).collect())
    assert got == pytest.approx(sorted(v[keep]))
    clipped = se.outliers(df, "v", method, mode="clip").agg(F.count("v"), F.max("v")).first()
    assert clipped[0] == len(v) and clipped[1] < 30.0


def test_mad_zero_keeps_everything(spark):
    df = spark.createDataFrame([(1.0,)] * 9 + [(50.0,)], "v double")
    assert se.outliers(df, "v", "mad").count() == 10


def test_degenerate_columns(spark):
    df = spark.range(100).selectExpr("cast(id AS double) AS a", "cast(id AS double) AS b", "cast(99 - id AS double) AS c", "1.0 AS one")
    got = {r["feature"]: r for r in se.degenerate_columns(df, ["a", "b", "c", "one"]).collect()}
    assert got["b"]["duplicate_of"] == "a" and got["c"]["duplicate_of"] is None
    assert got["one"]["quasi_constant"] and got["one"]["low_variance"] and not got["a"]["quasi_constant"]


def test_importance_and_mrmr_pick_the_signal(spark):
    df, _ = labelled(spark)
    top = se.select_important(se.importance(df, ["x", "z"], "y"), top_k=1).first()["feature"]
    assert top == "x"
    assert [r["feature"] for r in se.mrmr(df, ["x", "x2", "z"], "y", 2).orderBy("rank").collect()][1] == "z"


def test_time_split_is_stable_and_folds_expand(spark):
    df = spark.range(1000).selectExpr("id", "id % 10 AS d")
    a = se.time_split(df, "d", 8, "id")
    b = se.time_split(df.repartition(7), "d", 8, "id")
    assert a.exceptAll(b).count() == 0
    shares = {r["split"]: r["count"] for r in a.groupBy("split").count().collect()}
    assert shares["test"] == 200 and 0.7 < shares["train"] / 800 < 0.9
    folds = {(r["fold"], r["part"]): r["count"] for r in se.time_folds(df, "d", 4).groupBy("fold", "part").count().collect()}
    assert [folds[(k, "train")] for k in (1, 2, 3, 4)] == [200, 400, 600, 800] and all(folds[(k, "test")] == 200 for k in (1, 2, 3, 4))


def test_stacked_score_bounds(spark):
    df = spark.range(200).selectExpr("cast(id AS string) AS msisdn", "cast(id AS double) AS a", "cast(null AS double) AS b")
    out = sc.stacked_score(df, {"m1": ({"a": 0.01}, 0.0), "m2": ({"b": 1.0}, 0.0)}, ({"m1": 1e-4, "m2": 1e-4}, 0.0), bounds={"m1": {"a": (10, 100)}}).toPandas()
    assert out["m2"].eq(5000).all() and out["m1"].nunique() == 91 and set(out["lg_perct"]) == set(range(1, 101))


def test_correlations_do_not_depend_on_the_number_of_features(spark):
    from rollspan.operators.selection import correlation_long
    cols = [f"c{i}" for i in range(16)]
    rows = [tuple(float((r * (i + 3)) % 7) for i in range(16)) for r in range(30)] + [(float("nan"), *[1.0] * 15)]
    df = spark.createDataFrame(rows, cols)
    few, many = ({(r.f1, r.f2): r.corr for r in correlation_long(df, cols[:n]).collect()} for n in (15, 16))
    assert all(abs(v - many[k]) < 1e-12 if v is not None else many[k] is None for k, v in few.items())
    assert few["c0", "c1"] is not None and few["c0", "c1"] == few["c0", "c1"]


def test_bin_edges_are_exact_on_many_distinct_values(spark):
    df = spark.range(3_000_000).select((F.col("id") * 1_000_003 % 3_000_000).cast("double").alias("x"), F.lit(None).cast("double").alias("none"))
    got = {r.feature: r.edges for r in se.quantile_edges(df, ["x", "none"], 5).collect()}
    assert got["x"] == [599_999.0, 1_199_999.0, 1_799_999.0, 2_399_999.0] and not got["none"]
