"""Bins, drift, redundancy, outliers, ranking quality, splits and feature choice."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollspan.catalog.registry import R, query, role_sql
from rollspan.operators import selection as se, validation as va

FEATURES = ["n_chars", "n_text", "noise", "gappy"]
_L = role_sql("labelled")


def edges_sql(feature: str, n: int, rows: str) -> str:
    """Distinct inner quantile edges (smallest value with enough rows at or below it)."""
    ps = ", ".join(str(i / n) for i in range(1, n))
    return f"(SELECT list_sort(list_distinct(quantile_disc({feature}, [{ps}]))) FROM ({rows}) WHERE {feature} IS NOT NULL)"


def bins_sql(n: int, rows: str = _L, edges_from: str | None = None, keep: str = "y") -> str:
    return " UNION ALL ".join(
        f"SELECT '{f}' AS feature, {f} AS v, {keep}, CASE WHEN {f} IS NULL THEN 0 ELSE 1 + len(list_filter({edges_sql(f, n, edges_from or rows)}, lambda e: e < {f})) END AS bin FROM ({rows})"
        for f in FEATURES)


def iv_sql(n: int = 5) -> str:
    return f"""WITH c AS (SELECT feature, bin, sum(y) AS ev, count(*) - sum(y) AS ne FROM ({bins_sql(n)}) GROUP BY 1, 2),
    s AS (SELECT *, CASE WHEN ev = 0 THEN 0.5 ELSE ev END / sum(ev) OVER (PARTITION BY feature) AS e, CASE WHEN ne = 0 THEN 0.5 ELSE ne END / sum(ne) OVER (PARTITION BY feature) AS g FROM c)
    SELECT feature, sum((g - e) * ln(g / e)) AS iv FROM s GROUP BY 1"""


@query("iv_table", f"SELECT feature, {R('iv', 'iv')}, iv >= 0.02 AS kept FROM ({iv_sql()})")
def _(t):
    return se.iv_table(se.fit_bins(t.labelled, FEATURES, "y", 5), 0.02)


@query("time_split", """SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN 'test' ELSE 'dev' END AS part FROM orders""")
def _(t):
    split = se.time_split(t.orders, "o_orderdate", F.lit("2000-01-01").cast("timestamp_ntz"), "o_orderkey")
    return split.select("o_orderkey", F.when(F.col("split") == "test", "test").otherwise("dev").alias("part"))


@query("time_split_parts", """SELECT o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN 'test'
    WHEN CAST('0x' || left(md5(CAST(o_orderkey AS VARCHAR)), 8) AS BIGINT) % 100 < 80 THEN 'train' ELSE 'val' END AS part FROM orders""")
def _(t):
    split = se.time_split(t.orders, "o_orderdate", F.lit("2000-01-01").cast("timestamp_ntz"), "o_orderkey")
    return split.select("o_orderkey", F.col("split").alias("part"))


CORR = " UNION ALL ".join(f"SELECT '{a}' AS f1, '{b}' AS f2, corr({a}, {b}) AS c FROM ({_L})" for i, a in enumerate(FEATURES) for b in FEATURES[i + 1:])


@query("correlation_filter", f"""WITH iv AS ({iv_sql()}), p AS (SELECT * FROM ({CORR}) WHERE abs(c) > 0.85),
    l AS (SELECT CASE WHEN a.iv < b.iv THEN f1 ELSE f2 END AS feature FROM p JOIN iv a ON a.feature = f1 JOIN iv b ON b.feature = f2 WHERE a.iv <> b.iv)
    SELECT feature, {R('iv', 'iv')}, feature NOT IN (SELECT feature FROM l) AS kept FROM iv""")
def _(t):
    rows = t.labelled
    return se.correlation_filter(rows, se.iv_table(se.fit_bins(rows, FEATURES, "y", 5)), FEATURES)


def _psi_sql():
    ref, cur = f"SELECT * FROM ({_L}) WHERE lang = 'en'", f"SELECT * FROM ({_L}) WHERE lang <> 'en'"
    a, b = bins_sql(5, ref), bins_sql(5, cur, ref)
    return f"""WITH a AS (SELECT feature, bin, count(*) AS n FROM ({a}) WHERE bin > 0 GROUP BY 1, 2), b AS (SELECT feature, bin, count(*) AS n FROM ({b}) WHERE bin > 0 GROUP BY 1, 2),
    j AS (SELECT feature, bin, coalesce(a.n, 0) AS x, coalesce(b.n, 0) AS y FROM a FULL OUTER JOIN b USING (feature, bin)),
    s AS (SELECT feature, x / sum(x) OVER (PARTITION BY feature) + 1e-6 AS p, y / sum(y) OVER (PARTITION BY feature) + 1e-6 AS q FROM j)
    SELECT feature, {R('sum((p - q) * ln(p / q))', 'psi')}, sum((p - q) * ln(p / q)) <= 0.2 AS kept FROM s GROUP BY 1"""


@query("psi_drift", _psi_sql)
def _(t):
    rows = t.labelled
    return se.psi(rows.where("lang = 'en'"), rows.where("lang <> 'en'"), FEATURES, 5)


_DEG = ["l_quantity", "qty_copy", "one", "l_tax"]
_DEG_ROWS = "SELECT l_quantity, l_quantity AS qty_copy, CAST(1 AS DOUBLE) AS one, l_tax FROM lineitem"


@query("degenerate_columns", " UNION ALL ".join(f"""SELECT '{c}' AS feature, {R('CASE WHEN max(n) / sum(n) > 0.5 THEN max(n) / sum(n) END', 'majority_share')}, (SELECT {R(f'var_samp({c})', 'variance')} FROM ({_DEG_ROWS})) AS variance,
    {"'l_quantity'" if c == 'qty_copy' else 'NULL::VARCHAR'} AS duplicate_of, max(n) / sum(n) >= 0.98 AS quasi_constant, (SELECT var_samp({c}) FROM ({_DEG_ROWS})) < 0.01 AS low_variance
    FROM (SELECT {c}, count(*) AS n FROM ({_DEG_ROWS}) GROUP BY 1)""" for c in _DEG))
def _(t):
    rows = t.lineitem.select("l_quantity", F.col("l_quantity").alias("qty_copy"), F.lit(1.0).alias("one"), "l_tax")
    return se.degenerate_columns(rows, _DEG)


_V = "SELECT o_orderkey, CASE WHEN o_orderkey % 100 = 0 THEN o_totalprice * 5 ELSE o_totalprice END AS v FROM orders"


def spiky(t):
    v = F.col("o_totalprice")
    return t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 100 == 0, v * 5).otherwise(v).alias("v"))


@query("outlier_iqr", f"""WITH r AS ({_V}), b AS (SELECT quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.75) AS q3 FROM r)
    SELECT o_orderkey, {R('v', 'v')}, 'drop' AS mode FROM r, b WHERE v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)
    UNION ALL SELECT o_orderkey, {R('greatest(q1 - 1.5 * (q3 - q1), least(q3 + 1.5 * (q3 - q1), v))', 'v')}, 'clip' FROM r, b""")
def _(t):
    a = se.outliers(spiky(t), "v", "iqr").withColumn("mode", F.lit("drop"))
    return a.unionByName(se.outliers(spiky(t), "v", "iqr", mode="clip").withColumn("mode", F.lit("clip")))


@query("outlier_zscore", f"""WITH r AS ({_V}), b AS (SELECT avg(v) AS m, stddev_pop(v) AS s, stddev_samp(v) AS s2 FROM r)
    SELECT o_orderkey, {R('v', 'v')}, 'drop' AS mode FROM r, b WHERE abs(v - m) / s < 3 UNION ALL SELECT o_orderkey, {R('greatest(m - 3 * s2, least(m + 3 * s2, v))', 'v')}, 'clip' FROM r, b""")
def _(t):
    a = se.outliers(spiky(t), "v", "zscore").withColumn("mode", F.lit("drop"))
    return a.unionByName(se.outliers(spiky(t), "v", "zscore", mode="clip").withColumn("mode", F.lit("clip")))


@query("outlier_mad", f"""WITH r AS ({_V}), m AS (SELECT median(v) AS med FROM r), d AS (SELECT median(abs(v - med)) AS mad FROM r, m)
    SELECT o_orderkey, {R('v', 'v')} FROM r, m, d WHERE 0.6745 * abs(v - med) / mad <= 3""")
def _(t):
    return se.outliers(spiky(t), "v", "mad")


def gini_sql(by: str, rows: str = "r", shown=R) -> str:
    g = f"{by}, " if by else ""
    p = f"PARTITION BY {by}" if by else ""
    return f"""SELECT {g}CAST(p AS BIGINT) AS positives, CAST(n AS BIGINT) AS negatives, {shown('2 * (s - p * (p + 1) / 2) / nullif(p * n, 0) - 1', 'gini')} FROM (
      SELECT {g}sum(y) AS p, count(*) - sum(y) AS n, sum(CASE WHEN y = 1 THEN rk ELSE 0 END) AS s FROM (
        SELECT *, rank() OVER ({p} ORDER BY x) + (count(*) OVER ({p}{', ' if by else 'PARTITION BY '}x) - 1) / 2 AS rk FROM {rows}) {f'GROUP BY {by}' if by else ''})"""


@query("gini", f"WITH r AS (SELECT y, n_chars % 50 AS x FROM ({_L})) {gini_sql('')}")
def _(t):
    return se.gini(t.labelled.withColumn("x", F.col("n_chars") % 50), "y", "x")


_SEG = "SELECT strftime(date_trunc('month', o_orderdate), '%Y%m%d') AS period, o_orderpriority AS segment, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y, round(o_totalprice / 20000) AS x FROM orders"


@query("gini_by_segment_period", f"WITH r AS ({_SEG}) {gini_sql('period, segment')}")
def _(t):
    rows = t.orders.select(
        F.date_format(F.trunc("o_orderdate", "month"), "yyyyMMdd").alias("period"), F.col("o_orderpriority").alias("segment"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("y"), F.round(F.col("o_totalprice") / 20000).alias("x"))
    return se.gini(rows, "y", "x", ["period", "segment"])


@query("time_series_folds", """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1),
    c AS (SELECT d, least(CAST(floor((sum(n) OVER (ORDER BY d) - n / 2) * 4 / (SELECT sum(n) FROM d)) AS INT), 3) AS b FROM d),
    f AS (SELECT c.*, k AS fold FROM c, (VALUES (1), (2), (3)) t(k) WHERE k >= greatest(b, 1))
    SELECT CAST(fold AS INT) AS fold, CASE WHEN b = fold THEN 'test' ELSE 'train' END AS part, count(*) AS n FROM f JOIN orders ON CAST(o_orderdate AS DATE) = f.d GROUP BY 1, 2""")
def _(t):
    rows = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    return se.time_folds(rows, "d", 3).groupBy("fold", "part").agg(F.count("*").alias("n"))


_FOLD_ROWS = """SELECT CAST(o_orderdate AS DATE) AS d, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y, o_totalprice / 100000 AS a,
    CAST(CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey % 17 END AS DOUBLE) AS b FROM orders"""
#: weights of least squares with two features, from variances and covariances
_FOLD_SQL = f"""WITH r AS (SELECT d, y, a, coalesce(b, 0) AS b FROM ({_FOLD_ROWS})),
    n AS (SELECT d, count(*) AS n FROM r GROUP BY 1),
    c AS (SELECT d, least(CAST(floor((sum(n) OVER (ORDER BY d) - n / 2) * 4 / (SELECT sum(n) FROM n)) AS INT), 3) AS block FROM n),
    f AS (SELECT CAST(k AS INT) AS fold, CASE WHEN block = k THEN 'test' ELSE 'train' END AS part, r.* FROM c JOIN r USING (d), (VALUES (1), (2), (3)) t(k) WHERE k >= block),
    s AS (SELECT fold, avg(y) AS my, avg(a) AS ma, avg(b) AS mb, var_pop(a) AS aa, var_pop(b) AS bb, covar_pop(a, b) AS ab, covar_pop(a, y) AS ay, covar_pop(b, y) AS yb FROM f WHERE part = 'train' GROUP BY 1),
    w AS (SELECT *, (ay * bb - yb * ab) / (aa * bb - ab * ab) AS wa, (yb * aa - ay * ab) / (aa * bb - ab * ab) AS wb FROM s),
    p AS (SELECT fold, part, y, round(my - wa * ma - wb * mb + wa * a + wb * b, 9) AS x FROM f JOIN w USING (fold)),
    g AS ({{gini}})
    SELECT fold, max(n) FILTER (part = 'train') AS train_rows, max(n) FILTER (part = 'test') AS test_rows, {R("max(gini) FILTER (part = 'train')", 'train_gini')}, {R("max(gini) FILTER (part = 'test')", 'test_gini')},
      {R('any_value(my - wa * ma - wb * mb)', 'intercept')}, {R('any_value(wa)', 'weight_a')}, {R('any_value(wb)', 'weight_b')}
    FROM (SELECT fold, part, positives + negatives AS n, gini FROM g) JOIN w USING (fold) GROUP BY fold"""


@query("time_series_validation", lambda: _FOLD_SQL.format(gini=gini_sql("fold, part", "p", "{} AS {}".format)))
def _(t):
    rows = t.orders.select(F.to_date("o_orderdate").alias("d"), F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("y"),
                           (F.col("o_totalprice") / 100000).alias("a"), F.when(F.col("o_orderkey") % 11 != 0, F.col("o_custkey") % 17).alias("b"))
    fitted = va.validate(rows, "d", ["a", "b"], "y", 3, digits=9)
    weights = [F.col("coefficients")[i].alias(n) for i, n in enumerate(["intercept", "weight_a", "weight_b"])]
    return fitted.select("fold", "train_rows", "test_rows", "train_gini", "test_gini", *weights)


@query("importance_selection")
def _(t):
    return se.select_important(se.importance(t.labelled, FEATURES, "toxic"), top_k=3)


@query("importance_cuts", f"""WITH iv AS ({iv_sql()}), r AS (SELECT *, sum(iv) OVER (ORDER BY iv DESC, feature) AS upto FROM iv)
    SELECT 'top 2' AS cut, feature, {R('iv', 'importance')} FROM (SELECT * FROM iv ORDER BY iv DESC, feature LIMIT 2)
    UNION ALL SELECT 'floor', feature, {R('iv', 'importance')} FROM iv WHERE iv >= 0.05 UNION ALL SELECT 'sum', feature, {R('iv', 'importance')} FROM r WHERE upto <= 3""")
def _(t):
    """The three cuts over an importance with a closed form, the information value."""
    table = se.iv_table(se.fit_bins(t.labelled, FEATURES, "y", 5)).withColumnRenamed("iv", "importance")
    cuts = {"top 2": {"top_k": 2}, "floor": {"threshold": 0.05}, "sum": {"accumulate": 3}}
    parts = [se.select_important(table, **how).select(F.lit(name).alias("cut"), "feature", "importance") for name, how in cuts.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _mrmr_sql():
    """Three greedy steps over relevance ``r`` and the correlations of the features."""
    rel = " UNION ALL ".join(f"SELECT '{f}' AS f, {i} AS i, abs(corr({f}, y)) AS r FROM ({_L})" for i, f in enumerate(FEATURES))
    pairs = " UNION ALL ".join(f"SELECT '{a}' AS f, '{b}' AS g, abs(corr({a}, {b})) AS c FROM ({_L})" for a in FEATURES for b in FEATURES if a != b)
    return f"""WITH rel AS ({rel}), pairs AS ({pairs}),
    s1 AS (SELECT f, r AS score FROM rel ORDER BY score DESC, i LIMIT 1),
    s2 AS (SELECT f, r / greatest((SELECT c FROM pairs p WHERE p.f = rel.f AND g IN (SELECT f FROM s1)), 1e-9) AS score FROM rel WHERE f NOT IN (SELECT f FROM s1) ORDER BY score DESC, i LIMIT 1),
    s3 AS (SELECT f, r / greatest((SELECT avg(c) FROM pairs p WHERE p.f = rel.f AND (g IN (SELECT f FROM s1) OR g IN (SELECT f FROM s2))), 1e-9) AS score FROM rel
      WHERE f NOT IN (SELECT f FROM s1) AND f NOT IN (SELECT f FROM s2) ORDER BY score DESC, i LIMIT 1)
    SELECT CAST(rank AS INT) AS rank, f AS feature, {R('score', 'score')} FROM (SELECT 1 AS rank, * FROM s1 UNION ALL SELECT 2, * FROM s2 UNION ALL SELECT 3, * FROM s3)"""


@query("mrmr_selection", _mrmr_sql)
def _(t):
    return se.mrmr(t.labelled, FEATURES, "y", 3)
