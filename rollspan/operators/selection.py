"""Bin fitting, drift, redundancy, outliers and ranking quality over labelled frames.

Bin edges and quartiles are exact order statistics found by bracketing, so no values are sorted or shuffled; rankings of
scores go through :func:`global_prefix`.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from rollspan.functions.numeric import ratio
from rollspan.operators.fill import q
from rollspan.operators.order_statistics import below, equal_frequency_edges, number, spread
from rollspan.operators.windows import exact_percentiles, global_prefix
from rollspan.session import with_scalars

ACCURACY = 100_000


def doubles(features: Sequence[str]) -> list[Column]:
    return [F.col(q(f)).cast("double") for f in features]


def _edges(df: DataFrame, features: Sequence[str], n: int, exact: bool = True) -> dict[str, list[float]]:
    if exact:
        return dict(zip(features, equal_frequency_edges(df, doubles(features), n)))
    ps = [i / n for i in range(1, n)]
    sketches = spread(df, doubles(features)).groupBy("i").agg(F.array_distinct(F.percentile_approx("x", ps, ACCURACY)).alias("edges")).collect()
    found = {r.i: list(r.edges) for r in sketches}
    return {f: found.get(i, []) for i, f in enumerate(features)}


def quantile_edges(df: DataFrame, features: Sequence[str], n: int, exact: bool = True) -> DataFrame:
    """``feature, edges``: distinct inner edges of ``n`` equal-frequency bins, each the smallest
    value with its share of the non-NULL rows at or below it.

    Exact edges come from :func:`order_statistics`. ``exact=False`` takes them from a quantile sketch per feature
    in one pass (edges can be off once a feature has more distinct values than ``ACCURACY``). Both are actions.
    """
    edges = _edges(df, features, n, exact)
    return df.sparkSession.createDataFrame([(f, edges[f]) for f in features], "feature string, edges array<double>")


def _cells(df: DataFrame, edges: dict[str, list[float]], aggregates: Sequence[Column], keep: Sequence[str] = ()) -> DataFrame:
    """``feature, bin`` and ``aggregates`` of the rows in each bin: 0 for NULL, else 1 + edges below the value (right-closed).

    Values are binned column by column; what is spread over features and combined in the tasks are bin numbers.
    """
    pairs = []
    for f, cuts in edges.items():
        x = f"CAST({q(f)} AS DOUBLE)"
        pairs.append(F.struct(F.lit(f).alias("feature"), F.expr(f"CASE WHEN {x} IS NULL THEN 0 ELSE {below(x, cuts, 1)} END").alias("bin")))
    rows = df.select(*keep, F.explode(F.array(*pairs)).alias("_p")).select(*keep, "_p.feature", "_p.bin")
    return rows.groupBy("feature", "bin").agg(*aggregates)


def _edge(edges: dict[str, list[float]], below: int) -> Column:
    """Edge under (``below`` 2) or over (``below`` 1) a bin, NULL where it has none. Features x bins values."""
    cases = " ".join(f"WHEN feature = '{f.replace(chr(39), chr(39) * 2)}' THEN try_element_at(array({', '.join(map(number, cuts))}), nullif(greatest(bin + 1 - {below}, 0), 0))"
                     for f, cuts in edges.items() if cuts)
    return F.expr(f"CASE {cases} END") if cases else F.lit(None).cast("double")


def fit_bins(df: DataFrame, features: Sequence[str], label: str, n: int = 10, eps: float = 0.5,
             exact: bool = True) -> DataFrame:
    """``feature, bin, lo, hi, events, non_events, woe, iv`` of equal-frequency bins.

    WoE is ln(share of non-events / share of events); empty cells count as ``eps``. ``exact`` is that of :func:`quantile_edges`.
    """
    edges = _edges(df, features, n, exact)
    cells = _cells(df, edges, [F.sum(F.col(q(label)).cast("long")).alias("events"), F.count(F.col(q(label))).alias("_n")], [label])
    cells = cells.withColumn("non_events", F.col("_n") - F.col("events"))
    w = Window.partitionBy("feature")  # features x bins rows
    e = F.when(F.col("events") == 0, eps).otherwise(F.col("events").cast("double")) / F.sum("events").over(w)
    g = F.when(F.col("non_events") == 0, eps).otherwise(F.col("non_events").cast("double")) / F.sum("non_events").over(w)
    woe = F.ln(g / e)
    return cells.select(
        "feature", "bin",
        F.when(F.col("bin") > 0, _edge(edges, 2)).alias("lo"), F.when(F.col("bin") > 0, _edge(edges, 1)).alias("hi"),
        "events", "non_events", woe.alias("woe"), ((g - e) * woe).alias("iv"))


def iv_table(bins: DataFrame, threshold: float | None = None) -> DataFrame:
    """Information value per feature; with a threshold also whether the feature stays."""
    out = bins.groupBy("feature").agg(F.sum("iv").alias("iv"))
    return out if threshold is None else out.withColumn("kept", F.col("iv") >= threshold)


def correlation_long(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``f1, f2, corr`` for every unordered pair of features, for any number of them.

    Arrow batches are turned into co-moment matrices inside the tasks (a few matrix products
    per batch, summed per partition), and the cells are added up by Spark. Values are
    centred on the feature mean first so that the sums keep their digits; pairs with a NULL or
    NaN are left out pair by pair.
    """
    names = list(features)
    values = df.select(*[F.nanvl(F.col(q(f)).cast("double"), F.lit(None)).alias(f"x{i}") for i, f in enumerate(names)])
    means = values.agg(*[F.avg(f"x{i}").alias(f"m{i}") for i in range(len(names))])
    centred = with_scalars(values, means)
    centred = centred.select(*[(F.col(f"x{i}") - F.col(f"m{i}")).alias(f"x{i}") for i in range(len(names))])

    def partial(batches):
        acc = None
        for pdf in batches:
            x = pdf.to_numpy(dtype="float64")
            seen = (~np.isnan(x)).astype("float64")
            x = np.nan_to_num(x)
            part = np.stack([seen.T @ seen, x.T @ seen, seen.T @ x, (x * x).T @ seen, seen.T @ (x * x), x.T @ x])
            acc = part if acc is None else acc + part
        if acc is not None:
            i, j = np.triu_indices(len(names), 1)
            yield pd.DataFrame({"i": i, "j": j, **{c: acc[k, i, j] for k, c in enumerate(("n", "sx", "sy", "sxx", "syy", "sxy"))}})

    cells = centred.mapInPandas(partial, "i long, j long, n double, sx double, sy double, sxx double, syy double, sxy double")
    s = cells.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    cov = F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")
    dev = F.sqrt(F.greatest(F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx"), F.lit(0.0))) * F.sqrt(
        F.greatest(F.col("n") * F.col("syy") - F.col("sy") * F.col("sy"), F.lit(0.0)))
    label = F.array(*map(F.lit, names))
    return s.select(label[F.col("i")].alias("f1"), label[F.col("j")].alias("f2"), F.try_divide(cov, dev).alias("corr"))


def correlation_filter(df: DataFrame, iv: DataFrame, features: Sequence[str], threshold: float = 0.85) -> DataFrame:
    """``feature, kept``: of each pair above the threshold the feature with less
    information value goes (equal values: both stay)."""
    pairs = correlation_long(df, features).where(F.abs("corr") > threshold)
    scored = (pairs.join(iv.select(F.col("feature").alias("f1"), F.col("iv").alias("iv1")), "f1")
              .join(iv.select(F.col("feature").alias("f2"), F.col("iv").alias("iv2")), "f2"))
    # identical columns differ by summation order only
    losers = scored.where(F.abs(F.col("iv1") - F.col("iv2")) > 1e-12).select(
        F.when(F.col("iv1") < F.col("iv2"), F.col("f1")).otherwise(F.col("f2")).alias("feature")).distinct()
    all_features = iv.where(F.col("feature").isin(list(features))).select("feature", "iv")
    return all_features.join(losers.withColumn("_lost", F.lit(True)), "feature", "left").select(
        "feature", "iv", F.col("_lost").isNull().alias("kept"))


def psi(ref: DataFrame, cur: DataFrame, features: Sequence[str], bins: int = 10, eps: float = 1e-6,
        threshold: float = 0.2, exact: bool = True) -> DataFrame:
    """Population stability index per feature over reference quantile bins.

    Shares are over the non-NULL rows of each side and smoothed by ``eps``. ``exact`` is that of :func:`quantile_edges`.
    """
    edges = _edges(ref, features, bins, exact)

    def counted(df, name):
        return _cells(df, edges, [F.count(F.lit(1)).alias(name)]).where(F.col("bin") > 0)
    cells = counted(ref, "ref_n").join(counted(cur, "cur_n"), ["feature", "bin"], "full_outer").fillna(0)
    w = Window.partitionBy("feature")  # features x bins rows
    a = ratio("ref_n", F.sum("ref_n").over(w)) + eps
    b = F.coalesce(ratio("cur_n", F.sum("cur_n").over(w)), F.lit(0.0)) + eps
    out = cells.withColumn("_d", (a - b) * F.ln(a / b)).groupBy("feature").agg(F.sum("_d").alias("psi"))
    return out.withColumn("kept", F.col("psi") <= threshold)


def degenerate_columns(df: DataFrame, features: Sequence[str], tol: float = 0.98, min_variance: float = 0.01) -> DataFrame:
    """``feature, majority_share, variance, duplicate_of`` and the verdict flags.

    ``majority_share`` is the share of the value (NULL counts as one) that more than half of
    the rows hold, and NULL where there is none. Such a value is the median, so a quantile
    sketch names the only candidate and a second scan counts it: no value counts of
    continuous features are shuffled. ``tol`` must therefore be above one half.

    Two columns are duplicates when every row holds equal values: each value is hashed
    together with the digest of its row and the hashes are summed, so equal columns have
    equal sums whatever the order in which rows are read.
    """
    if tol <= 0.5:
        raise ValueError("tol must be above one half: only the share of a majority is known")
    digest = F.xxhash64(*[F.col(q(f)).cast("double") for f in features])
    stats = df.agg(*[
        a for i, f in enumerate(features) for a in (
            F.var_samp(F.col(q(f)).cast("double")).alias(f"v{i}"),
            F.sum(F.xxhash64(digest, F.col(q(f)).cast("double")).cast("decimal(38,0)")).alias(f"h{i}"))])
    rows = stats.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("pos"), F.lit(f).alias("feature"), F.col(f"v{i}").alias("variance"), F.col(f"h{i}").alias("digest"))
        for i, f in enumerate(features)])).alias("_s")).select("_s.*")
    first = Window.partitionBy("digest")  # one row per feature
    rows = rows.withColumn("_first", F.min(F.struct("pos", "feature")).over(first))
    medians = df.agg(*[F.percentile_approx(F.col(q(f)).cast("double"), 0.5, ACCURACY).alias(f"m{i}") for i, f in enumerate(features)])
    tested = with_scalars(df.select(*[F.col(q(f)).cast("double").alias(f"x{i}") for i, f in enumerate(features)]), medians)
    held = tested.agg(F.count(F.lit(1)).alias("_all"), *[
        F.greatest(F.count_if(F.col(f"x{i}") == F.col(f"m{i}")), F.count_if(F.col(f"x{i}").isNull())).alias(f"n{i}")
        for i in range(len(features))])
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), ratio(f"n{i}", "_all").alias("s")) for i, f in enumerate(features)]))
    share = held.select(cells.alias("_c")).select(
        F.col("_c.feature").alias("feature"), F.when(F.col("_c.s") > 0.5, F.col("_c.s")).alias("majority_share"))
    return rows.join(share, "feature").select(
        "feature", "majority_share", "variance",
        F.when(F.col("_first.pos") < F.col("pos"), F.col("_first.feature")).alias("duplicate_of"),
        F.coalesce(F.col("majority_share") >= tol, F.lit(False)).alias("quasi_constant"),
        (F.col("variance") < min_variance).alias("low_variance"))


def outliers(df: DataFrame, col: str, method: str = "iqr", threshold: float | None = None, mode: str = "drop",
             exact: bool = True) -> DataFrame:
    """Drop or clip values outside IQR fences, z-score limits or the MAD score limit.

    ``exact=False`` takes quartiles and medians from a bounded sketch instead of exact
    order statistics.
    """
    def quantiles(frame, c, ps, names):
        if exact:
            return exact_percentiles(frame, c, ps, names)
        return frame.agg(*[F.percentile_approx(c, p, ACCURACY).alias(n) for p, n in zip(ps, names)])

    v = F.col(q(col)).cast("double")
    values = df.select(v.alias("_v"))
    strict = False
    if method == "iqr":
        t = 1.5 if threshold is None else threshold
        b = quantiles(values, "_v", [0.25, 0.75], ["_q1", "_q3"]).select(
            (F.col("_q1") - t * (F.col("_q3") - F.col("_q1"))).alias("_lo"),
            (F.col("_q3") + t * (F.col("_q3") - F.col("_q1"))).alias("_hi"))
    elif method == "zscore":
        t = 3.0 if threshold is None else threshold
        # the score uses the population deviation, the clip bounds the sample one
        dev = F.stddev_pop("_v") if mode == "drop" else F.stddev_samp("_v")
        b = values.agg((F.avg("_v") - t * dev).alias("_lo"), (F.avg("_v") + t * dev).alias("_hi"))
        strict = mode == "drop"
    elif method == "mad":
        t = 3.0 if threshold is None else threshold
        med = quantiles(values, "_v", [0.5], ["_med"])
        gaps = with_scalars(values, med).withColumn("_g", F.abs(F.col("_v") - F.col("_med")))
        mad = quantiles(gaps.select("_g"), "_g", [0.5], ["_mad"])
        inside = (F.col("_mad") == 0) | (0.6745 * F.abs(F.col("_v") - F.col("_med")) <= t * F.col("_mad"))
        b = with_scalars(gaps, mad).where(inside).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    else:
        raise ValueError(f"unknown method {method!r}")
    joined = with_scalars(df, b)
    if mode == "drop":
        keep = ((v > F.col("_lo")) & (v < F.col("_hi"))) if strict else v.between(F.col("_lo"), F.col("_hi"))
        return joined.where(keep).drop("_lo", "_hi")
    return joined.withColumn(col, F.when(v.isNotNull(), F.greatest(F.col("_lo"), F.least(F.col("_hi"), v)))).drop("_lo", "_hi")


def gini(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """2 * AUC - 1 per group with ties at average rank; NULL when a class is missing.

    Rows are first reduced to (group, score) class counts. A positive is worth the
    negatives below it plus half of the tied ones, and those are running counts in the
    global order, so one group holding most rows needs no single-task window.
    """
    y = F.col(label).cast("long")
    cells = (df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
             .groupBy(*by, F.col(score).cast("double").alias("_s"))
             .agg(F.sum(y).alias("_pos"), F.sum(1 - y).alias("_neg")))
    ranked = global_prefix(cells, [*by, "_s"], ["_neg"], rank="_rn")
    below = F.col("cum__neg") - F.col("_neg")
    start = F.min(below)
    pos, neg = F.sum("_pos"), F.sum("_neg")
    pairs = F.sum(F.col("_pos") * (below + F.col("_neg") / 2)) - pos * start
    auc = ratio(pairs, pos.cast("double") * neg)
    return ranked.groupBy(*by).agg(pos.alias("positives"), neg.alias("negatives"), (2 * auc - 1).alias("gini"))


def time_split(df: DataFrame, date_col: str, cut, key: str, train: int = 80, name: str = "split") -> DataFrame:
    """``test`` from the cut date on, before it ``train``/``val`` by a hash of the key.

    A hash keeps the split stable over re-runs and partitionings, which a random split
    does not: the first 8 hex digits of the MD5 of the key as text, modulo 100, so that any other engine finds the same split.
    """
    digits = F.conv(F.substring(F.md5(F.col(q(key)).cast("string")), 1, 8), 16, 10).cast("long")
    side = F.when(digits % 100 < train, "train").otherwise("val")
    return df.withColumn(name, F.when(F.col(date_col) >= cut, "test").otherwise(side))


def time_folds(df: DataFrame, date_col: str, folds: int = 5) -> DataFrame:
    """Expanding-window folds: ``fold, part, rows...``; fold k trains on the first k of
    ``folds + 1`` equal-count time blocks and tests on block k + 1 (see :func:`validation.time_blocks`)."""
    from rollspan.operators.validation import time_blocks
    fold = F.explode(F.sequence(F.greatest(F.col("_block"), F.lit(1)), F.lit(folds)))
    return (time_blocks(df, date_col, folds, "_block").withColumn("fold", fold)
            .withColumn("part", F.when(F.col("_block") == F.col("fold"), "test").otherwise("train"))
            .drop("_block"))


def importance(df: DataFrame, features: Sequence[str], label: str, seed: int = 7, trees: int = 20, depth: int = 5) -> DataFrame:
    """``feature, importance`` of a Spark ML random forest (the fit is an action)."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    rows = VectorAssembler(inputCols=list(features), outputCol="_x", handleInvalid="keep").transform(
        df.select(*[F.coalesce(F.col(q(f)).cast("double"), F.lit(0.0)).alias(f) for f in features], F.col(label).cast("double").alias("_y")))
    model = RandomForestClassifier(featuresCol="_x", labelCol="_y", numTrees=trees, maxDepth=depth, seed=seed).fit(rows)
    return df.sparkSession.createDataFrame(
        [(f, float(w)) for f, w in zip(features, model.featureImportances.toArray())], "feature string, importance double")


def select_important(table: DataFrame, top_k: int | None = None, threshold: float | None = None,
                     accumulate: float | None = None) -> DataFrame:
    """Cut of an importance table (one row per feature): cumulative share, top-k or floor."""
    order = [F.col("importance").desc(), F.col("feature")]
    if accumulate is not None:
        w = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return table.withColumn("cumulative", F.sum("importance").over(w)).where(F.col("cumulative") <= accumulate)
    if top_k is not None:
        return table.orderBy(*order).limit(top_k)
    if threshold is not None:
        return table.where(F.col("importance") >= threshold)
    raise ValueError("give one of accumulate, top_k or threshold")


def _abs_correlations(df: DataFrame, features: Sequence[str], other: str) -> list[float]:
    """|correlation| of each feature with one column, over the rows where both are known; 0 where it is undefined."""
    known = F.nanvl(F.col(q(other)).cast("double"), F.lit(None))
    aggs = []
    for i, c in enumerate(doubles(features)):
        x = F.when(known.isNotNull(), F.nanvl(c, F.lit(None)))
        y = F.when(x.isNotNull(), known)
        aggs.append(F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)).alias(f"c{i}"))
    row = df.agg(*aggs).first()
    return [abs(c) if c is not None and c == c else 0.0 for c in row]


def mrmr(df: DataFrame, features: Sequence[str], label: str, k: int, method: str = "MIQ") -> DataFrame:
    """Greedy maximum-relevance minimum-redundancy choice: ``rank, feature, score``.

    Relevance is the absolute correlation with the label, redundancy the mean absolute
    correlation with the features chosen so far. Each step correlates all features with the one just chosen and adds to their
    redundancy sums: k aggregates of one number per feature, so no matrix of features by features is built anywhere.
    """
    relevance, redundancy = _abs_correlations(df, features, label), [0.0] * len(features)
    left, out = list(range(len(features))), []
    while left and len(out) < k:
        def score(i):
            if not out:
                return relevance[i]
            mean = redundancy[i] / len(out)
            return relevance[i] / max(mean, 1e-9) if method == "MIQ" else relevance[i] - mean
        best = max(left, key=lambda i: (score(i), -i))
        left.remove(best)
        out.append((len(out) + 1, features[best], float(score(best))))
        if left and len(out) < k:
            for i, c in zip(left, _abs_correlations(df, [features[i] for i in left], features[best])):
                redundancy[i] += c
    return df.sparkSession.createDataFrame(out, "rank int, feature string, score double")
