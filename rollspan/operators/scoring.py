"""Weight-of-evidence transform, model scoring and score scaling as lazy DataFrame steps."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from rollspan.functions.numeric import logit
from rollspan.operators.fill import present, q
from rollspan.operators.windows import population_ntile
from rollspan.session import cut_lineage, with_scalars

#: one bin: lower bound (None = open), upper bound (None = open), weight of evidence
Bin = "tuple[float | None, float | None, float]"


def woe_column(c: str, bins: Sequence, missing: float = 0.0) -> Column:
    """CASE over right-open bins; NULL gives ``missing``, anything uncovered 0."""
    v = F.col(q(c))
    out = F.when(v.isNull(), F.lit(float(missing)))
    for lo, hi, woe in bins:
        test = F.lit(True)
        if lo is not None:
            test = test & (v >= lo)
        if hi is not None:
            test = test & (v < hi)
        out = out.when(test, F.lit(float(woe)))
    return out.otherwise(0.0)


def woe_transform(df: DataFrame, bins: Mapping[str, Sequence], missing: str = "zero",
                  missing_woe: Mapping[str, float] | None = None, absent: str = "raise") -> DataFrame:
    """Replace features by their WoE in one projection. ``missing="woe"`` uses the fitted
    WoE of NULL from ``missing_woe`` instead of 0. A binned column that ``df`` lacks raises
    unless ``absent="skip"``."""
    lookup = missing_woe or {}
    return df.withColumns({
        c: woe_column(c, bins[c], lookup.get(c, 0.0) if missing == "woe" else 0.0)
        for c in present(df, bins, absent)
    })


def woe_lookup(df: DataFrame, bins: DataFrame, features: Sequence[str]) -> DataFrame:
    """WoE from a fitted bin table ``(feature, bin, lo, hi, woe)`` in (lo, hi] form.

    The table (features x bins rows) is folded into one row of arrays, so scoring needs
    neither a driver round trip nor a join per feature.
    """
    table = bins.where(F.col("bin") > 0).groupBy().pivot("feature", list(features)).agg(
        F.array_sort(F.collect_list(F.struct("bin", "hi", "woe"))))
    missing = bins.where(F.col("bin") == 0).groupBy().pivot("feature", list(features)).agg(F.first("woe"))
    for f in features:
        table = table.withColumnRenamed(f, f"_b_{f}")
        missing = missing.withColumnRenamed(f, f"_m_{f}")
    wide = with_scalars(with_scalars(df, table), missing)

    def one(f):
        hit = F.try_element_at(F.filter(F.col(q(f"_b_{f}")), lambda b: b["hi"].isNull() | (F.col(q(f)) <= b["hi"])), F.lit(1))
        return F.when(F.col(q(f)).isNull(), F.coalesce(F.col(q(f"_m_{f}")), F.lit(0.0))).otherwise(F.coalesce(hit["woe"], F.lit(0.0)))
    return wide.select(*[c for c in df.columns if c not in features], *[one(f).alias(f) for f in features])


def linear_probability(weights: Mapping[str, float], intercept: float) -> Column:
    """Logistic model as an expression: stays in whole-stage codegen, no Python worker."""
    z = F.lit(float(intercept))
    for c, w in weights.items():
        z = z + F.coalesce(F.col(q(c)).cast("double"), F.lit(0.0)) * F.lit(float(w))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def batch_score(df: DataFrame, model, features: Sequence[str], categories: Sequence[str] = (),
                key: str = "msisdn", name: str = "predict_proba", keep: Sequence[str] = ()) -> DataFrame:
    """Score with a fitted Spark ML model, a weight table or a Python predictor.

    * Spark ML (has ``transform``): the class-1 probability of its output;
    * ``(weights, intercept)``: expression only;
    * a callable ``pandas.DataFrame -> numpy array``: broadcast by Spark with the closure
      and applied to Arrow batches.
    NULL categories become ``"X"`` first.
    """
    df = df.fillna({c: "X" for c in categories}) if categories else df
    kept = [key, *keep]
    if hasattr(model, "transform"):
        from pyspark.ml.functions import vector_to_array
        return model.transform(df).select(*kept, vector_to_array("probability")[1].alias(name))
    if isinstance(model, tuple):
        return df.select(*kept, linear_probability(*model).alias(name))
    return df.select(*kept, python_scorer(model, list(features))(*[F.col(q(f)) for f in features]).alias(name))


def python_scorer(predict: Callable, features: list[str]):
    @F.pandas_udf("double")
    def score(*cols: pd.Series) -> pd.Series:
        frame = pd.concat(cols, axis=1)
        frame.columns = features
        return pd.Series(predict(frame), dtype="float64")
    return score


def score_bounds(df: DataFrame, p: str, lo: float = 0.01, hi: float = 0.99, accuracy: int = 1_000_000) -> DataFrame:
    """One row with the clipping quantiles, from a sketch of bounded size."""
    cuts = F.percentile_approx(p, [lo, hi], accuracy)
    return df.agg(cuts[0].alias("_lo"), cuts[1].alias("_hi"))


def score_transform(df: DataFrame, p: str, lo: float = 0.01, hi: float = 0.99, power: float = 1.3,
                    name: str = "raw_score") -> DataFrame:
    """Clip the probability at its own quantiles, take the negative logit (floored at 0 so
    that p > 0.5 has a value) and raise it to ``power``.

    The quantiles and the output both need the probability, so ``df`` (keys and probability)
    is materialised once: a Python model sees each row one time.
    """
    df = cut_lineage(df)
    clipped = F.greatest(F.col("_lo"), F.least(F.col("_hi"), F.col(p)))
    raw = F.pow(F.greatest(-logit(clipped), F.lit(0.0)), F.lit(power))
    return with_scalars(df, score_bounds(df, p, lo, hi)).withColumn(name, raw).drop("_lo", "_hi")


def score_scale(df: DataFrame, c: str, lb: int = 300, ub: int = 850, name: str = "credit_score") -> DataFrame:
    """Min-max scale to whole scores in ``[lb, ub]``; the two extremes are joined as one row.
    ``df`` is read twice."""
    ends = df.agg(F.min(c).alias("_mn"), F.max(c).alias("_mx"))
    unit = F.try_divide(F.lit(float(ub - lb)), F.col("_mx") - F.col("_mn"))
    scaled = F.floor(F.round((F.col(c) - F.col("_mn")) * unit)) + F.lit(lb)
    return with_scalars(df, ends).withColumn(name, scaled.cast("long")).drop("_mn", "_mx")


def credit_score(df: DataFrame, p: str = "predict_proba", name: str = "credit_score", **scale) -> DataFrame:
    return score_scale(score_transform(df, p, name="_raw"), "_raw", name=name, **scale).drop("_raw")


def propensity(df: DataFrame, p: str = "predict_proba", key: str = "msisdn", exact: bool = True) -> DataFrame:
    """Probability in basis points and its population percentile. Range bounds are sampled
    before rows are sorted, so the exact form materialises ``df`` once before."""
    df = cut_lineage(df) if exact else df
    ranked = population_ntile(df, p, key, 100, "lg_perct", exact)
    return ranked.withColumn("propensity_score", F.col(p) * 10000)


def basis_points(p: Column) -> Column:
    """Probability rounded to 4 digits and stated in 0..10000."""
    return F.round(F.round(p, 4) * 10000)


def stacked_score(df: DataFrame, components: Mapping[str, tuple], stacker: tuple, key: str = "msisdn",
                  bounds: Mapping[str, Mapping[str, tuple[float, float]]] | None = None,
                  name: str = "stack_score", percentile: bool = True, exact: bool = True) -> DataFrame:
    """Two-level ensemble in one plan: each component ``(weights, intercept)`` scores its
    own winsorised view of the features, the stacker scores the component scores."""
    def clamp(c, w):
        lo, hi = w
        return F.when(F.col(q(c)).isNotNull(), F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), F.col(q(c)))))

    scores = {}
    for comp, (weights, intercept) in components.items():
        limits = (bounds or {}).get(comp, {})
        z = F.lit(float(intercept))
        for c, w in weights.items():
            x = clamp(c, limits[c]) if c in limits else F.col(q(c))
            z = z + F.coalesce(x.cast("double"), F.lit(0.0)) * F.lit(float(w))
        scores[comp] = basis_points(F.lit(1.0) / (F.lit(1.0) + F.exp(-z)))
    level1 = df.select(key, *[c.alias(n) for n, c in scores.items()])
    level2 = level1.withColumn(name, basis_points(linear_probability(*stacker)))
    return population_ntile(level2, name, key, 100, "lg_perct", exact) if percentile else level2
