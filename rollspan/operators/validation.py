"""Expanding-window validation: a model per fold, fitted and scored inside Spark.

Rows are cut into ``folds + 1`` equal-count blocks of time; fold k trains on blocks 0 ... k-1 and tests on block k. A linear model
needs only the co-moments of its training rows, and those of a fold are the sums of its blocks': every row is read once and
enters one matrix, whatever the number of folds, and what is shuffled is blocks x features^2 numbers per task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from rollspan.operators.fill import q
from rollspan.operators.selection import gini
from rollspan.session import cut_lineage, with_scalars


def time_blocks(df: DataFrame, date_col: str, folds: int = 5, name: str = "block") -> DataFrame:
    """``df`` with the number of each row's time block, 0 ... ``folds``; rows without a date are left out.

    Blocks cut at days (at the values of a column that is no timestamp), so rows of a day stay together and the window sees
    one row per day. A row's block is looked up in the few first days of the blocks, not joined.
    """
    day = F.to_date(date_col) if dict(df.dtypes)[date_col].startswith("timestamp") else F.col(q(date_col))
    per_day = df.where(day.isNotNull()).groupBy(day.alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    total = per_day.agg(F.sum("_n").alias("_total"))
    w = Window.orderBy("_d").rowsBetween(Window.unboundedPreceding, 0)  # one row per day
    # block of the middle of the day's own rows
    block = F.floor((F.sum("_n").over(w) - F.col("_n") / 2) * (folds + 1) / F.col("_total")).cast("int")
    starts = (with_scalars(per_day, total).select("_d", F.least(block, F.lit(folds)).alias("_b"))
              .groupBy("_b").agg(F.min("_d").alias("_d")).agg(F.collect_list(F.struct("_d", "_b")).alias("_starts")))
    reached = F.filter("_starts", lambda s: s["_d"] <= day)
    rows = with_scalars(df, starts).withColumn(name, F.array_max(F.transform(reached, lambda s: s["_b"])))
    return rows.where(F.col(name).isNotNull()).drop("_starts")


def _moments(batches: Iterator[pd.DataFrame], width: int) -> Iterator[pd.DataFrame]:
    """Sums of products of (1, features, label) per block."""
    sums: dict[int, np.ndarray] = {}
    for pdf in batches:
        block = pdf["block"].to_numpy()
        rows = np.column_stack([np.ones(len(pdf)), pdf.drop(columns="block").to_numpy(dtype="float64")])
        for b in np.unique(block):
            own = rows[block == b]
            sums[b] = sums.get(b, 0) + own.T @ own
    i, j = np.triu_indices(width)
    for b, m in sums.items():
        yield pd.DataFrame({"block": b, "i": i, "j": j, "v": m[i, j]})


def _solve(cells: pd.DataFrame, width: int, ridge: float) -> pd.DataFrame:
    """Least squares from co-moments: intercept first. Features that carry nothing new get weight 0 (pseudo-inverse)."""
    m = np.zeros((width, width))
    m[cells["i"], cells["j"]] = cells["v"]
    m = m + np.triu(m, 1).T
    n, mean = m[0, 0], m[0, 1:] / m[0, 0]
    cov = m[1:, 1:] / n - np.outer(mean, mean)
    scale = np.sqrt(np.maximum(np.diag(cov)[:-1], 0))
    scale[scale == 0] = 1
    normal = cov[:-1, :-1] / np.outer(scale, scale) + ridge * np.eye(width - 2)
    weights = np.linalg.pinv(normal, rcond=1e-10, hermitian=True) @ (cov[:-1, -1] / scale) / scale
    return pd.DataFrame({"fold": [cells["fold"].iloc[0]], "coefficients": [[mean[-1] - weights @ mean[:-1], *weights]]})


def linear_by_fold(blocks: DataFrame, features: Sequence[str], label: str, folds: int, ridge: float = 0.0) -> DataFrame:
    """``fold, coefficients`` (intercept first) of a linear model per fold. NULL features count as 0, rows without label don't train."""
    x = [F.coalesce(F.col(q(f)).cast("double"), F.lit(0.0)).alias(f"x{i}") for i, f in enumerate(features)]
    rows = blocks.where(F.col(q(label)).isNotNull() & (F.col("block") < folds)).select("block", *x, F.col(q(label)).cast("double").alias("y"))
    width = len(x) + 2
    cells = rows.mapInPandas(partial(_moments, width=width), "block int, i int, j int, v double")
    cells = cells.groupBy("block", "i", "j").agg(F.sum("v").alias("v"))
    # a fold is trained on all blocks before its own
    per_fold = cells.select(F.explode(F.sequence(F.col("block") + 1, F.lit(folds))).alias("fold"), "i", "j", "v").groupBy("fold", "i", "j").agg(F.sum("v").alias("v"))
    return per_fold.groupBy("fold").applyInPandas(partial(_solve, width=width, ridge=ridge), "fold int, coefficients array<double>")


def score_folds(blocks: DataFrame, models: DataFrame, features: Sequence[str], label: str, digits: int | None = None) -> DataFrame:
    """``fold, part, y, score``: every row under the models of the folds that train or test on it."""
    fitted = models.agg(F.collect_list(F.struct("fold", "coefficients")).alias("_models"))
    rows = with_scalars(blocks.where(F.col(q(label)).isNotNull()).select(
        "block", F.col(q(label)).cast("long").alias("y"), *[F.coalesce(F.col(q(f)).cast("double"), F.lit(0.0)).alias(f"x{i}") for i, f in enumerate(features)]), fitted)
    model = F.explode(F.filter("_models", lambda m: m["fold"] >= F.col("block")))
    rows = rows.select("block", "y", *[f"x{i}" for i in range(len(features))], model.alias("_m"))
    score = F.expr(" + ".join(["_m.coefficients[0]", *[f"_m.coefficients[{i + 1}] * x{i}" for i in range(len(features))]]))
    return rows.select(F.col("_m.fold").alias("fold"), F.when(F.col("block") == F.col("_m.fold"), "test").otherwise("train").alias("part"),
                       "y", (score if digits is None else F.round(score, digits)).alias("score"))


def validate(df: DataFrame, date_col: str, features: Sequence[str], label: str, folds: int = 5, ridge: float = 0.0,
             digits: int | None = None) -> DataFrame:
    """``fold, train_rows, test_rows, train_gini, test_gini, coefficients`` of a linear model per expanding-window fold.

    A Gini is NULL when its part has one class only; ``digits`` rounds scores before they are ranked.
    """
    blocks = time_blocks(df, date_col, folds)
    models = cut_lineage(linear_by_fold(blocks, features, label, folds, ridge))
    ranked = gini(score_folds(blocks, models, features, label, digits), "y", "score", ["fold", "part"])
    parts = [F.max(F.when(F.col("part") == p, F.col("positives") + F.col("negatives"))).alias(f"{p}_rows") for p in ("train", "test")]
    ginis = [F.max(F.when(F.col("part") == p, F.col("gini"))).alias(f"{p}_gini") for p in ("train", "test")]
    return models.join(ranked.groupBy("fold").agg(*parts, *ginis), "fold").select("fold", "train_rows", "test_rows", "train_gini", "test_gini", "coefficients")
