"""Latest-record, top-1 and global-rank operators without one-task windows.

Per-key "latest" choices are aggregates of ordered structs instead of ``row_number``.
Spark plans them as sort aggregates: each task sorts its own rows by key and sends one row
per key, so a key that holds a third of all rows is never gathered in one task. A hash
aggregate of the order column alone would need a second scan and a join to get the row back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollspan.operators.order_statistics import percentiles
from rollspan.session import cut_lineage, with_scalars


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                   ties: str = "first") -> DataFrame:
    """Row(s) with the greatest ``order`` per key.

    ``ties="first"``: exactly one row; equal orders are decided by the remaining columns,
    so the choice is deterministic. ``ties="all"``: every row equal to the maximum.
    NULL orders lose against any value.
    """
    keys = list(keys)
    if ties == "all":
        # the null-aware struct is what max() compares, so join on it
        ranked = df.withColumn("_o", F.struct(*order))
        best = ranked.groupBy(*keys).agg(F.max("_o").alias("_o"))
        return ranked.join(best, [*keys, "_o"], "left_semi").select(*df.columns)
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_b"))
    return best.select(*[F.col(c) if c in keys else F.col(f"_b.{c}").alias(c) for c in df.columns])


def top1_by_count(df: DataFrame, keys: Sequence[str], col: str, count: str = "n") -> DataFrame:
    """Most frequent value per key; equal counts go to the smaller value."""
    counts = df.groupBy(*keys, col).agg(F.count(F.lit(1)).alias(count))
    best = counts.groupBy(*keys).agg(F.min(F.struct((-F.col(count)).alias("neg"), F.col(col).alias("v"))).alias("_b"))
    return best.select(*keys, F.col("_b.v").alias(col), (-F.col("_b.neg")).alias(count))


def keep_max(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """All rows that carry their key's maximum of ``col``."""
    return latest_per_key(df, keys, [col], ties="all")


def last_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str | None = None) -> DataFrame:
    """Last ``n`` rows per key. Meant for logs and other reduced tables; Spark prunes each
    task to ``n`` rows per key before the shuffle (window group limit)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
    return out.withColumnRenamed("_rn", rank) if rank else out.drop("_rn")


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def cumulative_cut(df: DataFrame, value: str, order: Sequence[str], upto: float) -> DataFrame:
    """Ranked list cut where the running sum of ``value`` passes ``upto`` (a reduced table
    of one row per feature, hence the unpartitioned window is bounded)."""
    w = Window.orderBy(F.col(value).desc(), *order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("cumulative", F.sum(value).over(w)).where(F.col("cumulative") <= upto)


def global_prefix(df: DataFrame, order: Sequence[str], sums: Sequence[str] = (), rank: str = "rn",
                  ascending: bool = True) -> DataFrame:
    """Global row number and running sums over a total order, without a one-task window.

    Rows are range-partitioned and sorted by the whole ``order`` (which should be unique,
    so a heavily repeated leading value still spreads over partitions), numbered inside
    each partition, materialised once, and shifted by the totals of the partitions before.
    Only one row per partition is gathered. Materialising matters: range bounds are
    sampled, so evaluating the sort twice could number rows inconsistently.
    """
    cols = [F.col(c).asc_nulls_first() if ascending else F.col(c).desc_nulls_last() for c in order]
    placed = cut_lineage(
        df.orderBy(*cols).withColumn("_m", F.monotonically_increasing_id()))
    placed = placed.withColumns({"_p": F.shiftright("_m", 33), "_i": F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))})
    per_part = placed.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"), *[F.sum(s).alias(f"_t_{s}") for s in sums])
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n0"),
                              *[F.coalesce(F.sum(f"_t_{s}").over(before), F.lit(0)).alias(f"_t0_{s}") for s in sums])
    # one row per partition of the sort: its size is bounded by the partition count
    out = placed.join(F.broadcast(offsets), "_p")
    added = {rank: (F.col("_n0") + F.col("_i") + 1).cast("long")}
    if sums:
        inside = Window.partitionBy("_p").orderBy("_i").rowsBetween(Window.unboundedPreceding, 0)
        added |= {f"cum_{s}": F.col(f"_t0_{s}") + F.sum(s).over(inside) for s in sums}
    return out.withColumns(added).select(*df.columns, *added)


def population_ntile(df: DataFrame, value: str, tie: str, n: int = 100, name: str = "bucket",
                     exact: bool = True) -> DataFrame:
    """``ntile(n)`` over the whole population.

    Exact: global row number and the ntile rule (the first ``rows mod n`` buckets get one
    row more). Approximate: bucket bounds from a bounded-size quantile sketch; equal
    values share a bucket, no sort and no materialisation.
    """
    if not exact:
        cuts = df.agg(F.percentile_approx(value, [i / n for i in range(1, n)], 100_000).alias("_cuts"))
        bucket = F.size(F.filter("_cuts", lambda c: c < F.col(value))) + 1
        return with_scalars(df, cuts).withColumn(name, bucket).drop("_cuts")
    ranked = global_prefix(df, [value, tie], rank="_rn")
    whole = ranked.agg(F.count(F.lit(1)).alias("_total"))
    small, extra = F.expr(f"_total div {n}"), F.expr(f"_total % {n}")
    head = extra * (small + 1)
    bucket = F.when(F.col("_rn") <= head, F.expr(f"(_rn - 1) div (_total div {n} + 1)") + 1).otherwise(
        extra + F.floor(F.try_divide(F.col("_rn") - 1 - head, small)) + 1)
    return with_scalars(ranked, whole).withColumn(name, bucket.cast("int")).drop("_rn", "_total")


def exact_percentiles(df: DataFrame, value: str, ps: Sequence[float], names: Sequence[str] | None = None) -> DataFrame:
    """One row of exact linearly interpolated percentiles at any scale (see :func:`order_statistics`; an action)."""
    names = list(names or [f"p{int(p * 100)}" for p in ps])
    found = percentiles(df, [F.col(value)], ps)[0]
    return df.sparkSession.createDataFrame([tuple(found)], ", ".join(f"`{n}` double" for n in names))
