"""Merges on equi keys. No side is ever hinted to broadcast here: Spark broadcasts a side
only when its measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and AQE
splits skewed sort-merge partitions otherwise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

from rollspan.functions.numeric import quoted as q
from rollspan.session import cut_lineage, with_scalars


def outer_merge(dfs: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer join of tables that each have at most one row per key.

    The ``USING`` keys are coalesced by Spark, and every join hashes on the same keys, so
    each input is shuffled once.
    """
    return reduce(lambda a, b: a.join(b, list(keys), "full_outer"), dfs)


def outer_merge_long(dfs: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """The same result by union and one aggregate: one shuffle for any number of tables.

    Only for tables with one row per key; better than a join chain beyond a few tables.
    """
    values = [c for d in dfs for c in d.columns if c not in keys]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
    return stacked.groupBy(*keys).agg(*[F.first(c, ignorenulls=True).alias(c) for c in values])


def enrich(df: DataFrame, dim: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    return df.join(dim, list(keys), how)


def spread_join(df: DataFrame, dim: DataFrame, keys: Sequence[str], how: str = "inner", share: float = 0.01,
                spread: "Column | None" = None) -> DataFrame:
    """Join of rows to a table where a few keys hold many of the rows.

    A counting pass over the keys finds those with more than ``share`` of all rows (so fewer than 1 / ``share`` of them, which is all that is
    broadcast). Their rows are dealt to as many parts as it takes to bring each part down to ``share``, by ``spread`` (a hash of the row if not given), and
    meet a copy of the key's rows of ``dim`` there; all other keys are joined as they are. ``how`` is ``inner`` or ``left``.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    keys = list(keys)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_all"))
    heavy = with_scalars(counts, total).where(F.col("_n") > F.col("_all") * share)
    heavy = cut_lineage(heavy.select(*keys, F.ceil(F.col("_n") / (F.col("_all") * share)).cast("int").alias("_parts")))
    one = F.coalesce("_parts", F.lit(1))
    row = F.xxhash64(*[F.col(q(c)) for c in df.columns]) if spread is None else spread
    left = df.withColumn("_spread", row).join(F.broadcast(heavy), keys, "left").withColumn("_part", F.pmod("_spread", one).cast("int"))
    right = dim.join(F.broadcast(heavy), keys, "left").withColumn("_part", F.explode(F.sequence(F.lit(0), one - 1)))
    return left.drop("_spread", "_parts").join(right.drop("_parts"), [*keys, "_part"], how).drop("_part")


def restrict(df: DataFrame, population: DataFrame, key: str, population_key: str | None = None) -> DataFrame:
    """Keep rows whose key is in the population (left semi join)."""
    ids = population.select(F.col(population_key or key).alias(key))
    return df.join(ids, key, "left_semi")


def exclude(df: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.join(done, list(keys), "left_anti")


def spine(dfs: Sequence[DataFrame], key: "str | Sequence[str]") -> DataFrame:
    """Distinct keys over all tables, without those that hold a NULL.

    Each table's keys are made distinct first, which reduces raw tables map-side and moves nothing of tables that are stored by key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return reduce(DataFrame.unionAll, [d.select(*keys).where(present).distinct() for d in dfs]).distinct()


def spine_join(dfs: Sequence[DataFrame], key: str, fill: float | int | None = None) -> DataFrame:
    """Every table joined to the spine of all keys, numeric gaps filled."""
    merged = outer_merge([d.where(F.col(key).isNotNull()) for d in dfs], [key])
    return merged if fill is None else merged.fillna(fill)


def densify(df: DataFrame, keys: Sequence[str], date_col: str, fill: float | int | None = 0) -> DataFrame:
    """One row per key and observed date, missing facts filled.

    The dates are folded into one array (bounded by the calendar) that is attached to the
    distinct keys, so no key x date join is planned; ``df`` has one row per key and date.
    """
    dates = df.agg(F.array_sort(F.collect_set(date_col)).alias("_dates"))
    grid = (with_scalars(df.select(*keys).distinct(), dates)
            .select(*keys, F.explode("_dates").alias(date_col)))
    out = grid.join(df, [*keys, date_col], "left")
    return out if fill is None else out.fillna(fill)


def month_shift_join(df: DataFrame, keys: Sequence[str], date_col: str, n: int, suffix: str = "_prev") -> DataFrame:
    """Join each row to the same key ``n`` months earlier (NULL values when absent)."""
    values = [c for c in df.columns if c not in (*keys, date_col)]
    shifted = df.select(*keys, F.add_months(date_col, n).alias(date_col),
                        *[F.col(v).alias(v + suffix) for v in values])
    return df.join(shifted, [*keys, date_col], "full_outer")


def attach_labels(labels: DataFrame, df: DataFrame, on: Sequence[tuple[str, str]], how: str = "left") -> DataFrame:
    """Label rows with features whose key columns have other names."""
    renamed = df.withColumnsRenamed({right: left for left, right in on})
    return labels.join(renamed, [left for left, _ in on], how)


class MergeGuard(RuntimeError):
    """A guarded merge lost, gained or duplicated rows."""


class GuardedMerge:
    """A merge whose row counts are observed while it runs.

    ``frame`` is the merged table. Its first action also fills the counts of every step, at no extra pass; :meth:`report`
    and :meth:`check` wait for that action.
    """

    def __init__(self, frame: DataFrame, keys: Observation, steps: Sequence[tuple[str, Observation]]):
        self.frame, self._keys, self._steps = frame, keys, list(steps)

    def report(self) -> DataFrame:
        """``step, table, rows, matched, ok``: rows after each join, and how many of them have a row of that table."""
        n = self._keys.get["rows"]
        rows = []
        for i, (name, seen) in enumerate(self._steps):
            got = seen.get
            rows.append((i + 1, name, got["rows"], got["matched"], got["rows"] == n))
        return self.frame.sparkSession.createDataFrame(rows, "step int, table string, rows long, matched long, ok boolean")

    def check(self) -> None:
        """Raise :class:`MergeGuard` at the first step after which rows and distinct keys differ."""
        n = self._keys.get["rows"]
        for name, seen in self._steps:
            if seen.get["rows"] != n:
                raise MergeGuard(f"{seen.get['rows']} rows for {n} keys after the merge of {name!r}: a key is repeated there")


def guarded_outer_merge(tables: Mapping[str, DataFrame], keys: Sequence[str], ids: DataFrame | None = None) -> GuardedMerge:
    """Every table on the spine of all keys, with guards after each join.

    The spine holds each key once, so a left join may not change the number of rows: it does exactly if the table repeats a key.
    Unlike a chain of full outer joins, left joins keep the partitioning of the spine, so the growing table is never shuffled again,
    and rows of tables stored by key (:func:`store_by_key`) are not shuffled at all. ``ids`` is a spine stored before; without it, the distinct keys are shuffled.
    """
    keys = list(keys)
    names = [c for t in tables.values() for c in t.columns if c not in keys]
    if len(set(names)) != len(names):
        raise MergeGuard(f"columns of several tables: {sorted({c for c in names if names.count(c) > 1})}")
    start = Observation()
    out = (spine(list(tables.values()), keys) if ids is None else ids.select(*keys)).observe(start, F.count(F.lit(1)).alias("rows"))
    steps = []
    for name, table in tables.items():
        seen = Observation()
        out = out.join(table.withColumn("_matched", F.lit(True)), keys, "left")
        out = out.observe(seen, F.count(F.lit(1)).alias("rows"), F.count("_matched").alias("matched")).drop("_matched")
        steps.append((name, seen))
    return GuardedMerge(out, start, steps)


def guarded_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner",
                 mode: str = "flag") -> DataFrame:
    """Join that must neither lose nor multiply rows.

    ``mode="raise"`` checks now (one aggregate per input and one for the result) and
    raises :class:`MergeGuard`. ``mode="flag"`` stays lazy: the single row of
    :func:`merge_report` tells the caller.
    """
    joined = left.join(right, list(keys), how)
    expected = len(left.columns) + len(right.columns) - len(keys)
    if len(joined.columns) != expected or len(set(joined.columns)) != expected:
        raise MergeGuard(f"columns: expected {expected} distinct, got {joined.columns}")
    if mode == "raise":
        row = merge_report(left, right, keys, how).first()
        if not row["ok"]:
            raise MergeGuard(str(row.asDict()))
    return joined


def merge_report(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Counts that prove a merge: rows and distinct keys of both inputs and the result.

    One shuffle over (key, side) counts; the joined rows themselves are never built.
    """
    counts = (left.select(*keys, F.lit(1).alias("l"), F.lit(0).alias("r"))
              .unionAll(right.select(*keys, F.lit(0).alias("l"), F.lit(1).alias("r")))
              .groupBy(*keys).agg(F.sum("l").alias("l"), F.sum("r").alias("r")))
    both = F.when((F.col("l") > 0) & (F.col("r") > 0), F.col("l") * F.col("r")).otherwise(0)
    rows = {
        "inner": both,
        "left": F.when(F.col("l") > 0, F.col("l") * F.greatest("r", F.lit(1))).otherwise(0),
        "full_outer": F.greatest(F.col("l"), F.lit(1)) * F.greatest(F.col("r"), F.lit(1)),
    }[how]
    rep = counts.agg(
        F.sum("l").alias("left_rows"), F.sum("r").alias("right_rows"), F.sum(rows).alias("merged_rows"),
        F.sum(F.when(rows > 0, 1).otherwise(0)).alias("merged_keys"))
    same = F.col("merged_rows") == F.col("merged_keys")
    if how == "inner":
        same = same & (F.col("left_rows") == F.col("right_rows")) & (F.col("merged_rows") == F.col("left_rows"))
    elif how == "left":
        same = same & (F.col("merged_rows") == F.col("left_rows"))
    return rep.withColumn("ok", same)
