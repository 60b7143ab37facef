"""Per-key aggregates described by :class:`Measure`, frequency maps and party-role statistics."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollspan.functions.numeric import quoted, ratio

Expr = "Column | str"

#: how a stored aggregate combines when several periods are rolled into one
ROLL = {"sum": "sum", "rows": "sum", "count": "sum", "hits": "sum", "ndistinct": "sum",
        "sumsq": "sum", "min": "min", "max": "max"}


def _c(x):
    return F.expr(x) if isinstance(x, str) else x


@dataclass(frozen=True)
class Measure:
    """One feature: aggregate ``agg`` of ``value`` over the rows where ``where`` holds.

    ``rows`` counts rows (0 when none), ``hits`` counts rows but stays NULL when none,
    ``count`` counts non-NULL values. A sum without rows is NULL unless ``empty="zero"``.
    ``name`` has no window suffix; the roll-up adds it. Expressions may be SQL text, which
    lets measure lists be module constants (Columns need a running session).
    """

    name: str
    agg: str
    value: "Column | str | None" = None
    where: "Column | str | None" = None
    empty: str = "null"

    def text(self) -> str | None:
        """The aggregate as SQL text, or None when it was given as Columns."""
        parts = [p for p in (self.value, self.where) if p is not None]
        if not all(isinstance(p, str) for p in parts):
            return None
        value = "1" if self.agg in ("rows", "hits") else f"({self.value})"
        if self.where is not None:
            value = f"CASE WHEN {self.where} THEN {value} END"
        square = f"(CAST({value} AS DOUBLE) * CAST({value} AS DOUBLE))"
        out = {
            "rows": f"count({value})", "hits": f"sum({value})", "sum": f"sum({value})", "count": f"count({value})",
            "min": f"min({value})", "max": f"max({value})", "avg": f"avg({value})", "std": f"stddev_samp({value})",
            "ndistinct": f"count(DISTINCT {value})", "sumsq": f"sum({square})",
        }[self.agg]
        if self.empty == "zero":
            out = f"coalesce({out}, 0)"
        return f"{out} AS {quoted(self.name)}"

    def column(self) -> Column:
        text = self.text()
        if text is not None:
            return F.expr(text)
        cond = None if self.where is None else _c(self.where)

        def kept(v):
            return v if cond is None else F.when(cond, v)

        one = F.lit(1)
        if self.agg in ("rows", "hits"):
            out = F.count(kept(one)) if self.agg == "rows" else F.sum(kept(one))
        else:
            v = kept(_c(self.value))
            out = {
                "sum": F.sum, "count": F.count, "min": F.min, "max": F.max, "avg": F.avg,
                "std": F.stddev_samp, "ndistinct": F.count_distinct,
                "sumsq": lambda x: F.sum(x.cast("double") * x.cast("double")),
            }[self.agg](v)
        if self.empty == "zero":
            out = F.coalesce(out, F.lit(0))
        return out.alias(self.name)

    @property
    def roll(self) -> str | None:
        """Name of the aggregate that merges this measure over periods; None for avg and std."""
        return ROLL.get(self.agg)


def slices(measure: Measure, conditions: Mapping[str, "Column | str"], where: str = "{name}_{slice}") -> list[Measure]:
    """The measure plus one copy per slice condition, named by the ``where`` template."""
    def both(cond):
        if measure.where is None:
            return cond
        if isinstance(cond, str) and isinstance(measure.where, str):
            return f"({measure.where}) AND ({cond})"
        return _c(measure.where) & _c(cond)

    return [measure] + [
        replace(measure, name=where.format(name=measure.name, slice=s), where=both(cond),
                agg="hits" if measure.agg == "rows" else measure.agg)
        for s, cond in conditions.items()
    ]


def sliced_stats(df: DataFrame, keys: Sequence[str], measures: Iterable[Measure]) -> DataFrame:
    """All measures in one scan and one shuffle; partial aggregation runs map-side."""
    return df.groupBy(*keys).agg(*[m.column() for m in measures])


def distinct_stats(df: DataFrame, keys: Sequence[str], value: "Column | str",
                   where: Mapping[str, "Column | str | None"]) -> DataFrame:
    """Distinct values per key under several conditions: ``name: condition``.

    Several ``count(DISTINCT ...)`` in one aggregate would multiply every input row by the
    number of conditions. Here rows are reduced to one per (key, value) with a flag per
    condition, and the flags are summed.
    """
    flags = [(F.max(F.lit(1) if c is None else F.when(_c(c), 1).otherwise(0))).alias(n) for n, c in where.items()]
    per_value = df.withColumn("_v", _c(value)).where(F.col("_v").isNotNull()).groupBy(*keys, "_v").agg(*flags)
    return per_value.groupBy(*keys).agg(*[F.sum(n).cast("long").alias(n) for n in where])


def group_stats(df: DataFrame, keys: Sequence[str], values: Mapping[str, "Column | str"],
                stats: Sequence[str] = ("sum", "avg", "count", "min", "max", "std"),
                where: Mapping[str, "Column | str | None"] | None = None,
                name: str = "{stat}_{value}{filter}") -> DataFrame:
    """Every statistic of every value, optionally repeated per named filter."""
    filters = where or {"": None}
    return sliced_stats(df, keys, [
        Measure(name.format(stat=s, value=v, filter=f), s, e, cond)
        for f, cond in filters.items() for v, e in values.items() for s in stats
    ])


def frequency_counts(df: DataFrame, keys: Sequence[str], col: str) -> DataFrame:
    """``(keys, item, n)``; NULL items are left out."""
    return (df.where(F.col(col).isNotNull())
              .groupBy(*keys, F.col(col).cast("string").alias("item")).agg(F.count(F.lit(1)).alias("n")))


def merge_counts(states: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """``(keys, item, n)`` states of several periods or sources added up.

    Rows stay narrow: a key with any number of items is spread over the tasks by (key, item), and what a task can't hold is spilled.
    """
    stacked = reduce(DataFrame.unionByName, [s.select(*keys, "item", "n") for s in states])
    return stacked.groupBy(*keys, "item").agg(F.sum("n").alias("n"))


def top_items(counts: DataFrame, keys: Sequence[str], k: int, rank: str = "rank") -> DataFrame:
    """``(keys, item, n, rank)`` of each key's ``k`` most frequent items (equal counts: smaller item first).

    Each task sorts its rows and passes on ``k`` per key, so a key with many items leaves few of them for the task that ranks it.
    """
    w = Window.partitionBy(*keys).orderBy(F.col("n").desc(), "item")
    return counts.select(*keys, "item", "n", F.row_number().over(w).alias(rank)).where(F.col(rank) <= k)


def fold_counts(counts: DataFrame, keys: Sequence[str], name: str = "freq", top: int | None = None) -> DataFrame:
    """item -> count map per key from ``(keys, item, n)``.

    A map is one value of one row, so with ``top`` it holds that many items at most, whatever the key; without it, items should come from a closed
    list. Statistics of open lists need no map: see :func:`count_stats` and :func:`top_items`.
    """
    rows = counts if top is None else top_items(counts, keys, top)
    return rows.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("item", "n")))).alias(name))


def frequency_map(df: DataFrame, keys: Sequence[str], col: str, name: str = "freq", top: int | None = None) -> DataFrame:
    """value -> count map per key (see :func:`fold_counts`). Counts are reduced before the map is assembled, so a
    hot key costs its distinct values, never its rows."""
    return fold_counts(frequency_counts(df, keys, col), keys, name, top)


def map_stats(freq: Column, prefix: str) -> dict[str, Column]:
    """Most/least frequent item, count and percent plus the number of distinct items.

    Ties go to the smaller item for the most frequent and the larger for the least
    frequent (count descending, item ascending). With fewer than two items there is no
    least frequent one.
    """
    entries = F.map_entries(freq)
    ordered = F.array_sort(F.transform(entries, lambda e: F.struct((-e["value"]).alias("neg"), e["key"].alias("item"))))
    n = F.coalesce(F.size(F.map_keys(freq)), F.lit(0))
    n = F.when(freq.isNull(), 0).otherwise(n)
    whole = F.aggregate(F.map_values(freq), F.lit(0).cast("long"), lambda acc, x: acc + x)
    top, low = F.try_element_at(ordered, F.lit(1)), F.try_element_at(ordered, F.lit(-1))
    low = F.when(n > 1, low)
    top_n, low_n = F.coalesce(-top["neg"], F.lit(0)), F.coalesce(-low["neg"], F.lit(0))
    return {
        f"{prefix}most_item": top["item"], f"{prefix}least_item": low["item"],
        f"{prefix}unique": n,
        f"{prefix}most_value": top_n, f"{prefix}least_value": low_n,
        f"{prefix}most_percent": F.coalesce(ratio(top_n, whole), F.lit(0.0)),
        f"{prefix}least_percent": F.coalesce(ratio(low_n, whole), F.lit(0.0)),
    }


def count_stats(counts: DataFrame, keys: Sequence[str], windows: Mapping[str, str], item: str = "item") -> DataFrame:
    """The statistics of :func:`map_stats` straight from ``(keys, item, count)`` rows.

    ``windows`` maps an output prefix to a count column (several cumulative windows are
    served at once; an item with count 0 does not belong to the window). Only extremes,
    a count and a sum are kept per key, so nothing grows with the number of items.
    """
    aggs = []
    for i, n in enumerate(windows.values()):
        pair = F.when(F.col(n) > 0, F.struct((-F.col(n)).alias("neg"), F.col(item).alias("item")))
        aggs += [F.min(pair).alias(f"_top{i}"), F.max(pair).alias(f"_low{i}"),
                 F.count_if(F.col(n) > 0).cast("int").alias(f"_cnt{i}"), F.sum(n).alias(f"_sum{i}")]
    reduced = counts.groupBy(*keys).agg(*aggs)
    cols = []
    for i, prefix in enumerate(windows):
        several = F.col(f"_cnt{i}") > 1
        top_n, low_n = -F.col(f"_top{i}.neg"), F.when(several, -F.col(f"_low{i}.neg"))
        stats = {
            "most_item": F.col(f"_top{i}.item"), "least_item": F.when(several, F.col(f"_low{i}.item")),
            "unique": F.col(f"_cnt{i}"),
            "most_value": F.coalesce(top_n, F.lit(0)), "least_value": F.coalesce(low_n, F.lit(0)),
            "most_percent": F.coalesce(ratio(top_n, f"_sum{i}"), F.lit(0.0)),
            "least_percent": F.coalesce(ratio(low_n, f"_sum{i}"), F.lit(0.0)),
        }
        cols += [c.alias(f"{prefix}{s}") for s, c in stats.items()]
    return reduced.select(*keys, *cols)


def frequency_stats(df: DataFrame, keys: Sequence[str], col: str, prefix: str = "") -> DataFrame:
    return count_stats(frequency_counts(df, keys, col), keys, {prefix: "n"})


def unfold_counts(maps: DataFrame, keys: Sequence[str], name: str = "freq") -> DataFrame:
    """``(keys, item, n)`` from stored maps."""
    return maps.select(*keys, F.explode(name).alias("item", "n"))


def merge_frequency(left: DataFrame, right: DataFrame, keys: Sequence[str], name: str = "freq", top: int | None = None) -> DataFrame:
    """Two map tables with counts added key by key, through narrow rows."""
    return fold_counts(merge_counts([unfold_counts(m, keys, name) for m in (left, right)], keys), keys, name, top)


def value_entropy(df: DataFrame, keys: Sequence[str], col: str, name: str = "entropy") -> DataFrame:
    """Shannon entropy in bits of the observed values of ``col`` per key.

    Uses H = log2(N) - sum(n*log2(n))/N so that one re-aggregation of the reduced counts
    is enough and no join back to totals is needed.
    """
    counts = df.groupBy(*keys, col).agg(F.count(F.lit(1)).alias("_n"))
    whole = F.sum("_n")
    h = F.log2(whole) - F.sum(F.col("_n") * F.log2(F.col("_n"))) / whole
    return counts.groupBy(*keys).agg(h.alias(name))


def role_swap_stats(df: DataFrame, a: str, b: str, kind: str, value: str,
                    swapped: Mapping[str, str], symmetric: Sequence[str],
                    key: str = "msisdn",
                    stats: Sequence[str] = ("sum", "avg", "count", "min", "max", "std", "sumsq")) -> DataFrame:
    """Statistics per party and direction.

    ``swapped`` maps a record kind to the kind the other party sees (an outgoing record
    is an incoming one for ``b``); for ``symmetric`` kinds both parties see the same.
    Each record is exploded once into its (party, seen kind) pair, so one shuffle serves
    every kind.
    """
    seen = {**swapped, **{k: k for k in symmetric}}
    mirrored = F.create_map(*[F.lit(x) for pair in seen.items() for x in pair])
    roles = F.explode(F.array(
        F.struct(F.col(a).alias(key), F.col(kind).alias("_kind")),
        F.struct(F.col(b).alias(key), mirrored[F.col(kind)].alias("_kind")),
    ))
    kinds = list(seen)
    rows = (df.where(F.col(kind).isin(kinds))
              .select(roles.alias("_r"), F.col(value).cast("double").alias("_v"))
              .select(f"_r.{key}", "_r._kind", "_v"))
    return group_stats(rows, [key], {"": F.col("_v")}, stats,
                       {k: F.col("_kind") == k for k in kinds}, name="{filter}_{stat}{value}")


def two_party_features(df: DataFrame, sender: str, receiver: str, amount: str, day: str,
                       key: str = "msisdn", prefix: str = "money_transfer") -> tuple[DataFrame, list[Measure]]:
    """Per (party, role, day) totals of every record, and the measures that roll them up.

    Each record is exploded to its two parties and reduced per day at once, so the number
    of active days is a plain count of reduced rows, and no full outer join of a sender and
    a receiver table is needed.
    """
    parties = F.explode(F.array(F.struct(F.col(sender).alias(key), F.lit("sender").alias("role")),
                                F.struct(F.col(receiver).alias(key), F.lit("receiver").alias("role"))))
    rows = df.select(parties.alias("_r"), F.col(amount).alias("amount"), day).select(f"_r.{key}", "_r.role", "amount", day)
    daily = rows.groupBy(key, "role", day).agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("amount_sum"), F.max("amount").alias("amount_max"))
    measures = []
    for role in ("sender", "receiver"):
        w = f"role = '{role}'"
        measures += [
            Measure(f"{prefix}_{role}_count", "sum", "n", w), Measure(f"{prefix}_{role}_count_days", "rows", None, w),
            Measure(f"{prefix}_{role}_amount_sum", "sum", "amount_sum", w),
            Measure(f"{prefix}_{role}_amount_max", "max", "amount_max", w),
        ]
    return daily, measures
