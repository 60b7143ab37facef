"""Period roll-ups: daily -> weekly snapshots -> multi-week windows, and cumulative months.

A weekly snapshot with date D covers the days ``[D-7, D)``; the window ``lNw`` at D covers
the N snapshots in ``(D-7N, D]``, that is the days ``[D-7N, D)``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollspan.functions.calendar import YMD, as_date, ymd
from rollspan.functions.numeric import add_text, quoted, ratio, ratio_text
from rollspan.operators.aggregates import Measure, sliced_stats

WEEKS = (1, 4, 12, 24)


def lookback_start(snapshot: str, weeks: int) -> str:
    return ymd(as_date(snapshot) - timedelta(days=7 * weeks))


def lookback(df: DataFrame, day: str, snapshot: str, weeks: int = 24, back: str = "week_back",
             bands: Sequence[int] | None = None) -> DataFrame:
    """Rows of the last ``weeks`` weeks with the number of whole weeks before the snapshot.

    ``day`` is the ``yyyyMMdd`` string the table is partitioned by; the bounds are string
    literals so that partition pruning or parquet push-down applies. With ``bands`` (window
    lengths) the week is moved to the oldest one that lies in the same windows, so a
    grouping by it yields one row per window ring instead of one per week. That serves
    features computed in one go; stored weekly snapshots need real weeks.
    """
    d = as_date(snapshot)
    start = lookback_start(snapshot, weeks)
    age = F.datediff(F.lit(d), F.to_date(day, YMD)) - 1
    week = F.floor(age / 7).cast("int")
    if bands:
        ring = F.when(week < min(bands), min(bands) - 1)
        for n in sorted(bands)[1:]:
            ring = ring.when(week < n, n - 1)
        week = ring
    return df.where((F.col(day) >= start) & (F.col(day) < snapshot)).withColumn(back, week)


def weekly(df: DataFrame, keys: Sequence[str], day: str, snapshot: str,
           measures: Sequence[Measure], weeks: int = 24, bands: Sequence[int] | None = None) -> DataFrame:
    """One row per key and weekly snapshot (``week_back`` 0 is the newest week).

    This is the table to store per week: later snapshots only add one week to it.
    """
    return sliced_stats(lookback(df, day, snapshot, weeks, bands=bands), [*keys, "week_back"], measures)


def daily_to_weekly(daily: DataFrame, keys: Sequence[str], day: str, snapshot: str,
                    sums: Sequence[str], extremes: Mapping[str, str], weeks: int = 24,
                    bands: Sequence[int] | None = None) -> tuple[DataFrame, list[Measure]]:
    """Weekly rows from daily rows: sums, plus min/max of the daily sums.

    ``extremes`` maps a daily column to the template of its extreme, e.g.
    ``{"usage_total_cost_sum": "usage_total_cost_{op}"}`` gives ``..._dmin`` and ``..._dmax``.
    Also returns the measures that :func:`widen` needs.

    Daily rows are placed by key once; the weekly aggregate and :func:`widen` (with
    ``placed=True``) then run inside those partitions without another shuffle.
    """
    measures = [Measure(c, "sum", quoted(c)) for c in sums]
    for c, template in extremes.items():
        measures += [Measure(template.format(op="dmin"), "min", quoted(c)),
                     Measure(template.format(op="dmax"), "max", quoted(c))]
    placed = lookback(daily, day, snapshot, weeks, bands=bands).repartition(*keys)
    return sliced_stats(placed, [*keys, "week_back"], measures), measures


def widen(weeks_df: DataFrame, keys: Sequence[str], measures: Sequence[Measure],
          windows: Sequence[int] = WEEKS, name: str = "{stem}_l{n}w", placed: bool = False) -> DataFrame:
    """All windows of all measures from weekly rows in one shuffle.

    The narrow weekly rows are what is shuffled. Left to itself the aggregate would widen
    each week's row to all windows map-side, where weeks of one key rarely meet, and
    shuffle that. ``placed=True`` says that rows are already partitioned by key. A key has
    at most one row per week here, so no key can be hot.

    The longest window holds every key of the shorter ones, so what a full outer join of
    per-window tables would give comes out of one conditional aggregate: a key without
    rows in a window has NULL there.
    """
    aggs = [
        F.expr(f"{m.roll}(CASE WHEN week_back < {n} THEN {quoted(m.name)} END) AS {quoted(name.format(stem=m.name, n=n))}")
        for n in windows for m in measures
    ]
    rows = weeks_df.where(F.col("week_back") < max(windows))
    return (rows if placed else rows.repartition(*keys)).groupBy(*keys).agg(*aggs)


def widen_rings(rings: DataFrame, keys: Sequence[str], measures: Sequence[Measure],
                windows: Sequence[int] = WEEKS, name: str = "{stem}_l{n}w", placed: bool = False) -> DataFrame:
    """:func:`widen` for rows that are reduced to one per key and ring of weeks (``lookback`` with ``bands``).

    A key's rings are gathered into one array (at most one element per window), and each window is the sum, minimum or maximum of its
    rings as a plain expression; a mean is taken from the newest ring only. That replaces a conditional aggregate per measure and window, of which hundreds don't
    fit generated code.
    """
    windows = sorted(windows)
    rows = rings.where(F.col("week_back") < max(windows))
    fields = F.struct("week_back", *[F.col(quoted(m.name)) for m in measures])
    held = (rows if placed else rows.repartition(*keys)).groupBy(*keys).agg(F.collect_list(fields).alias("_rings"))
    held = held.select(*keys, *[F.expr(f"get(filter(_rings, r -> r.week_back = {n - 1}), 0) AS _r{i}") for i, n in enumerate(windows)])
    out = []
    for i, n in enumerate(windows):
        for m in measures:
            if i and m.roll is None:
                continue
            parts = [f"_r{k}.{quoted(m.name)}" for k in range(i + 1)]
            if not i:
                value = parts[0]
            elif m.roll == "sum":
                value = f"CASE WHEN coalesce({', '.join(parts)}) IS NOT NULL THEN {' + '.join(f'coalesce({p}, 0)' for p in parts)} END"
            else:
                value = f"{'least' if m.roll == 'min' else 'greatest'}({', '.join(parts)})"
            out.append(f"{value} AS {quoted(name.format(stem=m.name, n=n))}")
    return held.selectExpr(*[quoted(k) for k in keys], *out)


def window_stats(df: DataFrame, keys: Sequence[str], day: str, snapshot: str,
                 aggs: Mapping[str, tuple], windows: Sequence[int] = WEEKS) -> DataFrame:
    """Statistics taken straight from daily rows for each window: ``stem: (agg, value)``."""
    rows = lookback(df, day, snapshot, max(windows))
    return sliced_stats(rows, keys, [
        Measure(f"{stem}_l{n}w", agg, value, f"week_back < {n}")
        for n in windows for stem, (agg, value) in aggs.items()
    ])


def add_weighted_avg(df: DataFrame, averages: Mapping[str, tuple[str, str]],
                     windows: Sequence[int] = WEEKS, unit: str = "w") -> DataFrame:
    """``stem: (sum stem, count stem)`` -> re-weighted average per window."""
    return add_text(df, {
        f"{stem}_l{n}{unit}": ratio_text(f"{s}_l{n}{unit}", f"{c}_l{n}{unit}")
        for stem, (s, c) in averages.items() for n in windows
    })


def add_per_day(df: DataFrame, stems: Mapping[str, str], windows: Sequence[int] = WEEKS) -> DataFrame:
    """``new stem: sum stem`` -> window sum divided by the days of the window."""
    return add_text(df, {
        f"{new}_l{n}w": f"CAST({quoted(f'{stem}_l{n}w')} AS DOUBLE) / {7 * n}"
        for new, stem in stems.items() for n in windows
    })


def add_ratios(df: DataFrame, ratios: Mapping[str, tuple[str, str]],
               windows: Sequence[int] = WEEKS, unit: str = "w") -> DataFrame:
    """``stem: (part stem, whole stem)`` -> ratio inside each window."""
    return add_weighted_avg(df, ratios, windows, unit)


def trend_ratios(df: DataFrame, stems: Sequence[str], windows: Sequence[int] = WEEKS,
                 pairs: str = "all", unit: str = "w") -> DataFrame:
    """``stem_lXw_vs_lYw`` for each pair of windows; ``skip1`` leaves out neighbours."""
    gap = {"all": 1, "skip1": 2}[pairs]
    return add_text(df, {
        f"{stem}_l{x}{unit}_vs_l{y}{unit}": ratio_text(f"{stem}_l{x}{unit}", f"{stem}_l{y}{unit}")
        for stem in stems for i, x in enumerate(windows) for y in windows[i + gap:]
    })


def month_steps_rollup(monthly: DataFrame, keys: Sequence[str], step: str, stems: Sequence[str],
                       months: Sequence[int] = (2, 3, 6)) -> DataFrame:
    """k-month sum/min/max/avg of monthly sums; ``step`` is 0 for the newest snapshot."""
    aggs = []
    for k in (1, *months):
        for op in ("sum",) if k == 1 else ("sum", "min", "max", "avg"):
            aggs += [F.expr(f"{op}(CASE WHEN {step} < {k} THEN {quoted(s)} END) AS {quoted(s.removesuffix('_sum') + f'_{op}_l{k}m')}")
                     for s in stems]
    return monthly.repartition(*keys).groupBy(*keys).agg(*aggs)


def collapse(df: DataFrame, keys: Sequence[str], stems: Sequence[str], prefix: str = "pn_") -> DataFrame:
    """Sum finer-grained features up to ``keys`` (cell level to subscriber level)."""
    return df.groupBy(*keys).agg(*[F.expr(f"sum({quoted(c)}) AS {quoted(prefix + c)}") for c in stems])


def monthly_from_daily(daily: DataFrame, keys: Sequence[str], stems: Sequence[str],
                       zero_fill: bool = False, days: int | str | None = None) -> DataFrame:
    """Month totals from daily partials ``sum_/count_/min_/max_/sumsq_`` of each stem.

    ``zero_fill=True`` gives what densifying the key x day grid with zeros would give (a
    key missing on any of ``days`` days has min 0 at most and max 0 at least) without
    building that grid. ``days`` is a number or the column that holds it.
    """
    expected = F.max(days) if isinstance(days, str) else F.lit(days)
    absent = (F.count(F.lit(1)) < expected) if zero_fill and days else F.lit(False)
    aggs = []
    for s in stems:
        lo, hi = F.min(f"min_{s}"), F.max(f"max_{s}")
        if zero_fill:
            lo = F.min(F.coalesce(F.col(f"min_{s}"), F.lit(0.0)))
            hi = F.max(F.coalesce(F.col(f"max_{s}"), F.lit(0.0)))
        aggs += [
            F.sum(f"sum_{s}").alias(f"sum_{s}"), F.sum(f"count_{s}").alias(f"count_{s}"),
            ratio(F.sum(f"sum_{s}"), F.sum(f"count_{s}")).alias(f"avg_{s}"),
            F.when(absent, F.least(lo, F.lit(0.0))).otherwise(lo).alias(f"min_{s}"),
            F.when(absent, F.greatest(hi, F.lit(0.0))).otherwise(hi).alias(f"max_{s}"),
            F.sum(f"sumsq_{s}").alias(f"sumsq_{s}"),
        ]
    return daily.groupBy(*keys).agg(*aggs)


def month_index(day: Column, snapshot: str) -> Column:
    """1 for ``(D - 1 month, D]``, 2 for the month before, ...; NULL after the snapshot."""
    d = F.lit(as_date(snapshot))
    months = F.floor(F.months_between(d, day)).cast("int")
    # months_between treats two month ends as whole months; settle it on real bounds
    fixed = F.when(F.add_months(d, -months) < day, months - 1).otherwise(months)
    fixed = F.when(F.add_months(d, -(fixed + 1)) >= day, fixed + 1).otherwise(fixed)
    return F.when(day <= d, fixed + 1)


def cumulative_months(df: DataFrame, keys: Sequence[str], idx: str, stems: Sequence[str],
                      months: int = 6, start: int = 1) -> DataFrame:
    """T-start .. T-months running windows, one wide row per key.

    ``df`` has one row per key and month ``idx`` with ``sum_/count_/min_/max_/sumsq_``
    columns. Each window is a conditional aggregate over at most ``months`` rows, so the
    month-by-month join chain collapses into one shuffle. Absent months add nothing;
    variance is E[x^2] - E[x]^2 clamped at 0; ``ratio`` compares with the first window.
    """
    ts = list(range(start, months + 1))
    aggs = []
    for s in stems:
        for t in ts:
            for part, fn, empty in (("sum", "sum", "0D"), ("count", "sum", "0"), ("min", "min", None),
                                    ("max", "max", None), ("sumsq", "sum", "0D")):
                e = f"{fn}(CASE WHEN {idx} <= {t} THEN {quoted(f'{part}_{s}')} END)"
                aggs.append(F.expr(f"{f'coalesce({e}, {empty})' if empty else e} AS {quoted(f'{part}_{s}_T-{t}')}"))
    # at most ``months`` narrow rows per key travel; see widen()
    wide = df.where(F.col(idx) <= months).repartition(*keys).groupBy(*keys).agg(*aggs)
    derived = {}
    for s in stems:
        for t in ts:
            avg = ratio_text(f"sum_{s}_T-{t}", f"count_{s}_T-{t}")
            derived[f"avg_{s}_T-{t}"] = avg
            derived[f"std_{s}_T-{t}"] = f"sqrt(greatest({ratio_text(f'sumsq_{s}_T-{t}', f'count_{s}_T-{t}')} - {avg} * {avg}, 0D))"
            if t > start:
                derived[f"ratio_{s}_T-{t}"] = ratio_text(f"sum_{s}_T-{t}", f"sum_{s}_T-{start}")
    return add_text(wide, derived)


def cumulative_delta(df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str]) -> DataFrame:
    """Absolute change of month-to-date counters per step, one row per key and step.

    Rows of the same step are summed first (that also bounds the window to one row per
    step and key). The first step keeps its own value. Changes that are not positive
    become NULL so that aggregates skip them.
    """
    steps = df.groupBy(*keys, order).agg(*[F.sum(v).alias(v) for v in values])
    w = Window.partitionBy(*keys).orderBy(order)

    def delta(v):
        d = F.coalesce(F.abs(F.col(v) - F.lag(v, 1).over(w)), F.col(v))
        return F.when(d > 0, d).alias(v)
    return steps.select(*keys, order, *[delta(v) for v in values])
