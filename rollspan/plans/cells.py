"""Cell-level families: events joined to the cell map, keyed by (msisdn, bts_id), and
their roll-up to the subscriber."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, functions as F

from rollspan.functions.calendar import as_date, ymd
from rollspan.functions.fixed_values import CALL_KINDS, SMS_KINDS, VOLTE_KINDS
from rollspan.functions.numeric import quoted
from rollspan.functions.text import part_of
from rollspan.operators.aggregates import Measure, sliced_stats, slices
from rollspan.operators.joins import enrich, restrict, spread_join
from rollspan.operators.rollups import WEEKS, add_ratios, collapse, lookback, trend_ratios, widen_rings
from rollspan.operators.windows import keep_max
from rollspan.plans.family import Family
from rollspan.plans.weekly import (
    ALL_PARTS, _air_rows, _by_day, add_call_totals, call_measures, call_ratios, session_measures, session_rows,
    usage_measures, usage_rows, volte_measures, volte_ratios,
)

KEYS = ("msisdn", "bts_id")


def cell_map(raw: DataFrame, month_first: str) -> DataFrame:
    """(lac, cell_id) -> bts_id as of the last 10 days before ``month_first``; per
    (bts_id, lac, cell_id) only its newest rows, each once."""
    end = as_date(month_first).replace(day=1)
    start = ymd(end - timedelta(days=10))
    rows = raw.select("lac", F.col("ci").alias("cell_id"), F.col("bts_name").alias("bts_id"), "s3_file_date").where(
        (F.col("s3_file_date") >= start) & (F.col("s3_file_date") < ymd(end)))
    return keep_max(rows, ["bts_id", "lac", "cell_id"], "s3_file_date").distinct()


def at_cells(events: DataFrame, cells: DataFrame, heavy_share: float | None = None) -> DataFrame:
    """Events with a known cell; unmapped ones are dropped.

    A cell map that Spark can broadcast needs nothing more. With ``heavy_share``, cells with more than that share of the events are spread over
    several tasks (see :func:`spread_join`), for maps that are too large to be broadcast.
    """
    mapping = cells.where(F.col("bts_id").isNotNull()).select("lac", "cell_id", "bts_id")
    if heavy_share is not None:
        return spread_join(events, mapping, ["lac", "cell_id"], share=heavy_share)
    return enrich(events, mapping, ["lac", "cell_id"], "inner")


def with_cell_parts(df: DataFrame, cell: str) -> DataFrame:
    """``a-b-lac-cell`` ids split into their parts; rows without a cell are dropped."""
    return df.where(F.col(cell) != "").withColumns({"lac": part_of(cell, "-", 3), "cell_id": part_of(cell, "-", 4)})


def reduced_at_cells(rows: DataFrame, cells: DataFrame, by: Sequence[str], measures: Sequence[Measure],
                     heavy_share: float | None = None) -> DataFrame:
    """All measures per (msisdn, bts_id) and ``by`` of rows with ``lac`` and ``cell_id``.

    A cell may belong to many stations, so rows are reduced per cell before they meet the map: the map multiplies a few rows per subscriber and cell,
    not events. The reduced rows are placed by subscriber first. A map that Spark broadcasts leaves them there, and so all that groups
    by subscriber afterwards runs in place. The number of partitions is set, since merging them by the size of the reduced rows would
    make tasks that are too large once the rows are multiplied.
    """
    per_cell = sliced_stats(rows, ["msisdn", "lac", "cell_id", *by], measures)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = at_cells(per_cell.repartition(parts, "msisdn"), cells, heavy_share)
    return sliced_stats(placed, [*KEYS, *by], [Measure(m.name, m.roll, quoted(m.name)) for m in measures])


def cell_features(family: Family, events: DataFrame, cells: DataFrame, snapshot: str, windows: Sequence[int] = WEEKS,
                  heavy_share: float | None = None) -> DataFrame:
    """:meth:`Family.features` per (msisdn, bts_id) of events with ``lac`` and ``cell_id``."""
    rows = lookback(family.prepare(events), family.day, snapshot, max(windows), bands=windows)
    rings = reduced_at_cells(rows, cells, ["week_back"], family.measures, heavy_share)
    return family.finish(widen_rings(rings, KEYS, family.stored, windows, placed=True), windows)


def _keep(wide: DataFrame, windows: Sequence[int]) -> DataFrame:
    return wide


RECHARGE_MEASURES = [*slices(Measure("bts_recharge_count", "rows"), ALL_PARTS),
                     *slices(Measure("bts_recharge_sum", "sum", "amount"), ALL_PARTS)]
BTS_AIR = Family("bts_air", _air_rows, RECHARGE_MEASURES, _keep, KEYS)

BTS_SESSION_MEASURES = session_measures("bts_ggsn", extremes=False)
BTS_GGSN = Family("bts_ggsn", session_rows, BTS_SESSION_MEASURES, _keep, KEYS)

BTS_USAGE_MEASURES = usage_measures("bts_usage")


def bts_usage(events: DataFrame, cells: DataFrame, snapshot: str, windows: Sequence[int] = WEEKS,
              heavy_share: float | None = None) -> DataFrame:
    """Sums per window plus the mean over active days of the newest week.

    Days are kept apart in the newest week only; older rows are reduced to their ring of weeks.
    """
    bands = sorted({1, *windows})
    rows = lookback(usage_rows(events), "s3_file_date", snapshot, max(bands), bands=bands)
    rows = rows.withColumn("active_day", F.when(F.col("week_back") < 1, F.col("s3_file_date")))
    days = reduced_at_cells(rows, cells, ["week_back", "active_day"], BTS_USAGE_MEASURES, heavy_share)
    names = [m.name for m in BTS_USAGE_MEASURES]
    means = {c: c.replace("count", "count_davg").replace("sum", "sum_davg") for c in names}
    stored = [*[Measure(c, "sum", c) for c in names], *[Measure(d, "avg", c) for c, d in means.items()]]
    rings = sliced_stats(days, [*KEYS, "week_back"], stored)
    kept = [f"{c}_l{n}w" for n in windows for c in names] + [f"{d}_l1w" for d in means.values()]
    return widen_rings(rings, KEYS, stored, bands, placed=True).select(*KEYS, *kept)


BTS_VOICE_MEASURES = call_measures("bts_voice", not_answered=False)
BTS_VOLTE_MEASURES = volte_measures("bts_volte")


def _bts_voice_finish(wide: DataFrame, windows: Sequence[int]) -> DataFrame:
    out, totals = add_call_totals(wide, "bts_voice", list(CALL_KINDS), list(SMS_KINDS), windows, False)
    return trend_ratios(out, [*[m.name for m in BTS_VOICE_MEASURES], *totals], windows, "skip1")


def _bts_volte_finish(wide: DataFrame, windows: Sequence[int]) -> DataFrame:
    out, totals = add_call_totals(wide, "bts_volte", list(VOLTE_KINDS), [], windows, False)
    ratios = volte_ratios("bts_volte")
    out = add_ratios(out, ratios, windows)
    return trend_ratios(out, [*[m.name for m in BTS_VOLTE_MEASURES], *totals, *ratios], windows, "skip1")


BTS_VOICE = Family("bts_voice", _by_day, BTS_VOICE_MEASURES, _bts_voice_finish, KEYS)
BTS_VOLTE = Family("bts_volte", _by_day, BTS_VOLTE_MEASURES, _bts_volte_finish, KEYS)


def to_subscriber(cell_features: DataFrame, stems: Sequence[str], ratios: dict, pairs: str,
                  population: DataFrame | None = None, windows: Sequence[int] = WEEKS,
                  extra: Sequence[str] = ()) -> DataFrame:
    """Cell rows summed per subscriber, then ratios and trends of the sums.

    ``extra`` are stems that exist for the newest window only.
    """
    rows = cell_features if population is None else restrict(cell_features, population, "msisdn")
    cols = [f"{s}_l{n}w" for n in windows for s in stems] + [f"{s}_l1w" for s in extra]
    out = collapse(rows, ["msisdn"], cols)
    pn = {f"pn_{k}": (f"pn_{a}", f"pn_{b}") for k, (a, b) in ratios.items()}
    return trend_ratios(add_ratios(out, pn, windows), [*[f"pn_{s}" for s in stems], *pn], windows, pairs)


def pn_air(bts: DataFrame, population: DataFrame | None = None, windows: Sequence[int] = WEEKS) -> DataFrame:
    ratios = {f"bts_recharge_{m}_{s}_ratio": (f"bts_recharge_{m}_{s}", f"bts_recharge_{m}")
              for m in ("count", "sum") for s in ("nt", "wk")}
    return to_subscriber(bts, [m.name for m in RECHARGE_MEASURES], ratios, "all", population, windows)


def pn_ggsn(bts: DataFrame, population: DataFrame | None = None, windows: Sequence[int] = WEEKS) -> DataFrame:
    ratios = {f"bts_ggsn_duration_count_ratio_{k}": (f"bts_ggsn_duration_count_{k}", "bts_ggsn_duration_count")
              for k in ("over_5mins", "under_30secs")}
    return to_subscriber(bts, [m.name for m in BTS_SESSION_MEASURES], ratios, "skip1", population, windows)


def pn_usage(bts: DataFrame, population: DataFrame | None = None, windows: Sequence[int] = WEEKS) -> DataFrame:
    ratios = {f"bts_usage_count_{s}_ratio": (f"bts_usage_count_{s}", "bts_usage_count") for s in ("nt", "wk")}
    return to_subscriber(bts, [m.name for m in BTS_USAGE_MEASURES], ratios, "skip1", population, windows)


def pn_voice(bts: DataFrame, population: DataFrame | None = None, windows: Sequence[int] = WEEKS) -> DataFrame:
    totals = [f"bts_voice_total_{k}{s}_count" for k in ("call", "sms") for s in ("", "_wk", "_wd")] + ["bts_voice_total_count"]
    return to_subscriber(bts, [*[m.name for m in BTS_VOICE_MEASURES], *totals], call_ratios("bts_voice", False),
                         "skip1", population, windows)


def pn_volte(bts: DataFrame, population: DataFrame | None = None, windows: Sequence[int] = WEEKS) -> DataFrame:
    totals = [f"bts_volte_total_call{s}_count" for s in ("", "_wk", "_wd")]
    return to_subscriber(bts, [*[m.name for m in BTS_VOLTE_MEASURES], *totals], volte_ratios("bts_volte"),
                         "skip1", population, windows)


def stamped(df: DataFrame, run_time: str) -> DataFrame:
    """Rows marked with the time of the run, for append-mode targets."""
    return df.withColumn("run_time", F.lit(run_time))
