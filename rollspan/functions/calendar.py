"""Calendar slices, safe timestamps, period lists and snapshot arithmetic."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

YMD = "yyyyMMdd"


def as_date(ymd: str) -> date:
    return datetime.strptime(ymd, "%Y%m%d").date()


def ymd(day: date) -> str:
    return day.strftime("%Y%m%d")


def shift_months(day: date, months: int) -> date:
    """Move by whole months, clamping to the last day of a shorter month."""
    index = day.year * 12 + day.month - 1 + months
    year, month = divmod(index, 12)
    first_next = date(year + (month == 11), (month + 1) % 12 + 1, 1)
    return date(year, month + 1, min(day.day, (first_next - timedelta(days=1)).day))


def is_weekend(ts: Column) -> Column:
    return F.dayofweek(ts).isin(1, 7)


def calendar_slices(df: DataFrame, ts: str, legacy_hour12: bool = False) -> DataFrame:
    """Add ``is_wk``, ``hour``, ``time_slot`` (nt/mo/af_ev) and ``time_slot_grp`` (dt/nt).

    ``legacy_hour12`` reproduces features that were once built with a 12-hour clock
    pattern: 13:00 counts as hour 1 and midnight as hour 12.
    """
    hour = F.hour(ts)
    if legacy_hour12:
        hour = F.when(hour % 12 == 0, F.lit(12)).otherwise(hour % 12)
    morning, day_end = hour.between(6, 11), hour.between(12, 17)
    return df.withColumns({
        "is_wk": is_weekend(F.col(ts)),
        "hour": hour,
        "time_slot": F.when(morning, "mo").when(day_end, "af_ev").when(hour.isNotNull(), "nt"),
        "time_slot_grp": F.when(morning | day_end, "dt").otherwise("nt"),
    })


def safe_ts(col: Column | str, formats: list[str], default: str | None = None) -> Column:
    """First format that parses wins; unparsable text becomes ``default`` (or NULL)."""
    text = F.col(col) if isinstance(col, str) else col
    tries = [F.try_to_timestamp(text, F.lit(f)) for f in formats]
    if default is not None:
        tries.append(F.lit(default).cast("timestamp"))
    return F.coalesce(*tries)


def days_between(start: Column, end: Column) -> Column:
    """Fractional days from ``start`` to ``end``."""
    return (F.unix_timestamp(end) - F.unix_timestamp(start)) / F.lit(86400)


def years_since(day: Column, asof: str) -> Column:
    return F.datediff(F.lit(as_date(asof)), day) / F.lit(365)


def snapshot_windows(snapshot: str) -> dict[str, tuple[str, str]]:
    """Named ``[from, to)`` bounds of a snapshot as ``yyyyMMdd`` strings.

    ``month`` is ``[D - 1 month + 1 day, D]``; ``bill`` is the one billing month that is
    complete at D (two months back from day 15 on, else three) as ``yyyyMM``.
    """
    d = as_date(snapshot)
    out = {f"l{n}w": (ymd(d - timedelta(days=7 * n)), snapshot) for n in (1, 4, 12, 24)}
    out["month"] = (ymd(shift_months(d, -1) + timedelta(days=1)), ymd(d + timedelta(days=1)))
    bill = ymd(shift_months(d, -2 if d.day >= 15 else -3))[:6]
    out["bill"] = (bill, bill)
    return out


def month_steps(snapshot: str, months: int) -> list[str]:
    """Snapshots that stand for the last ``months`` months: D, D-4 weeks, D-8 weeks, ..."""
    d = as_date(snapshot)
    return [ymd(d - timedelta(weeks=4 * i)) for i in range(months)]


def period_calendar(spark: SparkSession, start: str, end: str, freq: str) -> DataFrame:
    """``run_date`` rows: every day in ``[start, end)``, or every Monday in ``[start, end]``."""
    first, last = as_date(start), as_date(end)
    if freq == "daily":
        last, step = last - timedelta(days=1), "interval 1 day"
    elif freq == "weekly":
        first, step = first + timedelta(days=-first.weekday() % 7), "interval 7 days"
    else:
        raise ValueError(f"unknown frequency {freq!r}")
    if first > last:
        return spark.createDataFrame([], "run_date string")
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last), F.expr(step))).alias("d"))
    return days.select(F.date_format("d", YMD).alias("run_date"))


def periods_of(df: DataFrame, day: str, freq: str) -> DataFrame:
    """The same calendar over the date range a table covers (``day`` is ``yyyyMMdd``)."""
    ends = df.agg(F.to_date(F.min(day), YMD).alias("a"), F.to_date(F.max(day), YMD).alias("b"))
    if freq == "daily":
        first, last, step = F.col("a"), F.date_sub("b", 1), "interval 1 day"
    else:
        first, last, step = F.next_day(F.date_sub("a", 1), "MON"), F.col("b"), "interval 7 days"
    days = ends.select(F.explode(F.when(first <= last, F.sequence(first, last, F.expr(step)))).alias("d"))
    return days.select(F.date_format("d", YMD).alias("run_date"))


def snapshot_bounds(df: DataFrame, day: str) -> DataFrame:
    """``from`` bounds of every window and the complete billing month per snapshot row."""
    d = F.to_date(day, YMD)
    bounds = {f"l{n}w_from": F.date_format(F.date_sub(d, 7 * n), YMD) for n in (1, 4, 12, 24)}
    bounds["month_from"] = F.date_format(F.date_add(F.add_months(d, -1), 1), YMD)
    bounds["bill_month"] = F.date_format(F.add_months(d, F.when(F.dayofmonth(d) >= 15, -2).otherwise(-3)), "yyyyMM")
    return df.withColumns(bounds)
