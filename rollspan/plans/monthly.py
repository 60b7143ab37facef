"""Monthly families: T-1 .. T-6 cumulative windows of numeric and categorical facts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rollspan.functions.calendar import YMD, as_date, shift_months, ymd
from rollspan.functions.fixed_values import CHARGING_CATEGORIES, FINANCE_SENDERS
from rollspan.functions.text import sanitize
from rollspan.operators.aggregates import Measure, count_stats, role_swap_stats, sliced_stats
from rollspan.operators.joins import outer_merge, restrict
from rollspan.operators.rollups import cumulative_delta, cumulative_months, month_index, monthly_from_daily

from rollspan.session import with_scalars

PARTS = ("sum", "count", "min", "max", "sumsq")


def month_rows(raw: DataFrame, snapshot: str, months: int = 6, day: str = "s3_file_date", fmt: str = YMD) -> DataFrame:
    """Rows of the last ``months`` month windows with ``m``: 1 for the newest month."""
    first = ymd(shift_months(as_date(snapshot), -months))
    rows = raw.where((F.col(day) > first) & (F.col(day) <= snapshot))
    return rows.withColumn("m", month_index(F.to_date(day, fmt), snapshot))


def value_measures(values: Mapping[str, "Column | str"], where: Mapping[str, "Column | str | None"]) -> tuple[list[Measure], list[str]]:
    """sum/count/min/max/sum of squares of every value under every filter, with its stems."""
    stems, out = [], []
    for v, expr in values.items():
        for f, cond in where.items():
            stem = f"{v}_{f}"
            stems.append(stem)
            out += [Measure(f"{p}_{stem}", p, expr, cond) for p in PARTS]
    return out, stems


def daily_partials(rows: DataFrame, values, where, day: str = "s3_file_date", keys: Sequence[str] = ("msisdn",)) -> tuple[DataFrame, list[str]]:
    measures, stems = value_measures(values, where)
    return sliced_stats(rows, [*keys, day, "m"], measures), stems


def numeric_monthly(raw: DataFrame, snapshot: str, values: Mapping[str, "Column | str"],
                    where: Mapping[str, "Column | str | None"] | None = None, months: int = 6,
                    start: int = 1, day: str = "s3_file_date") -> DataFrame:
    """Cumulative month features straight from raw rows: one scan, months as a grouping key
    instead of a loop of monthly jobs and joins."""
    where = where or {"full": None}
    rows = month_rows(raw, snapshot, months, day)
    measures, stems = value_measures(values, where)
    monthly = sliced_stats(rows, ["msisdn", "m"], measures)
    return cumulative_months(monthly, ["msisdn"], "m", stems, months, start)


def numeric_monthly_daily(raw: DataFrame, snapshot: str, values, where=None, months: int = 6,
                          zero_fill: bool = False) -> DataFrame:
    """The same through stored daily partials (daily -> month -> cumulative). With
    ``zero_fill`` a month's minimum and maximum count inactive days as 0; the number of days
    is the number of dates present in the month over all subscribers."""
    where = where or {"full": None}
    rows = month_rows(raw, snapshot, months)
    daily, stems = daily_partials(rows, values, where)
    if not zero_fill:
        return cumulative_months(monthly_from_daily(daily, ["msisdn", "m"], stems), ["msisdn"], "m", stems, months)
    # one row: month -> number of dates present in it
    present = rows.select("m", "s3_file_date").distinct().groupBy("m").agg(F.count(F.lit(1)).alias("n"))
    dates = present.agg(F.map_from_entries(F.collect_list(F.struct("m", "n"))).alias("_dates"))
    sized = with_scalars(daily, dates).withColumn("_days", F.col("_dates")[F.col("m")]).drop("_dates")
    return cumulative_months(monthly_from_daily(sized, ["msisdn", "m"], stems, True, "_days"), ["msisdn"], "m", stems, months)


def recharge_monthly(raw: DataFrame, snapshot: str) -> DataFrame:
    return numeric_monthly(raw, snapshot, {"reillamount": "reillamount"}, RECHARGE_KINDS)


RECHARGE_KINDS = {"full": None, "refill": "module = 'RefillRecord'", "adjustment": "module = 'AdjustmentRecord'"}


def recharge_monthly_daily(raw: DataFrame, snapshot: str, zero_fill: bool = True) -> DataFrame:
    """Recharges through daily partials, where a day without a recharge (of the kind) counts as one of 0."""
    return numeric_monthly_daily(raw, snapshot, {"reillamount": "reillamount"}, RECHARGE_KINDS, zero_fill=zero_fill)


#: session values in minutes and megabytes
SESSION_UNITS = {"duration_minutes": "duration / 60", "data_volume_downlink_mb": "data_volume_downlink / 1000000",
                 "data_volume_uplink_mb": "data_volume_uplink / 1000000"}


def session_monthly(raw: DataFrame, snapshot: str) -> DataFrame:
    return numeric_monthly(raw, snapshot, SESSION_UNITS)


def category_name(category: str) -> str:
    """Name of a charging category in a column: letters and digits; the empty category is ``none``."""
    return "_".join("".join(c if c.isalnum() else " " for c in category).split()).lower() or "none"


def usage_monthly(raw: DataFrame, snapshot: str, categories: Sequence[str] = CHARGING_CATEGORIES) -> DataFrame:
    """Cost of usage in all and by charging category, all categories in one scan."""
    by_category = {category_name(c): "chargingcategoryname = '{}'".format(c.replace("'", "''")) for c in categories}
    return numeric_monthly(raw, snapshot, {"totalcost": "totalcost"}, {"full": None, **by_category})


def calls_monthly(raw: DataFrame, snapshot: str, members: DataFrame | None = None, months: int = 6,
                  value: str = "call_duration") -> DataFrame:
    """Both parties' call statistics per seen kind, month by month; ``members`` restricts
    to subscribers of the network."""
    kinds = {"MOC": "MTC", "MTC": "MOC", "SMO": "SMT", "SMT": "SMO"}
    rows = month_rows(raw, snapshot, months)
    parts = role_swap_stats(rows.withColumn("_a", F.struct("msisdn", "m")).withColumn("_b", F.struct(F.col("party_number").alias("msisdn"), "m")),
                            "_a", "_b", "call_type", value, kinds, ["ROA", "CF"], "_k", PARTS)
    stems = ["MOC", "MTC", "SMO", "SMT", "ROA", "CF"]
    monthly = parts.select("_k.msisdn", "_k.m", *[F.col(f"{k}_{p}").alias(f"{p}_{k}") for k in stems for p in PARTS])
    if members is not None:
        monthly = restrict(monthly, members, "msisdn")
    return cumulative_months(monthly, ["msisdn"], "m", stems, months)


def transfers_monthly(raw: DataFrame, snapshot: str, months: int = 6) -> DataFrame:
    """Amounts sent and received, cumulative months."""
    parties = F.explode(F.array(F.struct(F.col("sender").alias("msisdn"), F.lit("sender").alias("role")),
                                F.struct(F.col("receiver").alias("msisdn"), F.lit("receiver").alias("role"))))
    rows = raw.select(parties.alias("_p"), "amount", "s3_file_date").select("_p.msisdn", "_p.role", "amount", "s3_file_date")
    return numeric_monthly(rows, snapshot, {"amount": "amount"},
                           {"sender": "role = 'sender'", "receiver": "role = 'receiver'"}, months)


def billing_monthly(raw: DataFrame, snapshot: str, values: Sequence[str], months: int = 6, start: int = 3) -> DataFrame:
    """Bill lines by ``yyyyMM``: month T-n is n calendar months back; bills close late, so
    windows start at T-3."""
    d = as_date(snapshot)
    wanted = {ymd(shift_months(d.replace(day=1), -n))[:6]: n for n in range(start, months + 1)}
    index = F.create_map(*[F.lit(x) for pair in wanted.items() for x in pair])
    rows = raw.where(F.col("s3_file_date").isin(list(wanted))).withColumn("m", index[F.col("s3_file_date")])
    measures, stems = value_measures({v: v for v in values}, {"full": None})
    monthly = sliced_stats(rows, ["msisdn", "m"], measures)
    return cumulative_months(monthly, ["msisdn"], "m", stems, months, start)


def revenue_monthly(raw: DataFrame, snapshot: str, measures: Sequence[str], months: int = 6) -> DataFrame:
    """Cumulative months of the daily increments of month-to-date counters, all measures in one scan.

    The lag runs inside a month window, so every month starts with its own first value.
    """
    measures = list(measures)
    rows = month_rows(raw.select(F.col("accs_mthd_key").alias("msisdn"), "s3_file_date", *measures), snapshot, months)
    deltas = cumulative_delta(rows, ["msisdn", "m"], "s3_file_date", measures)
    specs, stems = value_measures({v: F.col(v) for v in measures}, {"full": None})
    return cumulative_months(sliced_stats(deltas, ["msisdn", "m"], specs), ["msisdn"], "m", stems, months)


def categorical_monthly(raw: DataFrame, snapshot: str, col: "Column | str", prefix: str, months: int = 6) -> DataFrame:
    """Most/least frequent item statistics over T-1 .. T-n.

    Counts per (subscriber, item) of every cumulative window come from one aggregate, the
    statistics of all windows from a second one over those reduced rows.
    """
    rows = month_rows(raw, snapshot, months).withColumn("item", (F.col(col) if isinstance(col, str) else col).cast("string"))
    counts = rows.where(F.col("item").isNotNull()).groupBy("msisdn", "item").agg(
        *[F.count(F.when(F.col("m") <= t, 1)).alias(f"n{t}") for t in range(1, months + 1)])
    return count_stats(counts, ["msisdn"], {f"{prefix}_T-{t}_": f"n{t}" for t in range(1, months + 1)})


def province_monthly(raw: DataFrame, snapshot: str) -> DataFrame:
    return categorical_monthly(raw, snapshot, "province", "province")


def package_monthly(raw: DataFrame, snapshot: str, months: int = 6) -> DataFrame:
    """Last action and service code frequencies plus the count of rows not marked active."""
    parts = [categorical_monthly(raw, snapshot, c, c, months) for c in ("last_action", "service_code")]
    rows = month_rows(raw, snapshot, months)
    inactive = rows.groupBy("msisdn").agg(*[
        F.count_if((F.col("active") != "Y") & (F.col("m") <= t)).alias(f"not_active_T-{t}") for t in range(1, months + 1)])
    return outer_merge([*parts, inactive], ["msisdn"])


def sender_monthly(raw: DataFrame, snapshot: str, months: int = 6) -> DataFrame:
    """Sender frequencies over all senders and over the finance senders."""
    named = raw.withColumn("sender_key", sanitize("sender"))
    finance = [s.upper().replace(" ", "") for s in FINANCE_SENDERS]
    return outer_merge([
        categorical_monthly(named, snapshot, "sender_key", "sender", months),
        categorical_monthly(named.where(F.col("sender_key").isin(finance)), snapshot, "sender_key", "finance", months),
    ], ["msisdn"])
