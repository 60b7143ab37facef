"""Weekly families of event tables keyed by subscriber."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rollspan.functions.calendar import YMD, calendar_slices, days_between, is_weekend, safe_ts
from rollspan.functions.fixed_values import (
    ACCOUNT_UNIT, CALL_KINDS, LAST_ACTION, PACKAGE_PURPOSE, SENDER_CATEGORIES, SENDER_CATEGORY, SMS_KINDS,
    TENURE, TENURE_LAST, USAGE_SERVICES, VAS_CATEGORIES, VAS_CATEGORY, VOLTE_KINDS,
)
from rollspan.functions.numeric import add_text, pair_ratios, share_entropy, total_text
from rollspan.functions.text import like_rules, map_ids, regex_rules, threshold_rules, tidy
from rollspan.operators.aggregates import Measure, slices, two_party_features
from rollspan.operators.rollups import WEEKS, add_per_day, add_ratios, lookback_start, trend_ratios, weekly, widen
from rollspan.plans.family import Family

STAMP = "yyyyMMddHHmmss"
USAGE_STAMP = "yyyyMMdd'T'HH:mm:ss"

WEEK_PART = {"wk": "is_wk", "wd": "NOT is_wk"}
DAY_PART = {"dt": "time_slot_grp = 'dt'", "nt": "time_slot_grp = 'nt'"}
ALL_PARTS = {**WEEK_PART, **DAY_PART}


def _timed(df: DataFrame, column: str, fmt: str) -> DataFrame:
    return calendar_slices(df.withColumn("ts", F.try_to_timestamp(F.col(column), F.lit(fmt))), "ts")


def _by_day(df: DataFrame) -> DataFrame:
    return df.withColumn("is_wk", is_weekend(F.to_date("s3_file_date", YMD)))


# --- recharges ---------------------------------------------------------------------------

def _air_rows(raw: DataFrame) -> DataFrame:
    return _timed(raw.withColumn("amount", F.col("reillamount") / 1000), "origintimestamp", STAMP)


_AIR_KINDS = {"adjustment": "module = 'AdjustmentRecord'", "refill": "module = 'RefillRecord'"}
AIR_MEASURES = [
    *slices(Measure("air_balance_update_count", "rows"), ALL_PARTS),
    *slices(Measure("air_balance_update_sum", "sum", "amount"), ALL_PARTS),
    *[Measure(f"air_{kind}_{op}", agg, "amount", cond)
      for kind, cond in _AIR_KINDS.items() for op, agg in (("sum", "sum"), ("min", "min"), ("max", "max"), ("count", "rows"))],
    Measure("air_use_voucher_count", "rows", None, "vouchergroup IS NOT NULL AND vouchergroup <> ''"),
]
_AIR_RATIOS = {
    **{f"air_balance_update_{m}_{s}_ratio": (f"air_balance_update_{m}_{s}", f"air_balance_update_{m}")
       for m in ("count", "sum") for s in ("nt", "wk")},
    **{f"air_{k}_ratio": (f"air_{k}_count", "air_balance_update_count") for k in ("use_voucher", "adjustment", "refill")},
}


def _air_finish(wide: DataFrame, windows: Sequence[int]) -> DataFrame:
    averages = {f"air_{k}_avg": (f"air_{k}_sum", f"air_{k}_count") for k in _AIR_KINDS}
    stems = [m.name for m in AIR_MEASURES if m.agg not in ("min", "max")] + list(_AIR_RATIOS)
    return trend_ratios(add_ratios(wide, {**averages, **_AIR_RATIOS}, windows), stems, windows)


AIR = Family("air", _air_rows, AIR_MEASURES, _air_finish)


# --- package subscriptions -----------------------------------------------------------------

def package_rows(raw: DataFrame) -> DataFrame:
    """Categories of a package row; ``time_end = 'null'`` counts as the 1970 sentinel."""
    start, end = safe_ts("time_start", [STAMP]), safe_ts("time_end", [STAMP], "1970-01-01 00:00:00")
    return raw.withColumns({
        "usage_category": like_rules("service_id", PACKAGE_PURPOSE, "other"),
        "package_duration_days": days_between(start, end),
        "action_category": map_ids("last_action", LAST_ACTION, "other"),
    }).withColumn("tenure", threshold_rules("package_duration_days", TENURE, TENURE_LAST))


PACKAGE_GROUPS = {
    **{c: f"usage_category = '{c}'" for c in ("family", "office", "public", "relax", "other")},
    **{t: f"tenure = '{t}'" for t in ("one_day", "few_days", "few_weeks", "few_months", "long_term")},
}
_ACTIONS = {"active": "action_category = 'active'", "cancel": "action_category = 'cancel'"}


def _grouped(cond: str, group: str):
    return [Measure(f"3gsub_{group}_count", "hits", None, cond)] + [
        Measure(f"3gsub_{group}_{a}_count", "sum", f"CASE WHEN {test} THEN 1 ELSE 0 END", cond) for a, test in _ACTIONS.items()]


PACKAGE_MEASURES = [
    Measure("3gsub_action_count", "rows"),
    *[Measure(f"3gsub_{a}_count", "rows", None, test) for a, test in _ACTIONS.items()],
    *[m for g, cond in PACKAGE_GROUPS.items() for m in _grouped(cond, g)],
]


def _package_finish(wide: DataFrame, windows: Sequence[int]) -> DataFrame:
    pct = {}
    for g in PACKAGE_GROUPS:
        pct[f"3gsub_{g}_pct"] = (f"3gsub_{g}_count", "3gsub_action_count")
        for a in _ACTIONS:
            pct[f"3gsub_{g}_{a}_pct"] = (f"3gsub_{g}_{a}_count", f"3gsub_{a}_count")
    return trend_ratios(add_ratios(wide, pct, windows), [m.name for m in PACKAGE_MEASURES], windows)


PACKAGES = Family("3gsub", package_rows, PACKAGE_MEASURES, _package_finish)


# --- branded messages ------------------------------------------------------------------------

def _brand_rows(raw: DataFrame) -> DataFrame:
    return raw.withColumn("category", regex_rules(tidy("sender"), SENDER_CATEGORY, "other"))


BRAND_MEASURES = [
    Measure("brandname_sms_count", "rows"),
    *[Measure(f"brandname_sms_count_{c}", "rows", None, f"category = '{c}'") for c in SENDER_CATEGORIES],
]


def _brand_finish(wide: DataFrame, windows: Sequence[int]) -> DataFrame:
    pct = {f"brandname_sms_pct_{c}": (f"brandname_sms_count_{c}", "brandname_sms_count") for c in SENDER_CATEGORIES}
    out = add_ratios(wide, pct, windows)
    for n in windows:
        out = pair_ratios(out, {c: f"brandname_sms_pct_{c}_l{n}w" for c in SENDER_CATEGORIES},
                          "brandname_sms_pct_{a}_vs_{b}" + f"_l{n}w")
    out = out.withColumns({
        f"brandname_entropy_l{n}w": F.when(
            F.col(f"brandname_sms_count_l{n}w").isNotNull(),
            share_entropy([f"brandname_sms_pct_{c}_l{n}w" for c in SENDER_CATEGORIES]))
        for n in windows})
    return trend_ratios(out, [*[m.name for m in BRAND_MEASURES], "brandname_entropy"], windows)


BRANDS = Family("brandname", _brand_rows, BRAND_MEASURES, _brand_finish)


# --- data sessions ---------------------------------------------------------------------------

SESSION_VALUES = ("duration", "data_volume_downlink", "data_volume_uplink")


def session_rows(raw: DataFrame) -> DataFrame:
    """Weekend by file date, day slot by the opening time, duration also in minutes."""
    return _by_day(calendar_slices(raw, "record_opening_time").withColumn("duration_minutes", F.col("duration") / 60))


def session_measures(prefix: str, extremes: bool = True) -> list[Measure]:
    out = []
    for v in SESSION_VALUES:
        out += [Measure(f"{prefix}_{v}_sum", "sum", v), Measure(f"{prefix}_{v}_count", "count", v)]
        if extremes:
            out += [Measure(f"{prefix}_{v}_min", "min", v), Measure(f"{prefix}_{v}_max", "max", v)]
        out += slices(Measure(f"{prefix}_{v}_sum", "sum", v), ALL_PARTS, f"{prefix}_{v}_{{slice}}_sum")[1:]
    return out + [
        Measure(f"{prefix}_duration_count_over_5mins", "rows", None, "duration_minutes > 5"),
        Measure(f"{prefix}_duration_count_under_30secs", "rows", None, "duration_minutes < 0.5"),
        Measure(f"{prefix}_wk_count", "rows", None, "is_wk"),
        Measure(f"{prefix}_wd_count", "rows", None, "NOT is_wk"),
        Measure(f"{prefix}_downlink_count", "rows", None, "coalesce(data_volume_downlink <> 0, true)"),
        Measure(f"{prefix}_uplink_count", "rows", None, "coalesce(data_volume_uplink <> 0, true)"),
    ]


SESSION_MEASURES = session_measures("ggsn")
_SESSION_RATIOS = {
    f"ggsn_duration_count_ratio_{k}": (f"ggsn_duration_count_{k}", "ggsn_duration_count")
    for k in ("over_5mins", "under_30secs")}


def _session_finish(wide: DataFrame, windows: Sequence[int]) -> DataFrame:
    stems = [m.name for m in SESSION_MEASURES] + list(_SESSION_RATIOS)
    return trend_ratios(add_ratios(wide, _SESSION_RATIOS, windows), stems, windows)


SESSIONS = Family("ggsn", session_rows, SESSION_MEASURES, _session_finish)


# --- usage records -----------------------------------------------------------------------------

def usage_rows(raw: DataFrame) -> DataFrame:
    return _timed(raw.withColumn("cost", F.col("totalcost") / 1000), "originaltimestamp", USAGE_STAMP)


def usage_measures(prefix: str) -> list[Measure]:
    """Counts per service and sliced sums of what the service is charged by."""
    out = [*slices(Measure(f"{prefix}_count", "rows"), ALL_PARTS),
           *slices(Measure(f"{prefix}_call_duration_sum", "sum", "duration"), ALL_PARTS),
           *slices(Measure(f"{prefix}_total_cost_sum", "sum", "cost"), ALL_PARTS)]
    values = {"sms": {}, "voice": {"voice_duration": "duration"}, "voip": {"voice_voip_duration": "duration"},
              "video": {"video_duration": "duration"}, "data": {"data_volume": "volume"}}
    cost = {"voip": "voice_voip_total_cost"}
    for service, names in USAGE_SERVICES.items():
        cond = "servicename IN ({})".format(", ".join(f"'{n}'" for n in names))
        out.append(Measure(f"{prefix}_{service}_count", "hits", None, cond))
        for stem, value in {**values[service], cost.get(service, f"{service}_total_cost"): "cost"}.items():
            out += slices(Measure(f"{prefix}_{stem}_sum", "sum", value, cond), ALL_PARTS)
    return out


USAGE_MEASURES = usage_measures("usage")
_SUMS = [m.name for m in USAGE_MEASURES if "_sum" in m.name]
_USAGE_EXTREMES = {s: s.replace("_sum", "_{op}") for s in _SUMS}


def _usage_finish(wide: DataFrame, windows: Sequence[int]) -> DataFrame:
    return add_per_day(wide, {s.replace("_sum", "_davg"): s for s in _SUMS}, windows)


USAGE = Family("usage", usage_rows, USAGE_MEASURES, _usage_finish, extremes=_USAGE_EXTREMES)


# --- dedicated accounts --------------------------------------------------------------------------

def _account_rows(raw: DataFrame) -> DataFrame:
    return _timed(raw.withColumn("unit_type", map_ids("dedicatedaccountid", ACCOUNT_UNIT, "others")),
                  "originaltimestamp", USAGE_STAMP)


ACCOUNT_MEASURES = []
for _u in ("money", "time", "data", "sms"):
    ACCOUNT_MEASURES += slices(Measure(f"usageda_{_u}_count", "hits", None, f"unit_type = '{_u}'"), ALL_PARTS)
    if _u != "sms":
        ACCOUNT_MEASURES += slices(Measure(f"usageda_{_u}_sum", "sum", "units", f"unit_type = '{_u}'"), ALL_PARTS)
_ACCOUNT_SUMS = [m.name for m in ACCOUNT_MEASURES if "_sum" in m.name]


def _account_finish(wide: DataFrame, windows: Sequence[int]) -> DataFrame:
    return add_per_day(wide, {s.replace("_sum", "_avg"): s for s in _ACCOUNT_SUMS}, windows)


ACCOUNTS = Family("usageda", _account_rows, ACCOUNT_MEASURES, _account_finish,
                  extremes={s: s.replace("_sum", "_{op}") for s in _ACCOUNT_SUMS})


# --- value-added services --------------------------------------------------------------------------

def _vas_rows(raw: DataFrame) -> DataFrame:
    return raw.withColumn("service_category", regex_rules("service_code", VAS_CATEGORY, "other"))


VAS_MEASURES = [Measure(f"vascloud_spend_{a}", a, "value") for a in ("sum", "min", "max", "count")] + [
    Measure(f"vascloud_{c.lower()}_spend_{a}", a, "value", f"service_category = '{c}'")
    for c in VAS_CATEGORIES for a in ("sum", "min", "max", "count")]


def _vas_finish(wide: DataFrame, windows: Sequence[int]) -> DataFrame:
    shares_of = {f"vascloud_{c.lower()}_spend_ratio_{a}": (f"vascloud_{c.lower()}_spend_{a}", f"vascloud_spend_{a}")
                 for c in VAS_CATEGORIES for a in ("sum", "count")}
    stems = [m.name for m in VAS_MEASURES if m.agg in ("sum", "count")] + list(shares_of)
    return trend_ratios(add_ratios(wide, shares_of, windows), stems, windows)


VAS = Family("vascloud", _vas_rows, VAS_MEASURES, _vas_finish)


# --- calls and messages ------------------------------------------------------------------------------

def _kind_measures(prefix: str, kinds: dict, sms: dict, kind_col: str, not_answered: bool) -> list[Measure]:
    out = []
    for name, code in {**kinds, **sms}.items():
        cond = f"{kind_col} = '{code}'"
        out += slices(Measure(f"{prefix}_{name}_count", "hits", None, cond), WEEK_PART)
        if name in kinds:
            out += slices(Measure(f"{prefix}_{name}_duration_sum", "sum", "call_duration", cond), WEEK_PART)
            if not_answered:
                out.append(Measure(f"{prefix}_{name}_not_answered_count", "hits", None, f"{cond} AND call_duration = 0"))
    return out


def call_measures(prefix: str, not_answered: bool = True) -> list[Measure]:
    return _kind_measures(prefix, CALL_KINDS, SMS_KINDS, "call_type", not_answered)


def volte_measures(prefix: str) -> list[Measure]:
    return _kind_measures(prefix, VOLTE_KINDS, {}, "call_type", False)


def add_call_totals(wide: DataFrame, prefix: str, kinds: Sequence[str], sms: Sequence[str],
                    windows: Sequence[int], not_answered: bool = True) -> tuple[DataFrame, list[str]]:
    """Totals over call and message kinds per window; an absent kind counts as 0."""
    groups = {}
    for slot, suffix in (("", ""), ("_wk", "_wk"), ("_wd", "_wd")):
        groups[f"{prefix}_total_call{slot}_count"] = [f"{prefix}_{k}_count{suffix}" for k in kinds]
        if sms:
            groups[f"{prefix}_total_sms{slot}_count"] = [f"{prefix}_{k}_count{suffix}" for k in sms]
    if not_answered:
        groups[f"{prefix}_total_call_not_answered_count"] = [f"{prefix}_{k}_not_answered_count" for k in kinds]
    out = add_text(wide, {f"{name}_l{n}w": total_text([f"{p}_l{n}w" for p in parts])
                          for name, parts in groups.items() for n in windows})
    stems = list(groups)
    if sms:
        stems.append(f"{prefix}_total_count")
        out = add_text(out, {f"{prefix}_total_count_l{n}w": total_text(
            [f"{prefix}_total_call_count_l{n}w", f"{prefix}_total_sms_count_l{n}w"]) for n in windows})
    return out, stems


def call_ratios(prefix: str, not_answered: bool = True) -> dict[str, tuple[str, str]]:
    out = {f"{prefix}_call_{d}_ratio": (f"{prefix}_call_{d}_count", f"{prefix}_total_call_count") for d in ("in", "out")}
    out |= {f"{prefix}_sms_{d}_ratio": (f"{prefix}_sms_{d}_count", f"{prefix}_total_sms_count") for d in ("in", "out")}
    out |= {f"{prefix}_total_{k}_ratio": (f"{prefix}_total_{k}_count", f"{prefix}_total_count") for k in ("call", "sms")}
    if not_answered:
        out[f"{prefix}_total_call_not_answered_ratio"] = (f"{prefix}_total_call_not_answered_count", f"{prefix}_total_call_count")
    return out


def volte_ratios(prefix: str) -> dict[str, tuple[str, str]]:
    return {f"{prefix}_{k}_ratio": (f"{prefix}_{k}_count", f"{prefix}_total_call_count") for k in VOLTE_KINDS}


VOICE_MEASURES = call_measures("voice")
VOLTE_MEASURES = volte_measures("volte")


def _talk_finish(prefix, measures, kinds, sms, ratios, not_answered):
    sums = [m.name for m in measures if "_sum" in m.name]

    def finish(wide: DataFrame, windows: Sequence[int]) -> DataFrame:
        out, totals = add_call_totals(wide, prefix, kinds, sms, windows, not_answered)
        base = [m.name for m in measures] + totals
        per_day = {s.replace("sum", "davg").replace("count", "davg"): s for s in base}
        out = add_per_day(out, per_day, windows)
        extremes = [s.replace("_sum", f"_{op}") for s in sums for op in ("dmin", "dmax")]
        out = trend_ratios(out, [*base, *extremes, *per_day], windows, "skip1")
        return add_ratios(out, ratios, windows)
    return finish


VOICE = Family("voice", _by_day, VOICE_MEASURES,
               _talk_finish("voice", VOICE_MEASURES, list(CALL_KINDS), list(SMS_KINDS), call_ratios("voice"), True),
               extremes={m.name: m.name.replace("_sum", "_{op}") for m in VOICE_MEASURES if "_sum" in m.name})
VOLTE = Family("volte", _by_day, VOLTE_MEASURES,
               _talk_finish("volte", VOLTE_MEASURES, list(VOLTE_KINDS), [], volte_ratios("volte"), False),
               extremes={m.name: m.name.replace("_sum", "_{op}") for m in VOLTE_MEASURES if "_sum" in m.name})


# --- transfers ----------------------------------------------------------------------------------------

def money_transfer(raw: DataFrame, snapshot: str, windows: Sequence[int] = WEEKS) -> DataFrame:
    """Both roles of every transfer in one exploded pass."""
    recent = raw.where((F.col("s3_file_date") >= lookback_start(snapshot, max(windows))) & (F.col("s3_file_date") < snapshot))
    rows, measures = two_party_features(recent, "sender", "receiver", "amount", "s3_file_date")
    wide = widen(weekly(rows, ["msisdn"], "s3_file_date", snapshot, measures, max(windows), windows), ["msisdn"], measures, windows)
    out = add_text(wide, {
        f"money_transfer_amount_sum_l{n}w": total_text([f"money_transfer_{r}_amount_sum_l{n}w" for r in ("sender", "receiver")])
        for n in windows})
    averages = {f"money_transfer_{r}_amount_avg": (f"money_transfer_{r}_amount_sum", f"money_transfer_{r}_count")
                for r in ("sender", "receiver")}
    stems = [*[m.name for m in measures], "money_transfer_amount_sum", *averages]
    return trend_ratios(add_ratios(out, averages, windows), stems, windows, "skip1")


# --- credit advances --------------------------------------------------------------------------------------

def credit_family(prefix: str, amount: str, pack: str | None = None) -> Family:
    """Advances per subscriber. Longer windows add up weekly distinct counts: exact for
    days (weeks are disjoint), an upper bound for packs."""
    measures = [Measure(f"{prefix}_credit_count", "sum", "n"), Measure(f"{prefix}_count_days", "ndistinct", "s3_file_date")]
    if pack:
        measures.append(Measure(f"{prefix}_pack_count", "ndistinct", pack))
    measures += [Measure(f"{prefix}_amount_sum", "sum", "total"), Measure(f"{prefix}_amount_max", "max", "top")]

    def reduce_days(raw: DataFrame) -> DataFrame:
        by = ["msisdn", "s3_file_date", *([pack] if pack else [])]
        return raw.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(amount).alias("total"), F.max(amount).alias("top"))

    def finish(wide: DataFrame, windows: Sequence[int]) -> DataFrame:
        out = add_ratios(wide, {f"{prefix}_amount_avg": (f"{prefix}_amount_sum", f"{prefix}_credit_count")}, windows)
        return trend_ratios(out, [*[m.name for m in measures], f"{prefix}_amount_avg"], windows, "skip1")
    return Family(prefix, reduce_days, measures, finish, reduced=True)


UDV = credit_family("udv", "amount", "pack_id")
UTN = credit_family("utn", "credit_amount")

WEEKLY = {f.name: f for f in (AIR, PACKAGES, BRANDS, SESSIONS, USAGE, ACCOUNTS, VAS, VOICE, VOLTE, UDV, UTN)}
