"""Weekly and cell-level families."""

from __future__ import annotations

from rollspan.catalog.registry import R, query, role_sql
from rollspan.catalog.roles import EVENTS_D, HISTORY_D
from rollspan.catalog.sqlgen import Windowed, both, nullable_sum, part_conditions, per_day
from rollspan.functions.fixed_values import (
    ACCOUNT_UNIT, CALL_KINDS, SENDER_CATEGORIES, SENDER_CATEGORY, SMS_KINDS, USAGE_SERVICES, VAS_CATEGORIES, VAS_CATEGORY,
    VOLTE_KINDS,
)
from rollspan.plans import cells, weekly

STAMP = "strptime({c}, '{f}')"
SLOT = "CASE WHEN hour({t}) >= 6 AND hour({t}) < 18 THEN 'dt' ELSE 'nt' END AS slot"
DAY = "strptime(s3_file_date, '%Y%m%d')"
AIR_TS = "strptime(origintimestamp, '%Y%m%d%H%M%S')"
USAGE_TS = "strptime(originaltimestamp, '%Y%m%dT%H:%M:%S')"
NO_WINDOWS = (1, 4, 12, 24)


def wk(t: str) -> str:
    return f"dayofweek({t}) IN (0, 6) AS is_wk"


def sliced(o: Windowed, stem: str, value: str | None, cond: str | None = None, parts="wk wd dt nt", template="{stem}_{p}",
           zero=False):
    if value is None:
        o.count(stem, cond, zero)
    else:
        o.agg(stem, "sum", value, cond)
    for p, c in part_conditions(parts).items():
        name = template.format(stem=stem, p=p)
        if value is None:
            o.count(name, both(cond, c))
        else:
            o.agg(name, "sum", value, both(cond, c))


# --- recharges -----------------------------------------------------------------------------

def air_oracle(keys=("msisdn",)) -> Windowed:
    o = Windowed("recharge", HISTORY_D, keys, derive=f"reillamount / 1000 AS amount, {wk(AIR_TS)}, {SLOT.format(t=AIR_TS)}")
    return o


def _air_sql():
    o = air_oracle()
    sliced(o, "air_balance_update_count", None)
    sliced(o, "air_balance_update_sum", "amount")
    kinds = {"adjustment": "module = 'AdjustmentRecord'", "refill": "module = 'RefillRecord'"}
    for k, c in kinds.items():
        for op in ("sum", "min", "max"):
            o.agg(f"air_{k}_{op}", op, "amount", c)
        o.count(f"air_{k}_count", c, zero=True)
    o.count("air_use_voucher_count", "vouchergroup <> ''", zero=True)
    base = [s for s in [*o.ints, *o.doubles] if not s.endswith(("_min", "_max"))]
    ratios = {f"air_balance_update_{m}_{s}_ratio": (f"air_balance_update_{m}_{s}", f"air_balance_update_{m}") for m in ("count", "sum") for s in ("nt", "wk")}
    ratios |= {f"air_{k}_ratio": (f"air_{k}_count", "air_balance_update_count") for k in ("use_voucher", "adjustment", "refill")}
    o.ratios({**{f"air_{k}_avg": (f"air_{k}_sum", f"air_{k}_count") for k in kinds}, **ratios})
    o.trend([*base, *ratios])
    return o.sql()


@query("family_air", _air_sql)
def _(t):
    return weekly.AIR.features(t.back(HISTORY_D).recharge, HISTORY_D)


# --- packages ----------------------------------------------------------------------------------

PACKAGE_DERIVE = """
    CASE WHEN service_id LIKE 'gd\\_%' ESCAPE '\\' OR service_id LIKE '%home%' THEN 'family' WHEN service_id LIKE 'vp%' THEN 'office'
         WHEN service_id LIKE 'wifi\\_offload%' ESCAPE '\\' THEN 'public' WHEN service_id LIKE 'gt%' OR service_id LIKE 'mytv%' THEN 'relax' ELSE 'other' END AS usage_category,
    (epoch(coalesce(try_strptime(time_end, '%Y%m%d%H%M%S'), TIMESTAMP '1970-01-01')) - epoch(strptime(time_start, '%Y%m%d%H%M%S'))) / 86400 AS days,
    CASE WHEN last_action IN ('CREATE', 'EXTEND') THEN 'active' WHEN last_action = 'DELETE' THEN 'cancel' ELSE 'other' END AS action_category"""


def _package_sql():
    source = f"""SELECT *, CASE WHEN days < 0 THEN 'unknown' WHEN days <= 1 THEN 'one_day' WHEN days <= 7 THEN 'few_days' WHEN days <= 31 THEN 'few_weeks'
        WHEN days <= 180 THEN 'few_months' ELSE 'long_term' END AS tenure FROM (SELECT *, {PACKAGE_DERIVE} FROM ({role_sql('package')}))"""
    o = Windowed("package", HISTORY_D, source=source)
    o.count("3gsub_action_count")
    acts = {"active": "action_category = 'active'", "cancel": "action_category = 'cancel'"}
    for a, c in acts.items():
        o.count(f"3gsub_{a}_count", c, zero=True)
    groups = {**{g: f"usage_category = '{g}'" for g in ("family", "office", "public", "relax", "other")},
              **{g: f"tenure = '{g}'" for g in ("one_day", "few_days", "few_weeks", "few_months", "long_term")}}
    pct = {}
    for g, c in groups.items():
        o.count(f"3gsub_{g}_count", c)
        pct[f"3gsub_{g}_pct"] = (f"3gsub_{g}_count", "3gsub_action_count")
        for a, ac in acts.items():
            o.agg(f"3gsub_{g}_{a}_count", "sum", f"CASE WHEN {ac} THEN 1 ELSE 0 END", c, integer=True)
            pct[f"3gsub_{g}_{a}_pct"] = (f"3gsub_{g}_{a}_count", f"3gsub_{a}_count")
    stems = list(o.ints)
    o.ratios(pct)
    o.trend(stems)
    return o.sql()


@query("family_3gsub", _package_sql)
def _(t):
    return weekly.PACKAGES.features(t.back(HISTORY_D).package, HISTORY_D)


# --- branded messages ------------------------------------------------------------------------------

def case_regex(col: str, rules, default: str) -> str:
    whens = " ".join(f"WHEN regexp_matches({col}, '{p}') THEN '{label}'" for label, p in rules)
    return f"CASE {whens} ELSE '{default}' END"


def _brand_sql():
    o = Windowed("brand", HISTORY_D, derive=case_regex("lower(trim(sender))", SENDER_CATEGORY, "other") + " AS category")
    o.count("brandname_sms_count")
    for c in SENDER_CATEGORIES:
        o.count(f"brandname_sms_count_{c}", f"category = '{c}'", zero=True)
    stems = list(o.ints)
    o.ratios({f"brandname_sms_pct_{c}": (f"brandname_sms_count_{c}", "brandname_sms_count") for c in SENDER_CATEGORIES})
    pairs = {f"brandname_sms_pct_{a}_vs_{b}": (f"brandname_sms_pct_{a}", f"brandname_sms_pct_{b}")
             for i, a in enumerate(SENDER_CATEGORIES) for b in SENDER_CATEGORIES[i + 1:]}
    o.ratios(pairs)
    terms = " + ".join('CASE WHEN "{p}_{{w}}" > 0 THEN -"{p}_{{w}}" * log2("{p}_{{w}}") ELSE 0 END'.format(p=f"brandname_sms_pct_{c}") for c in SENDER_CATEGORIES)
    o.exprs({"brandname_entropy": f'CASE WHEN "brandname_sms_count_{{w}}" IS NOT NULL THEN {terms} END'})
    o.trend([*stems, "brandname_entropy"])
    return o.sql()


@query("family_brandname", _brand_sql)
def _(t):
    return weekly.BRANDS.features(t.back(HISTORY_D).brand, HISTORY_D)


# --- data sessions -----------------------------------------------------------------------------------

VALUES = ("duration", "data_volume_downlink", "data_volume_uplink")


def session_oracle(o: Windowed, prefix: str, extremes: bool):
    for v in VALUES:
        o.agg(f"{prefix}_{v}_count", "count", v, integer=True)
        sliced(o, f"{prefix}_{v}_sum", v, template=f"{prefix}_{v}_{{p}}_sum")
        if extremes:
            o.agg(f"{prefix}_{v}_min", "min", v)
            o.agg(f"{prefix}_{v}_max", "max", v)
    o.count(f"{prefix}_duration_count_over_5mins", "duration / 60 > 5", zero=True)
    o.count(f"{prefix}_duration_count_under_30secs", "duration / 60 < 0.5", zero=True)
    o.count(f"{prefix}_wk_count", "is_wk", zero=True)
    o.count(f"{prefix}_wd_count", "NOT is_wk", zero=True)
    o.count(f"{prefix}_downlink_count", "data_volume_downlink <> 0", zero=True)
    o.count(f"{prefix}_uplink_count", "data_volume_uplink <> 0", zero=True)


SESSION_DERIVE = f"{wk(DAY)}, {SLOT.format(t='record_opening_time')}"


def _session_sql():
    o = Windowed("session", HISTORY_D, derive=SESSION_DERIVE)
    session_oracle(o, "ggsn", True)
    stems = [*o.ints, *o.doubles]
    ratios = {f"ggsn_duration_count_ratio_{k}": (f"ggsn_duration_count_{k}", "ggsn_duration_count") for k in ("over_5mins", "under_30secs")}
    o.ratios(ratios)
    o.trend([*stems, *ratios])
    return o.sql()


@query("family_ggsn", _session_sql)
def _(t):
    return weekly.SESSIONS.features(t.back(HISTORY_D).session, HISTORY_D)


# --- usage -------------------------------------------------------------------------------------------------

USAGE_DERIVE = f"totalcost / 1000 AS cost, {wk(USAGE_TS)}, {SLOT.format(t=USAGE_TS)}"


def usage_oracle(o: Windowed, prefix: str):
    sliced(o, f"{prefix}_count", None)
    sliced(o, f"{prefix}_call_duration_sum", "duration")
    sliced(o, f"{prefix}_total_cost_sum", "cost")
    stems = {"sms": {"sms_total_cost": "cost"}, "voice": {"voice_duration": "duration", "voice_total_cost": "cost"},
             "voip": {"voice_voip_duration": "duration", "voice_voip_total_cost": "cost"},
             "video": {"video_duration": "duration", "video_total_cost": "cost"},
             "data": {"data_volume": "volume", "data_total_cost": "cost"}}
    for s, names in USAGE_SERVICES.items():
        cond = "servicename IN ({})".format(", ".join(f"'{n}'" for n in names))
        o.count(f"{prefix}_{s}_count", cond)
        for stem, value in stems[s].items():
            sliced(o, f"{prefix}_{stem}_sum", value, cond)


def with_daily_extremes(o: Windowed, op_names=("dmin", "dmax"), keys=("msisdn",)):
    """Re-state every aggregate over daily rows and add min/max of the daily sums."""
    cols = {**o.ints, **o.doubles}
    k = ", ".join(keys)
    o.ctes.append(("daily", f"SELECT {k}, s3_file_date, " + ", ".join(f'{e} AS "{s}"' for s, e in cols.items()) + f" FROM rows_ GROUP BY {k}, s3_file_date"))
    sums = [s for s in o.doubles if "_sum" in s]
    o.ints = {s: f'sum("{s}")' for s in o.ints}
    o.doubles = {s: f'sum("{s}")' for s in o.doubles}
    for s in sums:
        o.doubles[s.replace("_sum", "_" + op_names[0])] = f'min("{s}")'
        o.doubles[s.replace("_sum", "_" + op_names[1])] = f'max("{s}")'
    return sums


def _usage_sql():
    o = Windowed("usage", HISTORY_D, derive=USAGE_DERIVE)
    usage_oracle(o, "usage")
    sums = with_daily_extremes(o)
    o.exprs({s.replace("_sum", "_davg"): per_day(s) for s in sums})
    return o.sql()


@query("family_usage", _usage_sql)
def _(t):
    return weekly.USAGE.features(t.back(HISTORY_D).usage, HISTORY_D)


def _account_sql():
    units = " ".join(f"WHEN dedicatedaccountid IN ({', '.join(map(str, ids))}) THEN '{u}'" for u, ids in ACCOUNT_UNIT.items())
    o = Windowed("account_usage", HISTORY_D, derive=f"CASE {units} ELSE 'others' END AS unit_type, {wk(USAGE_TS)}, {SLOT.format(t=USAGE_TS)}")
    for u in ("money", "time", "data", "sms"):
        sliced(o, f"usageda_{u}_count", None, f"unit_type = '{u}'")
        if u != "sms":
            sliced(o, f"usageda_{u}_sum", "units", f"unit_type = '{u}'")
    sums = with_daily_extremes(o)
    o.exprs({s.replace("_sum", "_avg"): per_day(s) for s in sums})
    return o.sql()


@query("family_usageda", _account_sql)
def _(t):
    return weekly.ACCOUNTS.features(t.back(HISTORY_D).account_usage, HISTORY_D)


# --- value-added services ------------------------------------------------------------------------------------

def _vas_sql():
    o = Windowed("vas", EVENTS_D, derive=case_regex("service_code", VAS_CATEGORY, "other") + " AS cat")
    for prefix, cond in [("vascloud", None)] + [(f"vascloud_{c.lower()}", f"cat = '{c}'") for c in VAS_CATEGORIES]:
        o.agg(f"{prefix}_spend_count", "count", "value", cond, integer=True)
        for op in ("sum", "min", "max"):
            o.agg(f"{prefix}_spend_{op}", op, "value", cond)
    stems = [s for s in [*o.ints, *o.doubles] if s.endswith(("_sum", "_count"))]
    ratios = {f"vascloud_{c.lower()}_spend_ratio_{a}": (f"vascloud_{c.lower()}_spend_{a}", f"vascloud_spend_{a}") for c in VAS_CATEGORIES for a in ("sum", "count")}
    o.ratios(ratios)
    o.trend([*stems, *ratios])
    return o.sql()


@query("family_vascloud", _vas_sql)
def _(t):
    return weekly.VAS.features(t.back(EVENTS_D).vas, EVENTS_D)


# --- calls ---------------------------------------------------------------------------------------------------------

def kinds_oracle(o: Windowed, prefix: str, kinds: dict, sms: dict, not_answered: bool):
    for name, code in {**kinds, **sms}.items():
        cond = f"call_type = '{code}'"
        sliced(o, f"{prefix}_{name}_count", None, cond, "wk wd")
        if name in kinds:
            sliced(o, f"{prefix}_{name}_duration_sum", "call_duration", cond, "wk wd")
            if not_answered:
                o.count(f"{prefix}_{name}_not_answered_count", f"{cond} AND call_duration = 0")


def totals_oracle(o: Windowed, prefix: str, kinds, sms, not_answered: bool) -> list[str]:
    spec = {}
    for slot in ("", "_wk", "_wd"):
        spec[f"{prefix}_total_call{slot}_count"] = nullable_sum([f"{prefix}_{k}_count{slot}" for k in kinds])
        if sms:
            spec[f"{prefix}_total_sms{slot}_count"] = nullable_sum([f"{prefix}_{k}_count{slot}" for k in sms])
    if not_answered:
        spec[f"{prefix}_total_call_not_answered_count"] = nullable_sum([f"{prefix}_{k}_not_answered_count" for k in kinds])
    o.exprs(spec)
    stems = list(spec)
    if sms:
        o.exprs({f"{prefix}_total_count": nullable_sum([f"{prefix}_total_call_count", f"{prefix}_total_sms_count"])})
        stems.append(f"{prefix}_total_count")
    return stems


def shares_of(prefix: str, text: str) -> dict[str, tuple[str, str]]:
    """Lines ``name: part / whole``, each without the family's prefix."""
    found = [line.replace(":", " ").replace("/", " ").split() for line in text.strip().splitlines()]
    return {f"{prefix}_{name}": (f"{prefix}_{part}", f"{prefix}_{whole}") for name, part, whole in found}


CALL_SHARES = """
call_in_ratio: call_in_count / total_call_count
call_out_ratio: call_out_count / total_call_count
sms_in_ratio: sms_in_count / total_sms_count
sms_out_ratio: sms_out_count / total_sms_count
total_call_ratio: total_call_count / total_count
total_sms_ratio: total_sms_count / total_count
"""
NOT_ANSWERED_SHARE = "total_call_not_answered_ratio: total_call_not_answered_count / total_call_count"
VOLTE_SHARES = "\n".join(f"{k}_ratio: {k}_count / total_call_count" for k in VOLTE_KINDS)


def talk_sql(prefix, kinds, sms, not_answered, ratios, role, source=None):
    o = Windowed(role, HISTORY_D, derive=wk(DAY), source=source)
    kinds_oracle(o, prefix, kinds, sms, not_answered)
    sums = with_daily_extremes(o)
    counts = [s for s in o.ints]
    totals = totals_oracle(o, prefix, kinds, sms, not_answered)
    base = [*counts, *sums, *totals]
    davg = {s.replace("sum", "davg").replace("count", "davg"): per_day(s) for s in base}
    o.exprs(davg)
    o.ratios(ratios)
    ext = [s.replace("_sum", f"_{op}") for s in sums for op in ("dmin", "dmax")]
    o.trend([*base, *ext, *davg], 2)
    return o.sql(final_int=set(totals))


@query("family_voice", lambda: talk_sql("voice", CALL_KINDS, SMS_KINDS, True, shares_of("voice", CALL_SHARES + NOT_ANSWERED_SHARE), "call"))
def _(t):
    return weekly.VOICE.features(t.back(HISTORY_D).call, HISTORY_D)


@query("family_volte", lambda: talk_sql("volte", VOLTE_KINDS, {}, False, shares_of("volte", VOLTE_SHARES), "call"))
def _(t):
    from rollspan.sources.tables import cutover_union
    return weekly.VOLTE.features(cutover_union(t.back(HISTORY_D).call, t.back(HISTORY_D).call, "s3_file_date", "20010601"), HISTORY_D)


# --- transfers and credit --------------------------------------------------------------------------------------------

def _transfer_sql():
    src = role_sql("transfer")
    rows = (f"SELECT sender AS msisdn, 'sender' AS role, amount, s3_file_date FROM ({src}) "
            f"UNION ALL SELECT receiver, 'receiver', amount, s3_file_date FROM ({src})")
    o = Windowed("transfer", HISTORY_D, source=rows)
    for r in ("sender", "receiver"):
        c = f"role = '{r}'"
        p = f"money_transfer_{r}"
        o.count(f"{p}_count", c)
        # a week without this role stores 0 distinct days, a window without any row NULL
        o.ints[f"{p}_count_days"] = f"count(DISTINCT s3_file_date) FILTER (WHERE {c})"
        o.agg(f"{p}_amount_sum", "sum", "amount", c)
        o.agg(f"{p}_amount_max", "max", "amount", c)
    stems = [*o.ints, *o.doubles]
    o.exprs({"money_transfer_amount_sum": nullable_sum(["money_transfer_sender_amount_sum", "money_transfer_receiver_amount_sum"])})
    avgs = {f"money_transfer_{r}_amount_avg": (f"money_transfer_{r}_amount_sum", f"money_transfer_{r}_count") for r in ("sender", "receiver")}
    o.ratios(avgs)
    o.trend([*stems, "money_transfer_amount_sum", *avgs], 2)
    return o.sql()


@query("family_money_transfer", _transfer_sql)
def _(t):
    return weekly.money_transfer(t.back(HISTORY_D).transfer, HISTORY_D)


def credit_sql(prefix, amount, pack):
    o = Windowed("credit", HISTORY_D)
    o.count(f"{prefix}_credit_count")
    o.ints[f"{prefix}_count_days"] = "count(DISTINCT s3_file_date)"
    if pack:
        # weekly distinct packs added up
        o.ints[f"{prefix}_pack_count"] = f"count(DISTINCT {pack} || '@' || CAST(floor((date_diff('day', {DAY}, strptime('{HISTORY_D}', '%Y%m%d')) - 1) / 7) AS VARCHAR))"
    o.agg(f"{prefix}_amount_sum", "sum", amount)
    o.agg(f"{prefix}_amount_max", "max", amount)
    stems = [*o.ints, *o.doubles]
    o.ratios({f"{prefix}_amount_avg": (f"{prefix}_amount_sum", f"{prefix}_credit_count")})
    o.trend([*stems, f"{prefix}_amount_avg"], 2)
    return o.sql()


@query("family_udv", lambda: credit_sql("udv", "amount", "pack_id"))
def _(t):
    return weekly.UDV.features(t.back(HISTORY_D).credit, HISTORY_D)


@query("family_utn", lambda: credit_sql("utn", "credit_amount", None))
def _(t):
    return weekly.UTN.features(t.back(HISTORY_D).credit, HISTORY_D)


# --- cells ------------------------------------------------------------------------------------------------------------

MAP_SQL = f"""SELECT DISTINCT lac, ci AS cell_id, bts_name AS bts_id, s3_file_date FROM (
    SELECT *, max(s3_file_date) OVER (PARTITION BY bts_name, lac, ci) AS md FROM ({role_sql('cells')})
    WHERE s3_file_date >= '20010621' AND s3_file_date < '20010701') WHERE s3_file_date = md"""
BTS = ("msisdn", "bts_id")


def at_cells_sql(role: str, derive: str, cell: str | None = None) -> str:
    rows = f"({role_sql(role)})"
    if cell:
        rows = f"(SELECT *, split_part({cell}, '-', 3) AS lac, split_part({cell}, '-', 4) AS cell_id FROM {rows} WHERE {cell} <> '')"
    return f"SELECT e.*, m.bts_id, {derive} FROM {rows} e JOIN (SELECT lac, cell_id, bts_id FROM ({MAP_SQL})) m USING (lac, cell_id)"


def mapping(t):
    return cells.cell_map(t.cells, "20010701")


@query("family_bts_mapping", MAP_SQL)
def _(t):
    return mapping(t)


AIR_DERIVE = f"reillamount / 1000 AS amount, {wk(AIR_TS)}, {SLOT.format(t=AIR_TS)}"


def bts_air_oracle() -> Windowed:
    o = Windowed("recharge", HISTORY_D, BTS, source=at_cells_sql("recharge", AIR_DERIVE, "cell"))
    sliced(o, "bts_recharge_count", None)
    sliced(o, "bts_recharge_sum", "amount")
    return o


def bts_air(t):
    return cells.cell_features(cells.BTS_AIR, cells.with_cell_parts(t.back(HISTORY_D).recharge, "cell"), mapping(t), HISTORY_D)


@query("family_bts_air", lambda: bts_air_oracle().sql())
def _(t):
    return bts_air(t)


def bts_ggsn_oracle() -> Windowed:
    o = Windowed("session", HISTORY_D, BTS, source=at_cells_sql("session", SESSION_DERIVE))
    session_oracle(o, "bts_ggsn", False)
    return o


def bts_ggsn(t):
    return cells.cell_features(cells.BTS_GGSN, t.back(HISTORY_D).session, mapping(t), HISTORY_D)


@query("family_bts_ggsn", lambda: bts_ggsn_oracle().sql())
def _(t):
    return bts_ggsn(t)


def bts_usage_oracle() -> Windowed:
    o = Windowed("usage", HISTORY_D, BTS, source=at_cells_sql("usage", USAGE_DERIVE, "originatingcellid"))
    usage_oracle(o, "bts_usage")
    return o


def _bts_usage_sql():
    o = bts_usage_oracle()
    names = [*o.ints, *o.doubles]
    daily = ", ".join(f'{e} AS "{s}"' for s, e in {**o.ints, **o.doubles}.items())
    davg = {s: s.replace("count", "count_davg").replace("sum", "sum_davg") + "_l1w" for s in names}
    week = ", ".join(R(f'avg("{s}")', n) for s, n in davg.items())
    base = o.sql()
    rows = at_cells_sql("usage", USAGE_DERIVE, "originatingcellid")
    return f"""SELECT b.*, w.* EXCLUDE (msisdn, bts_id) FROM ({base}) b LEFT JOIN (
        SELECT msisdn, bts_id, {week} FROM (SELECT msisdn, bts_id, s3_file_date, {daily} FROM ({rows}) WHERE s3_file_date >= '20010723' AND s3_file_date < '{HISTORY_D}'
        GROUP BY msisdn, bts_id, s3_file_date) GROUP BY msisdn, bts_id) w USING (msisdn, bts_id)"""


def bts_usage(t):
    return cells.bts_usage(cells.with_cell_parts(t.back(HISTORY_D).usage, "originatingcellid"), mapping(t), HISTORY_D)


@query("family_bts_usage", _bts_usage_sql)
def _(t):
    return bts_usage(t)


def bts_talk_oracle(prefix, kinds, sms, ratios) -> Windowed:
    o = Windowed("call", HISTORY_D, BTS, source=at_cells_sql("call", wk(DAY)))
    kinds_oracle(o, prefix, kinds, sms, False)
    totals = totals_oracle(o, prefix, kinds, sms, False)
    if ratios:
        o.ratios(ratios)
    o.trend([*o.ints, *o.doubles, *totals, *ratios], 2)
    o.totals = set(totals)
    return o


def _bts_talk_sql(*args):
    o = bts_talk_oracle(*args)
    return o.sql(final_int=o.totals)


def bts_voice(t):
    return cells.cell_features(cells.BTS_VOICE, t.back(HISTORY_D).call, mapping(t), HISTORY_D)


def bts_volte(t):
    return cells.cell_features(cells.BTS_VOLTE, t.back(HISTORY_D).call, mapping(t), HISTORY_D)


@query("family_bts_voice", lambda: _bts_talk_sql("bts_voice", CALL_KINDS, SMS_KINDS, {}))
def _(t):
    return bts_voice(t)


@query("family_bts_volte", lambda: _bts_talk_sql("bts_volte", VOLTE_KINDS, {}, shares_of("bts_volte", VOLTE_SHARES)))
def _(t):
    return bts_volte(t)


# --- cells rolled up to subscribers ----------------------------------------------------------------------------------

def pn_oracle(o: Windowed, ratios: dict, gap: int, totals=None) -> str:
    """Sums over cells equal the aggregate over mapped rows per subscriber, which is what
    the oracle computes directly."""
    o.keys = ("msisdn",)
    rename = lambda d: {f"pn_{s}": e for s, e in d.items()}
    o.ints, o.doubles = rename(o.ints), rename(o.doubles)
    stems = [*o.ints, *o.doubles]
    o.trends, o.derived = [], []
    if totals:
        stems += totals_oracle(o, f"pn_{totals[0]}", totals[1], totals[2], False)
    final = set(stems) - set(o.doubles)
    pn = {f"pn_{k}": (f"pn_{a}", f"pn_{b}") for k, (a, b) in ratios.items()}
    o.ratios(pn)
    o.trend([*stems, *pn], gap)
    return o.sql(final_int=final)


def _air_ratios():
    return {f"bts_recharge_{m}_{s}_ratio": (f"bts_recharge_{m}_{s}", f"bts_recharge_{m}") for m in ("count", "sum") for s in ("nt", "wk")}


@query("family_pn_air", lambda: pn_oracle(bts_air_oracle(), _air_ratios(), 1))
def _(t):
    return cells.pn_air(bts_air(t))


@query("family_pn_ggsn", lambda: pn_oracle(bts_ggsn_oracle(), {
    f"bts_ggsn_duration_count_ratio_{k}": (f"bts_ggsn_duration_count_{k}", "bts_ggsn_duration_count") for k in ("over_5mins", "under_30secs")}, 2))
def _(t):
    return cells.pn_ggsn(bts_ggsn(t))


@query("family_pn_usage", lambda: pn_oracle(bts_usage_oracle(), {
    f"bts_usage_count_{s}_ratio": (f"bts_usage_count_{s}", "bts_usage_count") for s in ("nt", "wk")}, 2))
def _(t):
    return cells.pn_usage(bts_usage(t))


@query("family_pn_voice", lambda: pn_oracle(bts_talk_oracle("bts_voice", CALL_KINDS, SMS_KINDS, {}), shares_of("bts_voice", CALL_SHARES), 2,
                                            ("bts_voice", CALL_KINDS, SMS_KINDS)))
def _(t):
    return cells.pn_voice(bts_voice(t))


@query("family_pn_volte", lambda: pn_oracle(bts_talk_oracle("bts_volte", VOLTE_KINDS, {}, {}), shares_of("bts_volte", VOLTE_SHARES), 2,
                                            ("bts_volte", VOLTE_KINDS, {})))
def _(t):
    return cells.pn_volte(bts_volte(t))
