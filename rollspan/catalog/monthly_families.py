"""Snapshot, billing, monthly and merge families."""

from __future__ import annotations

import uuid

from rollspan.catalog.registry import I, R, query, role_sql
from rollspan.catalog.roles import HISTORY_D, MONTH_D, attribute
from rollspan.catalog.sqlgen import Windowed
from rollspan.functions.calendar import as_date, shift_months, ymd
from rollspan.functions.fixed_values import (
    BALANCE_BANDS, CAPABILITIES, CONTINENT, DEVICE_RENAMES, FEE_GROUPS, FINANCE_SENDERS, MONTHLY_REVENUE, REVENUE_MEASURES, SERVICE_CLASS,
)
from rollspan.plans import merge, monthly, snapshots, weekly
from rollspan.session import shared_folder

# --- location, device ------------------------------------------------------------------------------

LOCATION_SQL = f"""
WITH r AS (SELECT * FROM ({role_sql('ping')}) WHERE s3_file_date >= '20010702' AND s3_file_date < '{HISTORY_D}'),
c AS (SELECT msisdn, province, count(*) AS n FROM r GROUP BY 1, 2),
t AS (SELECT msisdn, count(DISTINCT province) AS nd, count(*) AS total FROM r GROUP BY 1),
e AS (SELECT c.msisdn, sum(-(n / total) * log2(n / total)) AS h FROM c JOIN t USING (msisdn) GROUP BY 1),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY msisdn ORDER BY n DESC, province) AS rn FROM c) WHERE rn = 1)
SELECT msisdn, nd AS location_count_distinct_l4w, {I('total', 'location_occurrence_count_l4w')}, {R('h', 'location_entropy_l4w')},
       province AS location_top1_province_l4w, n AS location_top1_province_count_l4w, {R('n / total', 'location_top1_province_ratio_l4w')}
FROM t JOIN e USING (msisdn) JOIN b USING (msisdn)"""


@query("family_location", LOCATION_SQL)
def _(t):
    return snapshots.location(t.back(HISTORY_D).ping, HISTORY_D)


TAC_SQL = f"""
WITH d AS (SELECT DISTINCT msisdn, left(imei, 8) AS tac, s3_file_date FROM ({role_sql('usage')})
           WHERE s3_file_date >= '20010630' AND s3_file_date < '{HISTORY_D}' AND imei <> ''),
c AS (SELECT msisdn, tac, count(*) AS n FROM d GROUP BY 1, 2)
SELECT msisdn, tac FROM (SELECT *, row_number() OVER (PARTITION BY msisdn ORDER BY n DESC, tac) AS rn FROM c) WHERE rn = 1"""


@query("family_tac_mapping", TAC_SQL)
def _(t):
    return snapshots.tac_mapping(t.back(HISTORY_D).usage, HISTORY_D)


def ids(group, c):
    return " ".join(f"WHEN {c} IN ({', '.join(repr(x) for x in v)}) THEN '{k}'" for k, v in group.items())


RAM_ONE = """CASE WHEN x IS NULL THEN '-1. Unknown' WHEN x < 2 THEN '0. <2GB' WHEN x <= 4 THEN '1. 2GB - 4GB' WHEN x <= 6 THEN '2. 4GB - 6GB'
    WHEN x <= 12 THEN '3. 6GB - 12GB' ELSE '4. 12GB+' END"""
DEVICE_COLS = f"""
    tac, gsma_marketing_name AS device_marketing_name, 2001 - CAST(year_released AS INT) AS device_age,
    CASE WHEN gsma_device_type = 'Smartphone' THEN 'phones' WHEN gsma_device_type = 'Tablet' THEN 'tablets & portables'
         WHEN gsma_device_type = 'Modem' THEN 'devices telecom-related' WHEN gsma_device_type = 'Vehicle' THEN 'vehicles' ELSE 'other' END AS device_type,
    CASE manufacturer WHEN 'Sony' THEN 'global brands' WHEN 'Wiko' THEN 'european brands' WHEN 'Lava' THEN 'indian brands' ELSE 'other brands' END AS device_manu,
    CASE WHEN gsma_lpwan = 'Not Known' OR coalesce(gsma_lpwan, '') = '' THEN 'Not Known' ELSE 'Supported' END AS device_lpwan,
    CASE WHEN contains(sim_size, 'Nano') THEN 1 ELSE 0 END AS device_has_nanosim, CASE WHEN contains(sim_size, 'Mini') THEN 1 ELSE 0 END AS device_has_minisim,
    CASE WHEN contains(sim_size, 'Micro') THEN 1 ELSE 0 END AS device_has_microsim,
    CASE WHEN internal_storage_capacity IN (2048, 24576) THEN internal_storage_capacity / 1024 ELSE CAST(internal_storage_capacity AS DOUBLE) END AS device_internal_storage,
    CASE lower(gsma_bluetooth) WHEN 'yes' THEN 1 WHEN 'n' THEN 0 END AS device_has_bluetooth,
    CASE os_name WHEN 'Android' THEN 'Android' WHEN 'iOS' THEN 'iOS' ELSE 'others' END AS device_os_family,
    CASE WHEN chipset_name LIKE 'Snapdragon%' THEN 'Snapdragon' WHEN chipset_name LIKE 'Helio%' THEN 'Helio' WHEN chipset_name LIKE 'MT%' THEN 'MT'
         WHEN chipset_name = 'A12 Bionic' THEN 'Apple' ELSE 'others' END AS device_chipset_family,
    CASE WHEN gpu_name LIKE 'Adreno%' THEN 'Adreno' WHEN gpu_name LIKE 'Mali%' THEN 'Mali' WHEN gpu_name LIKE 'PowerVR%' THEN 'PowerVR'
         WHEN chipset_name = 'A12 Bionic' THEN 'Apple' ELSE 'others' END AS device_gpu_family,
    CASE {ids(CONTINENT, 'gsma_country_code')} ELSE 'unknown' END AS device_continent,
    list_max(list_transform(list_transform(string_split(total_ram, '/'), lambda s: CASE WHEN TRY_CAST(s AS DOUBLE) > 100 THEN TRY_CAST(s AS DOUBLE) / 1024 ELSE TRY_CAST(s AS DOUBLE) END),
        lambda x: {RAM_ONE})) AS device_ram_category,
    CASE WHEN t_2g + t_3g + t_4g + t_5g > 1 THEN 1 ELSE 0 END AS device_has_mobile_internet,
    CASE WHEN image_gif87 + image_gif89a + image_jpg + image_png > 1 THEN 1 ELSE 0 END AS device_support_img"""

#: one row per code: the greatest row in column order, NULLs first
DEVICE_SQL = f"""
WITH latest AS (SELECT * FROM ({role_sql('catalogue')}) WHERE s3_file_date >= '20010430' AND s3_file_date <= '{HISTORY_D}'),
rows_ AS (SELECT {DEVICE_COLS} FROM latest WHERE s3_file_date = (SELECT max(s3_file_date) FROM latest))
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY tac ORDER BY {{order}}) AS rn FROM rows_) WHERE rn = 1"""
_DEVICE_ORDER = ["device_age", "device_type", "device_manu", "device_lpwan", "device_has_nanosim", "device_has_minisim", "device_has_microsim",
                 "device_internal_storage", "device_has_bluetooth", "device_os_family", "device_chipset_family", "device_gpu_family",
                 "device_continent", "device_ram_category", "device_has_mobile_internet", "device_support_img", "device_marketing_name"]


@query("family_device", DEVICE_SQL.format(order=", ".join(f"{c} DESC NULLS LAST" for c in _DEVICE_ORDER)))
def _(t):
    return snapshots.device(t.catalogue, HISTORY_D, absent="skip")


#: attributes of the whole catalogue in the order of the operator's columns
_FULL_ORDER = ["device_age", "device_type", "device_manu", "device_top_manu", *_DEVICE_ORDER[3:8], "device_has_bluetooth", "device_has_wlan",
               *_DEVICE_ORDER[9:14], *CAPABILITIES, *DEVICE_RENAMES.values()]


def _full_device_sql():
    more = ["CASE WHEN gsma_manufacturer IN ('Nokia Corporation') THEN gsma_manufacturer ELSE 'other' END AS device_top_manu",
            "CASE lower(gsma_wlan) WHEN 'yes' THEN 1 WHEN 'no' THEN 0 END AS device_has_wlan",
            *[f"CASE WHEN {' + '.join(flags)} > 1 THEN 1 ELSE 0 END AS {name}" for name, flags in CAPABILITIES.items() if name not in _DEVICE_ORDER],
            *[f"{attribute(old)} AS {new}" for old, new in DEVICE_RENAMES.items() if new not in _DEVICE_ORDER]]
    sql = DEVICE_SQL.format(order=", ".join(f"{c} DESC NULLS LAST" for c in _FULL_ORDER))
    return sql.replace(DEVICE_COLS, DEVICE_COLS + ", " + ", ".join(more)).replace(role_sql("catalogue"), role_sql("full_catalogue"))


@query("family_device_full", _full_device_sql)
def _(t):
    """Every output; one whose inputs were absent would raise."""
    catalogue = t.full_catalogue.withColumnsRenamed({attribute(c): c for c in DEVICE_RENAMES})
    return snapshots.device(catalogue, HISTORY_D)


GSMA_SQL = f"""
WITH u AS (SELECT msisdn, s3_file_date, imei FROM ({role_sql('usage')}) WHERE s3_file_date > '20010615' AND s3_file_date <= '{MONTH_D}' AND imei <> ''),
n AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY msisdn ORDER BY s3_file_date DESC, imei DESC) AS rn FROM u) WHERE rn = 1),
c AS (SELECT * FROM ({role_sql('catalogue')}) WHERE s3_file_date = (SELECT max(s3_file_date) FROM ({role_sql('catalogue')}))),
d AS (SELECT * FROM (SELECT tac, os_name, year_released, total_ram,
        row_number() OVER (PARTITION BY tac ORDER BY os_name DESC NULLS LAST, year_released DESC NULLS LAST, total_ram DESC NULLS LAST) AS rn FROM c) WHERE rn = 1)
SELECT left(imei, 8) AS tac, msisdn, coalesce(os_name, 'null') AS os_name, coalesce(year_released, '0') AS year_released,
       coalesce(total_ram, '0') AS total_ram, 2001 - CAST(year_released AS INT) AS year_released_delta
FROM n LEFT JOIN d ON left(imei, 8) = d.tac"""


@query("family_gsma", GSMA_SQL)
def _(t):
    return snapshots.latest_device(t.back(MONTH_D, 27).usage, t.catalogue, MONTH_D,
                                   {"os_name": "null", "year_released": "0", "total_ram": "0"}, 2001)


# --- demographics ------------------------------------------------------------------------------------

def newest_sql(role, key, changed, order):
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY s3_file_date DESC, chg DESC, {order}) AS rn FROM (
        SELECT *, coalesce(try_strptime({changed}, '%d/%m/%Y %H:%M:%S'), TIMESTAMP '1980-01-01') AS chg FROM ({role_sql(role)})
        WHERE {changed} IS NOT NULL AND s3_file_date < '{HISTORY_D}')) WHERE rn = 1"""


DEMOGRAPHIC_SQL = f"""
WITH a AS ({newest_sql('prepaid', 'msisdn', 'modifydate', 'gender DESC NULLS LAST, age DESC NULLS LAST')}),
b AS ({newest_sql('directory', 'somay', 'ngay_cn', 'nhom_tuoi DESC NULLS LAST, phai DESC NULLS LAST')}),
a2 AS (SELECT msisdn, chg AS a_at, CASE WHEN gender = 'female' THEN 0 WHEN gender IN ('Nam', 'NAM / M') THEN 1 ELSE 2 END AS a_sex, age AS a_age FROM a),
b2 AS (SELECT somay AS msisdn, chg AS b_at, CASE WHEN phai IN (0, 1) THEN phai ELSE 2 END AS b_sex, nhom_tuoi AS b_age FROM b)
SELECT msisdn,
  CASE WHEN coalesce(a_at, TIMESTAMP '1980-01-01') >= coalesce(b_at, TIMESTAMP '1980-01-01') THEN a_sex ELSE b_sex END AS prepaid_danhba_sex_l1w,
  CASE WHEN coalesce(a_at, TIMESTAMP '1980-01-01') >= coalesce(b_at, TIMESTAMP '1980-01-01') THEN a_age ELSE b_age END AS prepaid_danhba_age_group_l1w
FROM a2 FULL OUTER JOIN b2 USING (msisdn)"""


@query("family_prepaid_danhba", DEMOGRAPHIC_SQL)
def _(t):
    return snapshots.prepaid_danhba(t.prepaid, t.directory, HISTORY_D)


@query("family_prepaid_danhba_state", DEMOGRAPHIC_SQL)
def _(t):
    """The same from stored states: one step over the history, then steps that read the last state and the days since."""
    folder, newest = f"{shared_folder(t.spark)}/registries-{uuid.uuid4().hex}", []
    for role, key, changed in (("prepaid", "msisdn", "modifydate"), ("directory", "somay", "ngay_cn")):
        state, rows = snapshots.registry_state(t.spark, f"{folder}/{role}", key), snapshots.change_rows(t.role(role), changed)
        newest.append([state.advance(rows, upto) for upto in ("20010716", "20010723", HISTORY_D)][-1])
    return snapshots.demographics(*newest)


# --- balances -----------------------------------------------------------------------------------------

def _sub_sql():
    conds = {"lt_1k": "b > 0 AND b < 1000", "lt_5k": "b > 0 AND b < 5000", "lt_10k": "b > 0 AND b < 10000", "zero": "b = 0",
             "1k_to_5k": "b >= 1000 AND b < 5000", "5k_to_10k": "b >= 5000 AND b < 10000", "10k_to_20k": "b >= 10000 AND b < 20000",
             "20k_to_50k": "b >= 20000 AND b < 50000", "50k_to_100k": "b >= 50000 AND b < 100000", "ge_100k": "b >= 100000"}
    assert list(conds) == list(BALANCE_BANDS)
    o = Windowed("balance", HISTORY_D, source=f"SELECT *, account_id AS msisdn, account_balance AS b FROM ({role_sql('balance')})")
    o.agg("sub_balance_avg_per_day", "avg", "b")
    o.agg("sub_balance_max_per_day", "max", "b")
    o.agg("sub_balance_std_per_day", "stddev_samp", "b")
    for n, c in conds.items():
        o.agg(f"sub_balance_pct_day_{n}", "avg", f"CASE WHEN {c} THEN 1 ELSE 0 END")
    o.trend(list(o.doubles))
    life = f"""SELECT msisdn, max(account_activated_date) AS sub_activated_date, max(account_activated_flag) AS sub_activated_flag, max(service_class_id) AS service_class_id
        FROM (SELECT *, account_id AS msisdn, max(s3_file_date) OVER (PARTITION BY account_id) AS md FROM ({role_sql('balance')})
              WHERE s3_file_date >= '20010630' AND s3_file_date < '{HISTORY_D}') WHERE s3_file_date = md GROUP BY 1"""
    return f"""SELECT msisdn, a.* EXCLUDE (msisdn), sub_activated_date, sub_activated_flag, service_class_id,
        CASE {ids(SERVICE_CLASS, 'service_class_id')} WHEN service_class_id IS NOT NULL THEN 'unknown' END AS sub_service_type,
        {R(f"date_diff('day', CAST(sub_activated_date AS DATE), DATE '2001-07-30') / 365", 'sub_activate_year')}
        FROM ({o.sql()}) a FULL OUTER JOIN ({life}) b USING (msisdn)"""


@query("family_sub", _sub_sql)
def _(t):
    return snapshots.sub(t.back(HISTORY_D).balance, HISTORY_D)


# --- billing ---------------------------------------------------------------------------------------------

def _billing_sql(prefix, debt, tax):
    fee = "CASE " + " ".join(f"WHEN khoanmuctt_id IN ({', '.join(repr(x) for x in v)}) THEN '{k}'" for k, v in FEE_GROUPS.items()) + " ELSE 'other' END"
    groups = [*FEE_GROUPS, "other"]
    cols = [f"count(DISTINCT khoanmuctt_id) AS {prefix}_total_items_count_distinct_l1m"]
    values = {"debt": debt, "tax": tax, "amount": f"{debt} + {tax}"}
    for v, e in values.items():
        cols.append(R(f"sum({e})", f"{prefix}_total_{v}_sum_l1m"))
    for g in groups:
        f = f"FILTER (WHERE fee = '{g}')"
        cols.append(f"count(DISTINCT khoanmuctt_id) {f} AS {prefix}_{g}_items_count_distinct_l1m")
        for v, e in values.items():
            for a, fn in (("sum", "sum"), ("max", "max"), ("std", "stddev_samp")):
                cols.append(R(f"{fn}({e}) {f}", f"{prefix}_{g}_{v}_{a}_l1m"))
        for v in ("debt", "amount"):
            cols.append(R(f"sum({values[v]}) {f} / nullif(sum({values[v]}), 0)", f"{prefix}_{g}_{v}_ratio_l1m"))
    return f"SELECT ma_tb AS msisdn, {', '.join(cols)} FROM (SELECT *, {fee} AS fee FROM ({role_sql('bill')})) WHERE s3_file_date = '200105' GROUP BY 1"


@query("family_ccbs_no", lambda: _billing_sql("no", "nogoc", "thue"))
def _(t):
    return snapshots.ccbs_no(t.bill, HISTORY_D)


@query("family_ccbs_tra", lambda: _billing_sql("tra", "tragoc", "trathue"))
def _(t):
    return snapshots.ccbs_tra(t.bill, HISTORY_D)


# --- revenue ---------------------------------------------------------------------------------------------------

REVENUE = {"TOT_RVN_AMT": "total_revenue", "TOT_BLLD_AMT": "total_charge", "TOT_DISC_AMT": "total_discount_usage",
           "RCHRG_PRMTN_AMT": "recharge_amount", "VOICE_USG": "call_usage", "DATA_USG": "data_usage"}


def _smrs_sql(measures=REVENUE, role="revenue"):
    # snapshots D - 4w*i for i = 0..5 and the calendar month before each of them
    steps = [(i, ymd(shift_months(as_date(HISTORY_D).fromordinal(as_date(HISTORY_D).toordinal() - 28 * i), -1))[:6]) for i in range(6)]
    values = ", ".join(f"({i}, {m})" for i, m in steps)
    sums = ", ".join(f"sum({c}) AS {n}" for c, n in measures.items())
    cols = []
    for n in measures.values():
        for k in (1, 2, 3, 6):
            for op in ("sum",) if k == 1 else ("sum", "min", "max", "avg"):
                cols.append(R(f"{op}({n}) FILTER (WHERE step < {k})", f"smrs_{n}_{op}_l{k}m"))
        ks = (1, 2, 3, 6)
        for i, x in enumerate(ks):
            for y in ks[i + 1:]:
                cols.append(R(f"sum({n}) FILTER (WHERE step < {x}) / nullif(sum({n}) FILTER (WHERE step < {y}), 0)", f"smrs_{n}_sum_l{x}m_vs_l{y}m"))
    return f"""WITH steps(step, mo) AS (VALUES {values}),
    last AS (SELECT *, max(s3_file_date) OVER (PARTITION BY mo_key) AS md FROM ({role_sql(role)})),
    m AS (SELECT accs_mthd_key AS msisdn, step, {sums} FROM last JOIN steps ON mo = mo_key WHERE s3_file_date = md GROUP BY 1, 2)
    SELECT msisdn, {', '.join(cols)} FROM m GROUP BY 1"""


@query("family_smrs", _smrs_sql)
def _(t):
    return snapshots.smrs(t.back(HISTORY_D).revenue, HISTORY_D, REVENUE)


@query("family_smrs_all", lambda: _smrs_sql(REVENUE_MEASURES, "all_revenue"))
def _(t):
    return snapshots.smrs(t.back(HISTORY_D).all_revenue, HISTORY_D)


# --- monthly numeric ---------------------------------------------------------------------------------------------

def month_case(day: str = "strptime(s3_file_date, '%Y%m%d')") -> str:
    """Month number by its bounds: window n is (D - n months, D - (n-1) months]."""
    whens = " ".join(
        f"WHEN s3_file_date > '{ymd(shift_months(as_date(MONTH_D), -n))}' AND s3_file_date <= '{ymd(shift_months(as_date(MONTH_D), 1 - n))}' THEN {n}" for n in range(1, 7))
    return f"CASE {whens} END"


def cumulative_sql(rows: str, facts: dict[str, tuple[str, str | None]], months=6, start=1) -> str:
    """Cumulative windows straight from rows; ``facts``: stem -> (value, filter)."""
    cols = []
    for s, (v, cond) in facts.items():
        first = f"sum({v}) FILTER (WHERE m <= {start}{f' AND {cond}' if cond else ''})"
        for t in range(start, months + 1):
            f = f"FILTER (WHERE m <= {t}{f' AND {cond}' if cond else ''})"
            n, total, sq = f"count({v}) {f}", f"coalesce(sum({v}) {f}, 0)", f"coalesce(sum({v} * {v}) {f}, 0)"
            avg = f"({total} / nullif({n}, 0))"
            cols += [R(total, f"sum_{s}_T-{t}"), I(n, f"count_{s}_T-{t}"), R(f"min({v}) {f}", f"min_{s}_T-{t}"), R(f"max({v}) {f}", f"max_{s}_T-{t}"),
                     R(sq, f"sumsq_{s}_T-{t}"), R(avg, f"avg_{s}_T-{t}"),
                     R(f"CASE WHEN {n} > 0 THEN sqrt(greatest({sq} / nullif({n}, 0) - {avg} * {avg}, 0)) ELSE 0 END", f"std_{s}_T-{t}")]
            if t > start:
                cols.append(R(f"{total} / nullif(coalesce({first}, 0), 0)", f"ratio_{s}_T-{t}"))
    return f"SELECT msisdn, {', '.join(cols)} FROM ({rows}) WHERE m IS NOT NULL GROUP BY msisdn"


def monthly_rows(role: str, extra: str = "*") -> str:
    return f"SELECT {extra}, {month_case()} AS m FROM ({role_sql(role)})"


RECHARGE_FACTS = {"reillamount_full": ("reillamount", None), "reillamount_refill": ("reillamount", "module = 'RefillRecord'"),
                  "reillamount_adjustment": ("reillamount", "module = 'AdjustmentRecord'")}


@query("family_monthly_air", lambda: cumulative_sql(monthly_rows("recharge"), RECHARGE_FACTS))
def _(t):
    return monthly.recharge_monthly(t.back(MONTH_D, 27).recharge, MONTH_D)


@query("family_monthly_ggsn", lambda: cumulative_sql(monthly_rows("session"), {
    f"{v}_full": (v, None) for v in ("duration", "data_volume_downlink", "data_volume_uplink")}))
def _(t):
    return monthly.numeric_monthly_daily(t.back(MONTH_D, 27).session, MONTH_D, {v: v for v in ("duration", "data_volume_downlink", "data_volume_uplink")})


SERVICES = {"voice": "servicename = 'Voice'", "sms": "servicename = 'SMS'", "data": "servicename IN ('MBC', 'Data')"}


@query("family_monthly_usage", lambda: cumulative_sql(monthly_rows("usage"), {
    f"totalcost_{k}": ("totalcost", c) for k, c in {"full": None, **SERVICES}.items()}))
def _(t):
    return monthly.numeric_monthly(t.back(MONTH_D, 27).usage, MONTH_D, {"totalcost": "totalcost"}, {"full": None, **SERVICES})


@query("family_monthly_ggsn_units", lambda: cumulative_sql(monthly_rows("session"), {
    "duration_minutes_full": ("(duration / 60)", None), "data_volume_downlink_mb_full": ("(data_volume_downlink / 1000000)", None), "data_volume_uplink_mb_full": ("(data_volume_uplink / 1000000)", None)}))
def _(t):
    return monthly.session_monthly(t.back(MONTH_D, 27).session, MONTH_D)


@query("family_monthly_usage_categories", lambda: cumulative_sql(monthly_rows("charged"), {
    "totalcost_full": ("totalcost", None),
    **{f"totalcost_{n}": ("totalcost", f"chargingcategoryname = '{c}'") for n, c in {
        "none": "", "data": "DATA", "volte": "VoLTE", "sms": "SMS", "voice": "VOICE", "service_charging_scap": "SERVICE_CHARGING (SCAP)", "roaming": "ROAMING",
        "vowifi": "VoWIFI", "mms": "MMS", "ims": "IMS", "video": "VIDEO"}.items()}}))
def _(t):
    return monthly.usage_monthly(t.back(MONTH_D, 27).charged, MONTH_D)


def _zero_filled_sql():
    """Minima and maxima over the grid of all subscribers and all dates of a month, where a day without a value counts as 0."""
    ends = {s: (v, cond) for s, (v, cond) in RECHARGE_FACTS.items()}
    day = ", ".join(f"coalesce(min({v}){f' FILTER (WHERE {cond})' if cond else ''}, 0) AS lo_{s}, coalesce(max({v}){f' FILTER (WHERE {cond})' if cond else ''}, 0) AS hi_{s}" for s, (v, cond) in ends.items())
    grid = ", ".join(f"min(coalesce(lo_{s}, 0)) AS lo_{s}, max(coalesce(hi_{s}, 0)) AS hi_{s}" for s in ends)
    windows = ", ".join(f"{R(f'min(lo_{s}) FILTER (WHERE m <= {t})', f'min_{s}_T-{t}')}, {R(f'max(hi_{s}) FILTER (WHERE m <= {t})', f'max_{s}_T-{t}')}" for s in ends for t in range(1, 7))
    taken = ", ".join(f'z."{p}_{s}_T-{t}" AS "{p}_{s}_T-{t}"' for s in ends for t in range(1, 7) for p in ("min", "max"))
    return f"""WITH r AS ({monthly_rows('recharge')}), d AS (SELECT msisdn, m, s3_file_date, {day} FROM r WHERE m IS NOT NULL GROUP BY 1, 2, 3),
      days AS (SELECT DISTINCT m, s3_file_date FROM d), g AS (SELECT k.msisdn, k.m, days.s3_file_date FROM (SELECT DISTINCT msisdn, m FROM d) k JOIN days USING (m)),
      f AS (SELECT g.msisdn, g.m, {grid} FROM g LEFT JOIN d ON d.msisdn = g.msisdn AND d.m = g.m AND d.s3_file_date = g.s3_file_date GROUP BY 1, 2),
      z AS (SELECT msisdn, {windows} FROM f GROUP BY 1)
    SELECT c.* REPLACE ({taken}) FROM ({cumulative_sql(monthly_rows('recharge'), RECHARGE_FACTS)}) c JOIN z USING (msisdn)"""


@query("family_monthly_air_zero_filled", _zero_filled_sql)
def _(t):
    return monthly.recharge_monthly_daily(t.back(MONTH_D, 27).recharge, MONTH_D)


@query("family_monthly_vascloud", lambda: cumulative_sql(
    f"SELECT *, CASE WHEN s3_file_date > '20240115' AND s3_file_date <= '20240215' THEN 1 WHEN s3_file_date > '20231215' AND s3_file_date <= '20240115' THEN 2 END AS m FROM ({role_sql('vas')})",
    {"value_full": ("value", None)}))
def _(t):
    return monthly.numeric_monthly(t.back("20240215").vas, "20240215", {"value": "value"})


def _calls_sql(members: bool):
    src = role_sql("call")
    pairs = {"MOC": "MTC", "MTC": "MOC", "SMO": "SMT", "SMT": "SMO", "ROA": "ROA", "CF": "CF"}
    seen = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs.items())
    rows = (f"SELECT msisdn, call_type AS kind, call_duration AS v, {month_case()} AS m FROM ({src}) WHERE call_type <> 'OTH' UNION ALL "
            f"SELECT party_number, CASE call_type {seen} END, call_duration, {month_case()} FROM ({src}) WHERE call_type <> 'OTH'")
    if members:
        rows = f"SELECT * FROM ({rows}) WHERE msisdn IN (SELECT msisdn FROM ({src}) WHERE imsi LIKE '45202%')"
    return cumulative_sql(rows, {k: ("v", f"kind = '{k}'") for k in ("MOC", "MTC", "SMO", "SMT", "ROA", "CF")})


@query("family_monthly_voice_msc", lambda: _calls_sql(True))
def _(t):
    return monthly.calls_monthly(t.back(MONTH_D, 27).call, MONTH_D, t.call.where("imsi LIKE '45202%'").select("msisdn").distinct())


@query("family_monthly_voice_volte", lambda: _calls_sql(False))
def _(t):
    from rollspan.sources.tables import cutover_union
    return monthly.calls_monthly(cutover_union(t.back(MONTH_D, 27).call, t.back(MONTH_D, 27).call, "s3_file_date", "20010501"), MONTH_D)


@query("family_monthly_2friend", lambda: cumulative_sql(
    f"SELECT sender AS msisdn, 'sender' AS role, amount, {month_case()} AS m FROM ({role_sql('transfer')}) UNION ALL "
    f"SELECT receiver, 'receiver', amount, {month_case()} FROM ({role_sql('transfer')})",
    {f"amount_{r}": ("amount", f"role = '{r}'") for r in ("sender", "receiver")}))
def _(t):
    return monthly.transfers_monthly(t.back(MONTH_D, 27).transfer, MONTH_D)


@query("family_monthly_udv", lambda: cumulative_sql(monthly_rows("credit"), {"amount_full": ("amount", None)}))
def _(t):
    return monthly.numeric_monthly(t.back(MONTH_D, 27).credit, MONTH_D, {"amount": "amount"})


@query("family_monthly_utn", lambda: cumulative_sql(monthly_rows("credit"), {"credit_amount_full": ("credit_amount", None)}))
def _(t):
    return monthly.numeric_monthly_daily(t.back(MONTH_D, 27).credit, MONTH_D, {"credit_amount": "credit_amount"})


_BILL_MONTH = "SELECT ma_tb AS msisdn, *, CASE s3_file_date WHEN '200104' THEN 3 WHEN '200103' THEN 4 WHEN '200102' THEN 5 WHEN '200101' THEN 6 END AS m FROM ({})"


@query("family_monthly_no", lambda: cumulative_sql(_BILL_MONTH.format(role_sql("bill")), {f"{v}_full": (v, None) for v in ("nogoc", "thue")}, start=3))
def _(t):
    return monthly.billing_monthly(t.bill.withColumnRenamed("ma_tb", "msisdn"), MONTH_D, ["nogoc", "thue"])


@query("family_monthly_tra", lambda: cumulative_sql(_BILL_MONTH.format(role_sql("bill")), {f"{v}_full": (v, None) for v in ("tragoc", "trathue")}, start=3))
def _(t):
    return monthly.billing_monthly(t.bill.withColumnRenamed("ma_tb", "msisdn"), MONTH_D, ["tragoc", "trathue"])


def _revenue_sql(ms=("tot_rvn_amt", "voice_usg"), role="revenue"):
    steps = f"""SELECT accs_mthd_key AS msisdn, m, s3_file_date, {', '.join(f'sum({v}) AS {v}' for v in ms)}
        FROM ({monthly_rows(role)}) WHERE m IS NOT NULL GROUP BY 1, 2, 3"""
    deltas = ", ".join(f"coalesce(abs({v} - lag({v}) OVER w), {v}) AS d_{v}" for v in ms)
    rows = f"SELECT msisdn, m, {', '.join(f'CASE WHEN d_{v} > 0 THEN d_{v} END AS {v}' for v in ms)} FROM (SELECT *, {deltas} FROM ({steps}) WINDOW w AS (PARTITION BY msisdn, m ORDER BY s3_file_date))"
    return cumulative_sql(rows, {f"{v}_full": (v, None) for v in ms})


@query("family_monthly_smrs", _revenue_sql)
def _(t):
    return monthly.revenue_monthly(t.back(MONTH_D, 27).revenue, MONTH_D, ["tot_rvn_amt", "voice_usg"])


def _all_counters(part: str) -> None:
    """One query for each part of the counters."""
    measures = [m.lower() for m in MONTHLY_REVENUE[part]]

    @query(f"family_monthly_smrs_{part}", lambda: _revenue_sql(measures, "all_revenue"))
    def _(t):
        return monthly.revenue_monthly(t.back(MONTH_D, 27).all_revenue, MONTH_D, measures)


for _part in MONTHLY_REVENUE:
    _all_counters(_part)


# --- monthly categorical --------------------------------------------------------------------------------------------

def frequency_sql(rows: str, prefix: str, months=6) -> str:
    """``rows`` gives msisdn, item, m. Every window is counted and ranked on its own."""
    parts = []
    for t in range(1, months + 1):
        p = f"{prefix}_T-{t}_"
        parts.append(f"""(WITH c AS (SELECT msisdn, item, count(*) AS n FROM r WHERE item IS NOT NULL AND m <= {t} GROUP BY 1, 2),
            k AS (SELECT *, row_number() OVER (PARTITION BY msisdn ORDER BY n DESC, item) AS up, count(*) OVER (PARTITION BY msisdn) AS cnt, sum(n) OVER (PARTITION BY msisdn) AS total FROM c)
            SELECT msisdn, max(CASE WHEN up = 1 THEN item END) AS "{p}most_item", max(CASE WHEN up = cnt AND cnt > 1 THEN item END) AS "{p}least_item",
              max(cnt) AS "{p}unique", max(CASE WHEN up = 1 THEN n END) AS "{p}most_value", max(CASE WHEN up = cnt AND cnt > 1 THEN n END) AS "{p}least_value",
              max(CASE WHEN up = 1 THEN n / total END) AS "{p}most_percent", max(CASE WHEN up = cnt AND cnt > 1 THEN n / total END) AS "{p}least_percent"
            FROM k GROUP BY 1) q{t}""")
    cols = []
    for t in range(1, months + 1):
        p = f"{prefix}_T-{t}_"
        cols += [f'"{p}most_item"', f'"{p}least_item"', f'CAST(coalesce("{p}unique", 0) AS INT) AS "{p}unique"', I(f'coalesce("{p}most_value", 0)', f"{p}most_value"),
                 I(f'coalesce("{p}least_value", 0)', f"{p}least_value"), R(f'coalesce("{p}most_percent", 0)', f"{p}most_percent"), R(f'coalesce("{p}least_percent", 0)', f"{p}least_percent")]
    joins = " ".join(f"LEFT JOIN {p} USING (msisdn)" for p in parts)
    return f"WITH r AS ({rows}) SELECT msisdn, {', '.join(cols)} FROM (SELECT DISTINCT msisdn FROM r WHERE m IS NOT NULL AND item IS NOT NULL) b {joins}"


@query("family_monthly_cv207", lambda: frequency_sql(f"SELECT msisdn, province AS item, {month_case()} AS m FROM ({role_sql('ping')})", "province"))
def _(t):
    return monthly.province_monthly(t.back(MONTH_D, 27).ping, MONTH_D)


def _package_monthly_sql():
    src = role_sql("package")
    a, b = (frequency_sql(f"SELECT msisdn, {c} AS item, {month_case()} AS m FROM ({src})", c) for c in ("last_action", "service_code"))
    inactive = ", ".join(f"""count(*) FILTER (WHERE active <> 'Y' AND m <= {t}) AS "not_active_T-{t}\"""" for t in range(1, 7))
    return f"""SELECT * FROM ({a}) FULL OUTER JOIN ({b}) USING (msisdn) FULL OUTER JOIN (
        SELECT msisdn, {inactive} FROM (SELECT *, {month_case()} AS m FROM ({src})) WHERE m IS NOT NULL GROUP BY 1) USING (msisdn)"""


@query("family_monthly_3g_subs", _package_monthly_sql)
def _(t):
    return monthly.package_monthly(t.back(MONTH_D, 27).package, MONTH_D)


def _sender_monthly_sql():
    finance = ", ".join("'" + s.upper().replace(" ", "") + "'" for s in FINANCE_SENDERS)
    key = f"SELECT msisdn, replace(upper(sender), ' ', '') AS item, {month_case()} AS m FROM ({role_sql('brand')})"
    return f"SELECT * FROM ({frequency_sql(key, 'sender')}) FULL OUTER JOIN ({frequency_sql(f'SELECT * FROM ({key}) WHERE item IN ({finance})', 'finance')}) USING (msisdn)"


@query("family_monthly_brandname", _sender_monthly_sql)
def _(t):
    return monthly.sender_monthly(t.back(MONTH_D, 27).brand, MONTH_D)


# --- wide merge ------------------------------------------------------------------------------------------------------

MERGE_FEATURES = {"air": {"num": ["air_refill_sum_l12w", "air_balance_update_count_l24w"]}, "location": {"num": ["location_entropy_l4w"], "cat": ["location_top1_province_l4w"]},
                  "udv": {"num": ["udv_amount_avg_l24w"]}, "sub": {"num": ["sub_activated_flag"]}}
MERGE_SQL = f"""
WITH air AS (SELECT msisdn, sum(reillamount / 1000) FILTER (WHERE module = 'RefillRecord' AND s3_file_date >= '20010507') AS a, count(*) AS n
             FROM ({role_sql('recharge')}) WHERE s3_file_date >= '20010212' AND s3_file_date < '{HISTORY_D}' GROUP BY 1),
loc AS ({LOCATION_SQL}),
udv AS (SELECT msisdn, avg(amount) AS u FROM ({role_sql('credit')}) WHERE s3_file_date >= '20010212' AND s3_file_date < '{HISTORY_D}' GROUP BY 1),
sub AS ({{sub}})
SELECT msisdn, {R('a', 'air_refill_sum_l12w')}, n AS air_balance_update_count_l24w, location_entropy_l4w, location_top1_province_l4w,
       {R('u', 'udv_amount_avg_l24w')}, sub_activated_flag
FROM air FULL OUTER JOIN loc USING (msisdn) FULL OUTER JOIN udv USING (msisdn) FULL OUTER JOIN (SELECT msisdn, sub_activated_flag FROM sub) USING (msisdn)"""


def merge_tables(t):
    return {"air": weekly.AIR.features(t.back(HISTORY_D).recharge, HISTORY_D), "location": snapshots.location(t.back(HISTORY_D).ping, HISTORY_D),
            "udv": weekly.UDV.features(t.back(HISTORY_D).credit, HISTORY_D), "sub": snapshots.sub(t.back(HISTORY_D).balance, HISTORY_D)}


@query("family_merge", lambda: MERGE_SQL.format(sub=_sub_sql()))
def _(t):
    return merge.model_table(merge_tables(t), MERGE_FEATURES).frame


MODEL_FEATURES = MERGE_FEATURES | {
    "device": {"num": ["device_age", "device_has_nanosim", "device_has_mobile_internet"], "cat": ["device_os_family", "device_ram_category"]}}


def model_tables(t):
    device = snapshots.device(t.catalogue, HISTORY_D, absent="skip")
    return merge_tables(t) | {"device": merge.with_device(snapshots.tac_mapping(t.back(HISTORY_D).usage, HISTORY_D), device)}


def _model_sql():
    device = DEVICE_SQL.format(order=", ".join(f"{c} DESC NULLS LAST" for c in _DEVICE_ORDER))
    return f"""WITH m AS ({MERGE_SQL.format(sub=_sub_sql())}), tac AS ({TAC_SQL}), dev AS ({device})
        SELECT * FROM m FULL OUTER JOIN (SELECT msisdn, device_age, device_has_nanosim, device_has_mobile_internet, device_os_family, device_ram_category
        FROM tac LEFT JOIN dev USING (tac)) USING (msisdn) WHERE msisdn IS NOT NULL"""


@query("family_model_table", lambda: f"""SELECT msisdn, coalesce(air_refill_sum_l12w, 0.0) AS air_refill_sum_l12w, coalesce(air_balance_update_count_l24w, 0) AS air_balance_update_count_l24w,
    coalesce(location_entropy_l4w, 0.0) AS location_entropy_l4w, location_top1_province_l4w, coalesce(udv_amount_avg_l24w, 0.0) AS udv_amount_avg_l24w,
    coalesce(device_age, 0) AS device_age, coalesce(device_has_nanosim, 0) AS device_has_nanosim, coalesce(device_has_mobile_internet, 0) AS device_has_mobile_internet,
    device_os_family, device_ram_category FROM ({_model_sql()}) WHERE sub_activated_flag = 1""")
def _(t):
    merged = merge.filled_merge(model_tables(t), MODEL_FEATURES)
    return merge.active_only(merged.frame)


@query("merge_guards", lambda: f"""WITH m AS ({_model_sql()}), n AS (SELECT count(*) AS rows, count(DISTINCT msisdn) AS keys FROM m)
    SELECT CAST(step AS INT) AS step, "table", rows, matched, rows = keys AS ok FROM n, (
      SELECT 1 AS step, 'air' AS "table", count(air_balance_update_count_l24w) AS matched FROM m UNION ALL SELECT 2, 'location', count(location_entropy_l4w) FROM m
      UNION ALL SELECT 3, 'udv', count(udv_amount_avg_l24w) FROM m UNION ALL SELECT 4, 'sub', (SELECT count(*) FROM ({_sub_sql()})) FROM n
      UNION ALL SELECT 5, 'device', (SELECT count(*) FROM ({TAC_SQL})) FROM n)""")
def _(t):
    """The model table is written; its guards come from the same job."""
    merged = merge.filled_merge(model_tables(t), MODEL_FEATURES)
    merged.frame.write.parquet(f"{shared_folder(t.spark)}/model-table-{uuid.uuid4().hex}")
    return merged.report()


@query("family_merge_stored", lambda: MERGE_SQL.format(sub=_sub_sql()))
def _(t):
    """The same merge from snapshots that were stored by subscriber."""
    run = uuid.uuid4().hex
    stored = merge.store_features(merge_tables(t), MERGE_FEATURES, f"{shared_folder(t.spark)}/snapshots-{run}", f"snapshot_{run}", 8)
    return merge.model_table(stored, MERGE_FEATURES, only_valid=False).frame
