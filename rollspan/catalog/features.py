"""Projection, categorisation and aggregation operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollspan.catalog.registry import I, R, query, role_sql
from rollspan.catalog.roles import EVENTS_D, HISTORY_D, MONTH_D
from rollspan.catalog.monthly_families import DEVICE_COLS, cumulative_sql, month_case
from rollspan.catalog.weekly_families import AIR_TS, DAY, PACKAGE_DERIVE, SLOT, case_regex, wk
from rollspan.functions import calendar as cal, fixed_values as fx, numeric as nu, text as tx
from rollspan.operators import aggregates as ag, rollups as ru
from rollspan.operators.aggregates import Measure
from rollspan.plans import monthly, snapshots, weekly

_DAY = "replace(CAST(CAST(ts AS DATE) AS VARCHAR), '-', '')"


def events(t):
    return t.events.withColumn("s3_file_date", F.date_format("ts", "yyyyMMdd"))


# --- B: projections and predicates -----------------------------------------------------------

@query("valid_id_filter", f"""SELECT msisdn, count(*) AS n FROM (SELECT CASE WHEN k % 17 = 0 THEN substr(msisdn, 3) ELSE msisdn END AS msisdn FROM ({role_sql('scored')}))
       WHERE left(msisdn, 4) = '0084' AND length(msisdn) = 13 GROUP BY 1""")
def _(t):
    raw = t.scored.withColumn("msisdn", F.when(F.col("k") % 17 == 0, F.expr("substring(msisdn, 3)")).otherwise(F.col("msisdn")))
    return raw.where(tx.valid_id("msisdn")).groupBy("msisdn").agg(F.count("*").alias("n"))


PACK = f"SELECT *, CASE WHEN days < 0 THEN 'unknown' WHEN days <= 1 THEN 'one_day' WHEN days <= 7 THEN 'few_days' WHEN days <= 31 THEN 'few_weeks' WHEN days <= 180 THEN 'few_months' ELSE 'long_term' END AS tenure FROM (SELECT *, {PACKAGE_DERIVE} FROM ({role_sql('package')}))"


@query("like_categorizer", f"SELECT id, usage_category FROM ({PACK})")
def _(t):
    return t.package.select("id", tx.like_rules("service_id", fx.PACKAGE_PURPOSE, "other").alias("usage_category"))


@query("tenure_bucket", "SELECT p_partkey, CASE WHEN d < 0 THEN 'unknown' WHEN d <= 1 THEN 'one_day' WHEN d <= 7 THEN 'few_days' WHEN d <= 31 THEN 'few_weeks' WHEN d <= 180 THEN 'few_months' ELSE 'long_term' END AS tenure FROM (SELECT p_partkey, p_size * 5 - 10 AS d FROM part)")
def _(t):
    return t.part.select("p_partkey", tx.threshold_rules(F.col("p_size") * 5 - 10, fx.TENURE, fx.TENURE_LAST).alias("tenure"))


@query("enum_map", f"SELECT id, action_category FROM ({PACK})")
def _(t):
    return t.package.select("id", tx.map_ids("last_action", fx.LAST_ACTION, "other").alias("action_category"))


@query("regex_categorizer", f"SELECT doc_id, {case_regex('lower(trim(text))', fx.SENDER_CATEGORY, 'other')} AS category FROM documents")
def _(t):
    return t.documents.select("doc_id", tx.regex_rules(tx.tidy("text"), fx.SENDER_CATEGORY, "other").alias("category"))


@query("regex_categorizer_vas", f"SELECT doc_id, {case_regex('upper(text)', fx.VAS_CATEGORY, 'other')} AS category FROM documents")
def _(t):
    return t.documents.select("doc_id", tx.regex_rules(F.upper("text"), fx.VAS_CATEGORY, "other").alias("category"))


def groups_sql(col, groups, default):
    return "CASE " + " ".join(f"WHEN {col} IN ({', '.join(repr(x) for x in v)}) THEN '{k}'" for k, v in groups.items()) + f" ELSE '{default}' END"


@query("idlist_mapper", f"""SELECT l_orderkey, l_linenumber, {groups_sql('l_partkey % 10000', fx.ACCOUNT_UNIT, 'others')} AS unit,
    {groups_sql('l_partkey % 1400', fx.SERVICE_CLASS, 'unknown')} AS service_class, {groups_sql('200 + l_partkey % 600', fx.CONTINENT, 'unknown')} AS continent,
    {groups_sql('CAST(l_partkey % 800 AS VARCHAR)', fx.FEE_GROUPS, 'other')} AS fee FROM lineitem""")
def _(t):
    k = F.col("l_partkey")
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", tx.map_ids(k % 10000, fx.ACCOUNT_UNIT, "others").alias("unit"),
        tx.map_ids(k % 1400, fx.SERVICE_CLASS, "unknown").alias("service_class"),
        tx.map_ids(k % 600 + 200, fx.CONTINENT, "unknown").alias("continent"),
        tx.map_ids((k % 800).cast("string"), fx.FEE_GROUPS, "other").alias("fee"))


@query("calendar_slices", """SELECT event_id, dayofweek(ts) IN (0, 6) AS is_wk, CAST(hour(ts) AS INT) AS hour,
    CASE WHEN hour(ts) < 6 OR hour(ts) >= 18 THEN 'nt' WHEN hour(ts) < 12 THEN 'mo' ELSE 'af_ev' END AS time_slot,
    CASE WHEN hour(ts) BETWEEN 6 AND 17 THEN 'dt' ELSE 'nt' END AS time_slot_grp, CAST(strftime(ts, '%I') AS INT) AS legacy_hour FROM events""")
def _(t):
    legacy = cal.calendar_slices(t.events, "ts", legacy_hour12=True).select("event_id", F.col("hour").alias("legacy_hour"))
    base = cal.calendar_slices(t.events, "ts").select("event_id", "is_wk", "hour", "time_slot", "time_slot_grp")
    return base.join(legacy, "event_id")


@query("unit_rescale", f"SELECT l_orderkey, l_linenumber, {R('l_quantity / 60', 'minutes')}, {R('l_extendedprice / 1000000', 'mb')} FROM lineitem")
def _(t):
    return nu.rescale(t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_quantity").alias("minutes"), F.col("l_extendedprice").alias("mb")),
                      {"minutes": 60, "mb": 1e6})


@query("safe_timestamp", f"""SELECT id, strftime(coalesce(try_strptime(time_end, '%Y%m%d%H%M%S'), TIMESTAMP '1970-01-01'), '%Y%m%d%H%M%S') AS ended,
    strftime(coalesce(try_strptime(v, '%d/%m/%Y %H:%M:%S'), try_strptime(v, '%Y%m%d%H%M%S')), '%Y%m%d%H%M%S') AS mixed
    FROM (SELECT *, CASE id % 3 WHEN 0 THEN time_start WHEN 1 THEN '03/02/2001 10:20:30' ELSE 'x' END AS v FROM ({role_sql('package')}))""")
def _(t):
    v = F.when(F.col("id") % 3 == 0, F.col("time_start")).when(F.col("id") % 3 == 1, "03/02/2001 10:20:30").otherwise("x")
    return t.package.select(
        "id", F.date_format(cal.safe_ts("time_end", ["yyyyMMddHHmmss"], "1970-01-01 00:00:00"), "yyyyMMddHHmmss").alias("ended"),
        F.date_format(cal.safe_ts(v, ["dd/MM/yyyy HH:mm:ss", "yyyyMMddHHmmss"]), "yyyyMMddHHmmss").alias("mixed"))


@query("duration_days", f"SELECT id, {R('days', 'days')} FROM ({PACK})")
def _(t):
    return weekly.package_rows(t.package).select("id", F.col("package_duration_days").alias("days"))


@query("band_flags", """SELECT c_custkey, CAST(b > 0 AND b < 1000 AS INT) AS lt_1k, CAST(b > 0 AND b < 5000 AS INT) AS lt_5k, CAST(b > 0 AND b < 10000 AS INT) AS lt_10k,
    CAST(b = 0 AS INT) AS zero, CAST(b >= 1000 AND b < 5000 AS INT) AS "1k_to_5k", CAST(b >= 5000 AND b < 10000 AS INT) AS "5k_to_10k",
    CAST(b >= 10000 AND b < 20000 AS INT) AS "10k_to_20k", CAST(b >= 20000 AND b < 50000 AS INT) AS "20k_to_50k",
    CAST(b >= 50000 AND b < 100000 AS INT) AS "50k_to_100k", CAST(b >= 100000 AS INT) AS ge_100k FROM (SELECT c_custkey, c_acctbal * 12 AS b FROM customer)""")
def _(t):
    return nu.band_flags(t.customer.select("c_custkey", (F.col("c_acctbal") * 12).alias("b")), "b", fx.BALANCE_BANDS).drop("b")


@query("capability_flags", "SELECT p_partkey, CAST(p_size % 2 + p_size % 3 + CAST(p_size > 25 AS INT) > 1 AS INT) AS two_of, CASE WHEN nullif(p_size % 2, 0) + p_size % 3 >= 1 THEN 1 ELSE 0 END AS one_of FROM part")
def _(t):
    p = F.col("p_size")
    return t.part.select("p_partkey", tx.any_of([p % 2, p % 3, (p > 25).cast("int")]).alias("two_of"),
                         tx.any_of([F.nullif(p % 2, F.lit(0)), p % 3], at_least=1).alias("one_of"))


DEVICE_GROUP = ["device_age", "device_type", "device_manu", "device_continent", "device_chipset_family", "device_gpu_family", "device_ram_category", "device_has_bluetooth", "device_has_mobile_internet"]


@query("device_attributes", f"SELECT {', '.join(DEVICE_GROUP)}, count(*) AS n FROM (SELECT {DEVICE_COLS} FROM ({role_sql('catalogue')})) GROUP BY ALL")
def _(t):
    cols = snapshots.device_attributes(t.catalogue, 2001, absent="skip")
    return t.catalogue.select(*[cols[c].alias(c) for c in DEVICE_GROUP]).groupBy(*DEVICE_GROUP).agg(F.count("*").alias("n"))


@query("multivalue_bucket", "SELECT device_ram_category, count(*) AS n FROM (SELECT %s FROM (%s)) GROUP BY 1" % (DEVICE_COLS, role_sql("catalogue")))
def _(t):
    label = tx.multivalue_bucket("total_ram", "/", fx.RAM_BUCKETS, fx.RAM_LAST, fx.RAM_UNKNOWN, 100, 1024)
    return t.catalogue.groupBy(label.alias("device_ram_category")).agg(F.count("*").alias("n"))


@query("prefix_key", f"SELECT left(imei, 8) AS tac, count(*) AS n FROM ({role_sql('usage')}) GROUP BY 1")
def _(t):
    return t.usage.groupBy(tx.prefix_key("imei", 8).alias("tac")).agg(F.count("*").alias("n"))


@query("split_cell_id", f"SELECT nullif(split_part(cell, '-', 3), '') AS lac, nullif(split_part(cell, '-', 4), '') AS cell_id, count(*) AS n FROM ({role_sql('recharge')}) GROUP BY 1, 2")
def _(t):
    return t.recharge.groupBy(tx.part_of("cell", "-", 3).alias("lac"), tx.part_of("cell", "-", 4).alias("cell_id")).agg(F.count("*").alias("n"))


@query("recency_wins", """WITH a AS (SELECT o_custkey + 5 AS k, max(o_orderdate) AS ta, 'order' AS va FROM orders GROUP BY 1),
    b AS (SELECT l_suppkey AS k, max(l_shipdate) AS tb, 'ship' AS vb FROM lineitem GROUP BY 1)
    SELECT k, CASE WHEN coalesce(ta, DATE '1980-01-01') >= coalesce(tb, DATE '1980-01-01') THEN va ELSE vb END AS v FROM a FULL OUTER JOIN b USING (k)""")
def _(t):
    a = t.orders.groupBy((F.col("o_custkey") + 5).alias("k")).agg(F.max("o_orderdate").cast("timestamp").alias("ta"), F.lit("order").alias("va"))
    b = t.lineitem.groupBy(F.col("l_suppkey").alias("k")).agg(F.max("l_shipdate").cast("timestamp").alias("tb"), F.lit("ship").alias("vb"))
    return snapshots.recency_wins(a, b, "k", "ta", "tb", {"v": ("va", "vb")})


@query("sanitize_key", "SELECT c_custkey, replace(upper(c_mktsegment || ' x '), ' ', '') AS k, lower(trim(' ' || c_name)) AS tidy FROM customer")
def _(t):
    return t.customer.select("c_custkey", tx.sanitize(F.concat("c_mktsegment", F.lit(" x "))).alias("k"), tx.tidy(F.concat(F.lit(" "), "c_name")).alias("tidy"))


_FIN = ", ".join("'" + s.upper().replace(" ", "") + "'" for s in fx.FINANCE_SENDERS)


@query("whitelist_filter", f"SELECT msisdn, count(*) AS n FROM ({role_sql('brand')}) WHERE replace(upper(sender), ' ', '') IN ({_FIN}) GROUP BY 1")
def _(t):
    keep = [s.upper().replace(" ", "") for s in fx.FINANCE_SENDERS]
    return t.brand.where(tx.sanitize("sender").isin(keep)).groupBy("msisdn").agg(F.count("*").alias("n"))


_YEARS = "max(date_diff('day', CAST(account_activated_date AS DATE), DATE '2001-07-30') / 365)"


@query("tenure_years", f"SELECT account_id, {R(_YEARS, 'years')} FROM ({role_sql('balance')}) GROUP BY 1")
def _(t):
    return t.balance.groupBy("account_id").agg(F.max(cal.years_since(F.to_date("account_activated_date"), HISTORY_D)).alias("years"))


@query("session_flags", f"""SELECT msisdn, count(*) FILTER (WHERE duration > 300) AS long_n, count(*) FILTER (WHERE duration < 30) AS short_n,
    count(*) FILTER (WHERE data_volume_downlink <> 0) AS down_n FROM ({role_sql('session')}) GROUP BY 1""")
def _(t):
    ms = [Measure("long_n", "rows", None, "duration / 60 > 5"), Measure("short_n", "rows", None, "duration / 60 < 0.5"), Measure("down_n", "rows", None, "data_volume_downlink <> 0")]
    return ag.sliced_stats(t.session, ["msisdn"], ms)


# --- D: aggregations ------------------------------------------------------------------------------

_STATS = {"sum": "sum(value)", "avg": "avg(value)", "min": "min(value)", "max": "max(value)", "std": "stddev_samp(value)"}


@query("group_stats", f"SELECT user_id, count(value) AS count_value, {', '.join(R(e, f'{s}_value') for s, e in _STATS.items())} FROM events GROUP BY 1")
def _(t):
    return ag.group_stats(t.events, ["user_id"], {"value": "value"})


@query("group_sumsquare", f"SELECT user_id, {R('sum(value * value)', 'total_sq')}, count(value) AS n FROM events GROUP BY 1")
def _(t):
    return ag.sliced_stats(t.events, ["user_id"], [Measure("total_sq", "sumsq", "value"), Measure("n", "count", "value")])


WEEK = f"ts >= TIMESTAMP '2024-01-22' AND ts < TIMESTAMP '2024-01-29'"
_SL = {"wk": "dayofweek(ts) IN (0, 6)", "wd": "dayofweek(ts) NOT IN (0, 6)", "dt": "hour(ts) BETWEEN 6 AND 17", "nt": "hour(ts) NOT BETWEEN 6 AND 17"}
SLICED_SQL = f"""SELECT user_id, count(*) AS count_l1w, {', '.join(f'nullif(count(*) FILTER (WHERE {c}), 0) AS count_{s}_l1w' for s, c in _SL.items())},
    {R('sum(value)', 'sum_l1w')}, {', '.join(R(f'sum(value) FILTER (WHERE {c})', f'sum_{s}_l1w') for s, c in _SL.items())}
    FROM events WHERE {WEEK} GROUP BY 1"""


def sliced_events(t, weeks=1):
    rows = ru.lookback(cal.calendar_slices(events(t), "ts"), "s3_file_date", EVENTS_D, weeks)
    return rows


@query("sliced_aggregates", SLICED_SQL)
def sliced_aggregates(t):
    ms = [*ag.slices(Measure("count", "rows"), weekly.ALL_PARTS), *ag.slices(Measure("sum", "sum", "value"), weekly.ALL_PARTS)]
    return ag.sliced_stats(sliced_events(t), ["user_id"], [Measure(f"{m.name}_l1w", m.agg, m.value, m.where) for m in ms])


TYPES = ("click", "error", "purchase", "signup", "view")


@query("category_conditional_stats", f"SELECT user_id, {', '.join(R(f'{a}(value) FILTER (WHERE event_type = {c!r})', f'{c}_{a}') for c in TYPES for a in ('sum', 'min', 'max'))} FROM events GROUP BY 1")
def _(t):
    return ag.group_stats(t.events, ["user_id"], {"": "value"}, ("sum", "min", "max"), {c: f"event_type = '{c}'" for c in TYPES}, name="{filter}_{stat}")


@query("category_split_aggregate", f"""SELECT * FROM (SELECT user_id FROM events GROUP BY 1) u {' '.join(
    f'LEFT JOIN (SELECT user_id, count(*) AS {c}_n, {R("sum(value)", f"{c}_sum")} FROM events WHERE event_type = {c!r} AND value > 8 GROUP BY 1) {c}_t USING (user_id)' for c in TYPES)}""")
def _(t):
    ms = [m for c in TYPES for m in (Measure(f"{c}_n", "hits", None, f"event_type = '{c}' AND value > 8"), Measure(f"{c}_sum", "sum", "value", f"event_type = '{c}' AND value > 8"))]
    return ag.sliced_stats(t.events, ["user_id"], ms)


@query("distinct_counts", f"SELECT user_id, count(DISTINCT {_DAY}) AS days, count(DISTINCT event_type) AS kinds FROM events GROUP BY 1")
def _(t):
    return ag.sliced_stats(events(t), ["user_id"], [Measure("days", "ndistinct", "s3_file_date"), Measure("kinds", "ndistinct", "event_type")])


@query("conditional_distinct_stats", f"""SELECT o_custkey, {', '.join(f"count(DISTINCT l_partkey) FILTER (WHERE l_returnflag = '{f}') AS items_{f}, {R(f'stddev_samp(l_extendedprice) FILTER (WHERE l_returnflag = {f!r})', f'price_std_{f}')}, {R(f'max(l_extendedprice) FILTER (WHERE l_returnflag = {f!r})', f'price_max_{f}')}" for f in 'ANR')}
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def _(t):
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    ms = [m for f in "ANR" for m in (
        Measure(f"price_std_{f}", "std", "l_extendedprice", f"l_returnflag = '{f}'"),
        Measure(f"price_max_{f}", "max", "l_extendedprice", f"l_returnflag = '{f}'"))]
    items = ag.distinct_stats(rows, ["o_custkey"], "l_partkey", {f"items_{f}": f"l_returnflag = '{f}'" for f in "ANR"})
    return ag.sliced_stats(rows, ["o_custkey"], ms).join(items, "o_custkey")


@query("rollup_daily_to_week", f"""WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, sum(value) AS s FROM events GROUP BY 1, 2)
    SELECT user_id, CAST(floor((DATE '2024-01-29' - day - 1) / 7) AS INT) AS week_back, {R('sum(s)', 'value_sum')}, {R('min(s)', 'value_dmin')}, {R('max(s)', 'value_dmax')}
    FROM d WHERE day >= DATE '2024-01-01' AND day < DATE '2024-01-29' GROUP BY 1, 2""")
def _(t):
    daily = ag.sliced_stats(events(t), ["user_id", "s3_file_date"], [Measure("value_sum", "sum", "value")])
    return ru.daily_to_weekly(daily, ["user_id"], "s3_file_date", EVENTS_D, ["value_sum"], {"value_sum": "value_{op}"}, 4)[0]


def _event_weekly(t):
    ms = [Measure("n", "rows"), Measure("value_sum", "sum", "value"), Measure("value_min", "min", "value"), Measure("value_max", "max", "value")]
    return ru.weekly(events(t), ["user_id"], "s3_file_date", EVENTS_D, ms, 4), ms


_W14 = {1: WEEK, 4: "ts >= TIMESTAMP '2024-01-01' AND ts < TIMESTAMP '2024-01-29'"}


def _windows_sql(cols):
    one = "\n LEFT JOIN ".join(f"(SELECT user_id, {', '.join(c.format(w=f'l{n}w') for c in cols)} FROM events WHERE {cond} GROUP BY 1) w{n}" + ("" if n == 4 else " USING (user_id)")
                              for n, cond in sorted(_W14.items(), reverse=True))
    return f"SELECT * FROM {one}"


@query("rollup_week_to_windows", _windows_sql(["count(*) AS n_{w}", R("sum(value)", "value_sum_{w}"), R("min(value)", "value_min_{w}"), R("max(value)", "value_max_{w}")]))
def _(t):
    weeks, ms = _event_weekly(t)
    return ru.widen(weeks, ["user_id"], ms, (1, 4))


@query("rollup_weighted_avg", _windows_sql([R("avg(value)", "value_avg_{w}")]))
def _(t):
    weeks, ms = _event_weekly(t)
    out = ru.add_weighted_avg(ru.widen(weeks, ["user_id"], ms, (1, 4)), {"value_avg": ("value_sum", "n")}, (1, 4))
    return out.select("user_id", "value_avg_l1w", "value_avg_l4w")


@query("rollup_daily_average", f"SELECT user_id, {R('sum(value) FILTER (WHERE ' + WEEK + ') / 7', 'value_davg_l1w')}, {R('sum(value) / 28', 'value_davg_l4w')} FROM events WHERE {_W14[4]} GROUP BY 1")
def _(t):
    weeks, ms = _event_weekly(t)
    out = ru.add_per_day(ru.widen(weeks, ["user_id"], ms, (1, 4)), {"value_davg": "value_sum"}, (1, 4))
    return out.select("user_id", "value_davg_l1w", "value_davg_l4w")


@query("band_share_windows", f"SELECT user_id, {R('avg(value) FILTER (WHERE ' + WEEK + ')', 'v_avg_l1w')}, {R('avg(value)', 'v_avg_l4w')}, {R('avg(CAST(value < 10 AS INT)) FILTER (WHERE ' + WEEK + ')', 'low_pct_l1w')}, {R('avg(CAST(value < 10 AS INT))', 'low_pct_l4w')}, {R('stddev_samp(value) FILTER (WHERE ' + WEEK + ')', 'v_std_l1w')}, {R('stddev_samp(value)', 'v_std_l4w')} FROM events WHERE {_W14[4]} GROUP BY 1")
def _(t):
    rows = nu.band_flags(events(t), "value", {"low": (None, 10)})
    return ru.window_stats(rows, ["user_id"], "s3_file_date", EVENTS_D, {"v_avg": ("avg", "value"), "low_pct": ("avg", "low"), "v_std": ("std", "value")}, (1, 4))


@query("rollup_month_steps", f"""WITH m AS (SELECT o_custkey, CAST(floor((DATE '2001-07-30' - CAST(o_orderdate AS DATE)) / 28) AS INT) AS step, sum(o_totalprice) AS v FROM orders
    WHERE o_orderdate > TIMESTAMP '2001-02-12' AND o_orderdate <= TIMESTAMP '2001-07-30' GROUP BY 1, 2)
    SELECT o_custkey, {R('sum(v) FILTER (WHERE step < 1)', 'v_sum_l1m')}, {', '.join(R(f'{a}(v) FILTER (WHERE step < {k})', f'v_{a}_l{k}m') for k in (2, 3, 6) for a in ('sum', 'min', 'max', 'avg'))} FROM m GROUP BY 1""")
def _(t):
    step = F.floor(F.datediff(F.lit("2001-07-30").cast("date"), F.col("o_orderdate")) / 28).cast("int")
    rows = t.orders.where((F.col("o_orderdate") > "2001-02-12") & (F.col("o_orderdate") <= "2001-07-30"))
    monthly_ = rows.groupBy("o_custkey", step.alias("step")).agg(F.sum("o_totalprice").alias("v_sum"))
    return ru.month_steps_rollup(monthly_, ["o_custkey"], "step", ["v_sum"])


@query("cell_to_subscriber_rollup", f"SELECT l_suppkey, {R('sum(l_quantity)', 'pn_q')}, {R('sum(l_tax)', 'pn_t')} FROM lineitem GROUP BY 1")
def _(t):
    fine = t.lineitem.groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("q"), F.sum("l_tax").alias("t"))
    return ru.collapse(fine, ["l_suppkey"], ["q", "t"])


_MONTH = "o_orderdate > TIMESTAMP '2001-06-15' AND o_orderdate <= TIMESTAMP '2001-07-15'"


@query("monthly_from_daily_partials", f"""WITH r AS (SELECT * FROM orders WHERE {_MONTH}), days AS (SELECT DISTINCT o_orderdate FROM r),
    d AS (SELECT o_custkey, o_orderdate, sum(o_totalprice) AS s, count(*) AS n, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM r GROUP BY 1, 2),
    g AS (SELECT k.o_custkey, days.o_orderdate, coalesce(s, 0) AS s, coalesce(n, 0) AS n, coalesce(lo, 0) AS lo, coalesce(hi, 0) AS hi
          FROM (SELECT DISTINCT o_custkey FROM r) k CROSS JOIN days LEFT JOIN d ON d.o_custkey = k.o_custkey AND d.o_orderdate = days.o_orderdate)
    SELECT o_custkey, {R('sum(s)', 'sum_p')}, {I('sum(n)', 'count_p')}, {R('sum(s) / sum(n)', 'avg_p')}, min(lo) AS min_p, max(hi) AS max_p FROM g GROUP BY 1""")
def _(t):
    rows = t.orders.where((F.col("o_orderdate") > "2001-06-15") & (F.col("o_orderdate") <= "2001-07-15"))
    p = "o_totalprice"
    daily = ag.sliced_stats(rows, ["o_custkey", "o_orderdate"], [Measure(f"{a}_p", a, p) for a in ("sum", "count", "min", "max", "sumsq")])
    return ru.monthly_from_daily(daily, ["o_custkey"], ["p"], zero_fill=True, days=30).drop("sumsq_p")


@query("cumulative_month_windows", lambda: cumulative_sql(f"SELECT *, {month_case()} AS m FROM ({role_sql('credit')})", {"amount_full": ("amount", None)}))
def _(t):
    rows = monthly.month_rows(t.credit, MONTH_D)
    ms, stems = monthly.value_measures({"amount": "amount"}, {"full": None})
    return ru.cumulative_months(ag.sliced_stats(rows, ["msisdn", "m"], ms), ["msisdn"], "m", stems)


_FREQ = "SELECT source, string_agg(item || ':' || CAST(n AS VARCHAR), ',' ORDER BY item) AS freq FROM (SELECT source, lang AS item, count(*) AS n FROM documents {w} GROUP BY 1, 2) GROUP BY 1"


@query("frequency_map", _FREQ.format(w=""))
def _(t):
    return ag.frequency_map(t.documents, ["source"], "lang").select("source", tx.map_text("freq").alias("freq"))


@query("frequency_map_merge", _FREQ.format(w=""))
def _(t):
    a = ag.frequency_map(t.documents.where("doc_id % 2 = 0"), ["source"], "lang")
    b = ag.frequency_map(t.documents.where("doc_id % 2 = 1"), ["source"], "lang")
    return ag.merge_frequency(a, b, ["source"]).select("source", tx.map_text("freq").alias("freq"))


@query("frequency_top_items", """WITH c AS (SELECT source, CAST(n_chars AS VARCHAR) AS item, count(*) AS n FROM documents GROUP BY 1, 2)
    SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY source ORDER BY n DESC, encode(item)) AS INT) AS rank FROM c) WHERE rank <= 5""")
def _(t):
    """Most frequent items of an open list, from states of four parts of the rows."""
    parts = [ag.frequency_counts(t.documents.where(f"doc_id % 4 = {i}"), ["source"], "n_chars") for i in range(4)]
    return ag.top_items(ag.merge_counts(parts, ["source"]), ["source"], 5)


@query("frequency_map_stats", f"""WITH c AS (SELECT source, lang, count(*) AS n FROM documents GROUP BY 1, 2),
    k AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, lang) AS up, count(*) OVER (PARTITION BY source) AS cnt, sum(n) OVER (PARTITION BY source) AS tot FROM c)
    SELECT source, max(CASE WHEN up = 1 THEN lang END) AS most_item, max(CASE WHEN up = cnt AND cnt > 1 THEN lang END) AS least_item, CAST(max(cnt) AS INT) AS "unique",
    max(CASE WHEN up = 1 THEN n END) AS most_value, coalesce(max(CASE WHEN up = cnt AND cnt > 1 THEN n END), 0) AS least_value,
    {R('max(CASE WHEN up = 1 THEN n / tot END)', 'most_percent')}, {R('coalesce(max(CASE WHEN up = cnt AND cnt > 1 THEN n / tot END), 0)', 'least_percent')} FROM k GROUP BY 1""")
def _(t):
    return ag.frequency_stats(t.documents, ["source"], "lang")


_CATS = "SELECT user_id, {} FROM (SELECT user_id, count(*) AS n, {} FROM events GROUP BY 1)"
_COUNTS = ", ".join(f"count(*) FILTER (WHERE event_type = '{c}') AS {c}" for c in TYPES)


def _shares(t):
    counts = ag.sliced_stats(t.events, ["user_id"], [Measure("n", "rows"), *[Measure(c, "rows", None, f"event_type = '{c}'") for c in TYPES]])
    return nu.shares(counts, {f"{c}_pct": c for c in TYPES}, "n")


@query("category_share", _CATS.format(", ".join(R(f"{c} / n", f"{c}_pct") for c in TYPES), _COUNTS))
def _(t):
    return _shares(t).select("user_id", *[f"{c}_pct" for c in TYPES])


@query("category_entropy", _CATS.format(R(" + ".join(f"CASE WHEN {c} > 0 THEN -({c} / n) * log2({c} / n) ELSE 0 END" for c in TYPES), "entropy"), _COUNTS))
def _(t):
    return _shares(t).select("user_id", nu.share_entropy([f"{c}_pct" for c in TYPES]).alias("entropy"))


@query("category_pair_ratio", _CATS.format(", ".join(R(f"({a} / n) / nullif({b} / n, 0)", f"{a}_vs_{b}") for i, a in enumerate(TYPES) for b in TYPES[i + 1:]), _COUNTS))
def _(t):
    out = nu.pair_ratios(_shares(t), {c: f"{c}_pct" for c in TYPES}, "{a}_vs_{b}")
    return out.select("user_id", *[c for c in out.columns if "_vs_" in c])


@query("value_entropy", f"SELECT user_id, {R('sum(-(n / tot) * log2(n / tot))', 'entropy')} FROM (SELECT *, sum(n) OVER (PARTITION BY user_id) AS tot FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2)) GROUP BY 1")
def _(t):
    return ag.value_entropy(t.events, ["user_id"], "event_type")


@query("window_trend_ratio", f"SELECT user_id, {R('CAST(count(*) FILTER (WHERE ' + WEEK + ') AS DOUBLE) / nullif(count(*), 0)', 'n_l1w_vs_l4w')}, {R('sum(value) FILTER (WHERE ' + WEEK + ') / nullif(sum(value), 0)', 'value_sum_l1w_vs_l4w')} FROM events WHERE {_W14[4]} AND user_id IN (SELECT user_id FROM events WHERE {WEEK}) GROUP BY 1")
def _(t):
    weeks, ms = _event_weekly(t)
    out = ru.trend_ratios(ru.widen(weeks, ["user_id"], ms, (1, 4)), ["n", "value_sum"], (1, 4))
    return out.where("n_l1w IS NOT NULL").select("user_id", "n_l1w_vs_l4w", "value_sum_l1w_vs_l4w")


@query("intra_window_ratio", f"SELECT user_id, {R('count(*) FILTER (WHERE hour(ts) NOT BETWEEN 6 AND 17) / count(*)', 'nt_ratio')}, {R('sum(value) FILTER (WHERE dayofweek(ts) IN (0, 6)) / nullif(sum(value), 0)', 'wk_ratio')} FROM events GROUP BY 1")
def _(t):
    rows = cal.calendar_slices(t.events, "ts")
    s = ag.sliced_stats(rows, ["user_id"], [Measure("n", "rows"), Measure("nt", "hits", None, "time_slot_grp = 'nt'"), Measure("v", "sum", "value"), Measure("wk", "sum", "value", "is_wk")])
    return s.select("user_id", nu.ratio("nt", "n").alias("nt_ratio"), nu.ratio("wk", "v").alias("wk_ratio"))


@query("cross_type_totals", f"""SELECT user_id, {R('CASE WHEN coalesce(a, b) IS NOT NULL THEN coalesce(a, 0) + coalesce(b, 0) END', 'total_sum')}
    FROM (SELECT user_id, sum(value) FILTER (WHERE event_type = 'click' AND value > 20) AS a, sum(value) FILTER (WHERE event_type = 'error' AND value > 20) AS b FROM events GROUP BY 1)""")
def _(t):
    s = ag.sliced_stats(t.events, ["user_id"], [Measure(n, "sum", "value", f"event_type = '{k}' AND value > 20") for n, k in (("a", "click"), ("b", "error"))])
    return s.select("user_id", nu.total(["a", "b"]).alias("total_sum"))


@query("role_swap_call_stats", f"""WITH x AS (SELECT l_suppkey AS k, l_returnflag AS f, l_quantity AS v FROM lineitem UNION ALL
    SELECT l_partkey, CASE l_returnflag WHEN 'A' THEN 'R' WHEN 'R' THEN 'A' ELSE 'N' END, l_quantity FROM lineitem)
    SELECT k, {', '.join(R(f'{fn}(v) FILTER (WHERE f = {f!r})', f'{f}_{s}') for f in 'ARN' for s, fn in (('sum', 'sum'), ('avg', 'avg'), ('min', 'min'), ('max', 'max'), ('std', 'stddev_samp')))},
    {', '.join(f"count(v) FILTER (WHERE f = '{f}') AS {f}_count" for f in 'ARN')} FROM x GROUP BY 1""")
def _(t):
    return ag.role_swap_stats(t.lineitem, "l_suppkey", "l_partkey", "l_returnflag", "l_quantity", {"A": "R", "R": "A"}, ["N"], "k",
                              ("sum", "avg", "count", "min", "max", "std"))


@query("latest_day_attributes", f"""SELECT account_id, max(account_activated_flag) AS flag, max(service_class_id) AS cls FROM
    (SELECT *, max(s3_file_date) OVER (PARTITION BY account_id) AS md FROM ({role_sql('balance')}) WHERE s3_file_date >= '20010101' AND s3_file_date < '{HISTORY_D}') WHERE s3_file_date = md GROUP BY 1""")
def _(t):
    return snapshots.latest_day_attributes(t.balance, "account_id", "s3_file_date", {"flag": "account_activated_flag", "cls": "service_class_id"}, "20010101", HISTORY_D)


@query("count_not_marker", f"SELECT msisdn, count(*) FILTER (WHERE active <> 'Y') AS n FROM ({role_sql('package')}) GROUP BY 1")
def _(t):
    return t.package.groupBy("msisdn").agg(F.count_if(F.col("active") != "Y").alias("n"))


@query("action_counts_by_category", f"""SELECT msisdn, count(*) AS n, {', '.join(f"count(*) FILTER (WHERE usage_category = '{c}' AND action_category = '{a}') AS {c}_{a}" for c in ('family', 'office', 'public', 'relax', 'other') for a in ('active', 'cancel'))} FROM ({PACK}) GROUP BY 1""")
def _(t):
    ms = [Measure("n", "rows")] + [Measure(f"{c}_{a}", "rows", None, f"usage_category = '{c}' AND action_category = '{a}'")
                                   for c in ("family", "office", "public", "relax", "other") for a in ("active", "cancel")]
    return ag.sliced_stats(weekly.package_rows(t.package), ["msisdn"], ms)


@query("scalar_functions", """SELECT o_orderkey, left(o_orderpriority, 3) AS a, CAST(length(o_orderpriority) AS INT) AS b, lower(o_orderpriority) AS c, substr(o_orderpriority, 2, 4) AS d,
    split_part(o_orderpriority, '-', 2) AS e, regexp_replace(o_orderpriority, '[0-9]-', '#') AS f, regexp_matches(o_orderpriority, '^[12]') AS g, o_orderpriority LIKE '%I%' AS h,
    o_orderstatus || '|' || o_orderpriority AS i, replace(o_orderpriority, '-', '_') AS j, sha256(o_orderpriority) AS k,
    CAST(dayofweek(o_orderdate) + 1 AS INT) AS l, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-08-01') AS INT) AS m, CAST(year(o_orderdate) AS INT) AS n,
    strftime(o_orderdate, '%Y%m%d') AS o, strftime(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH, '%Y%m%d') AS p,
    round(abs(sqrt(o_totalprice) - 300), 4) AS q, round(log2(o_totalprice), 6) AS r, CAST(floor(o_totalprice) AS BIGINT) AS s, round(pow(o_totalprice / 1000, 1.3), 3) AS t,
    greatest(o_totalprice, 1000.0) AS u, least(o_totalprice, 1000.0) AS v, coalesce(nullif(o_orderstatus, 'P'), 'none') AS w FROM orders""")
def _(t):
    p, d, x = F.col("o_orderpriority"), F.col("o_orderdate"), F.col("o_totalprice")
    return t.orders.select(
        "o_orderkey", F.left(p, F.lit(3)).alias("a"), F.length(p).alias("b"), F.lower(p).alias("c"), F.substring(p, 2, 4).alias("d"),
        F.split(p, "-").getItem(1).alias("e"), F.regexp_replace(p, "[0-9]-", "#").alias("f"), p.rlike("^[12]").alias("g"), p.like("%I%").alias("h"),
        F.concat_ws("|", "o_orderstatus", p).alias("i"), F.replace(p, F.lit("-"), F.lit("_")).alias("j"), F.sha2(p, 256).alias("k"),
        F.dayofweek(d).alias("l"), F.datediff(F.lit("2001-08-01").cast("date"), d).alias("m"), F.year(d).alias("n"),
        F.date_format(d, "yyyyMMdd").alias("o"), F.date_format(F.add_months(d, 1), "yyyyMMdd").alias("p"),
        F.round(F.abs(F.sqrt(x) - 300), 4).alias("q"), F.round(F.log2(x), 6).alias("r"), F.floor(x).alias("s"), F.round(F.pow(x / 1000, F.lit(1.3)), 3).alias("t"),
        F.greatest(x, F.lit(1000.0)).alias("u"), F.least(x, F.lit(1000.0)).alias("v"), F.coalesce(F.nullif("o_orderstatus", F.lit("P")), F.lit("none")).alias("w"))
