"""Data-quality checks, logs and job periods. The logs they read are derived from the
tables: one observation per key and day of ``orders``."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollspan.catalog.frames import DATED_SQL, GAPPY_SQL, dated, gappy, scratch
from rollspan.catalog.registry import R, query
from rollspan.functions import calendar as cal
from rollspan.operators import jobs, quality as dq
from rollspan.sources import tables as src

_COLS = ("status_item", "prio", "price", "cust")


def _long(value):
    return " UNION ALL ".join(f"SELECT '{c}' AS feature_name, {value.format(c=c)} FROM ({GAPPY_SQL})" for c in _COLS)


@query("dq_null_ratio", _long("round(count(*) FILTER (WHERE {c} IS NULL) / count(*), 4) AS null_ratio"))
def _(t):
    return dq.completeness(gappy(t), _COLS).select("feature_name", "null_ratio")


@query("dq_null_count", _long("count(*) FILTER (WHERE {c} IS NULL) AS null_count"))
def _(t):
    return dq.completeness(gappy(t), _COLS).select("feature_name", "null_count")


@query("dq_row_count", _long("count({c}) AS row_count"))
def _(t):
    return dq.completeness(gappy(t), _COLS).select("feature_name", "row_count")


_NAMES = "(SELECT string_agg(column_name, ',' ORDER BY column_name) FROM (DESCRIBE {}))"


@query("dq_column_names", f"SELECT *, CASE WHEN names = ref_names THEN 'PASS' ELSE 'WARNING' END AS status FROM (SELECT {_NAMES.format('customer')} AS names, {_NAMES.format('supplier')} AS ref_names)")
def _(t):
    return dq.column_names(dq.schema_table(t.customer), dq.schema_table(t.supplier))


_TYPE = "CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'INTEGER' THEN 'int' ELSE lower(column_type) END"


@query("dq_column_types", f"""SELECT col_name, data_type, ref_type, CASE WHEN data_type IS NOT DISTINCT FROM ref_type THEN 'PASS' ELSE 'WARNING' END AS status
    FROM (SELECT column_name AS col_name, {_TYPE} AS data_type FROM (DESCRIBE labels)) a FULL OUTER JOIN
    (SELECT column_name AS col_name, CASE column_name WHEN 'doc_id' THEN 'string' ELSE {_TYPE} END AS ref_type FROM (DESCRIBE documents)) b USING (col_name)""")
def _(t):
    ref = t.documents.withColumn("doc_id", F.col("doc_id").cast("string"))
    return dq.column_types(dq.schema_table(t.labels), dq.schema_table(ref))


@query("dq_freshness", f"""SELECT o_orderstatus, latest, '20010731' AS expected, CASE WHEN latest = '20010731' THEN 'PASS' ELSE 'ERROR' END AS status
    FROM (SELECT 'F' AS o_orderstatus, max(date) AS latest FROM ({DATED_SQL}) UNION ALL SELECT 'old', max(date) FROM ({DATED_SQL}) WHERE date < '20010701')""")
def _(t):
    now = dq.freshness(dated(t), "date", "20010801", "daily", 1).select(F.lit("F").alias("o_orderstatus"), "*")
    old = dq.freshness(dated(t).where("date < '20010701'"), "date", "20010801", "daily", 1).select(F.lit("old").alias("o_orderstatus"), "*")
    return now.unionAll(old)


@query("dq_primary_key", """SELECT count(*) AS duplicate_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows, CASE WHEN count(*) > 0 THEN 'ERROR' ELSE 'PASS' END AS status
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""")
def _(t):
    return dq.pk_duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])


_PAIR = "SELECT CASE WHEN l_linenumber = 7 THEN NULL ELSE l_suppkey END AS a, CASE WHEN l_linenumber = 6 THEN NULL ELSE l_quantity END AS b FROM lineitem"


@query("dq_row_duplicates", f"""SELECT count(*) AS duplicate_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_rows, CASE WHEN count(*) > 0 THEN 'ERROR' ELSE 'PASS' END AS status
    FROM (SELECT count(*) AS n FROM ({_PAIR}) GROUP BY a, b HAVING count(*) > 1)""")
def _(t):
    n = F.col("l_linenumber")
    return dq.row_duplicates(t.lineitem.select(F.when(n != 7, F.col("l_suppkey")).alias("a"), F.when(n != 6, F.col("l_quantity")).alias("b")))


# --- a log derived from orders: one or more entries per status and day -----------------------------

LOG_SQL = """SELECT o_orderpriority AS feature_name, CAST(o_custkey AS VARCHAR) AS metric_value, replace(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), '-', '') || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS log_date,
    'feature' AS layer, replace(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), '-', '') AS snapshot, 'orders_daily' AS destination,
    CASE o_orderkey % 2 WHEN 0 THEN 'completeness' ELSE 'validity' END AS dimension, 'null_count' AS metric_name, 'soft' AS severity, 0.2 AS hard_threshold, 0.05 AS soft_threshold, 'soft3' AS method,
    CASE o_orderstatus WHEN 'F' THEN 'ERROR' WHEN 'O' THEN 'WARNING' ELSE 'PASS' END AS status FROM orders"""


def log_of(t):
    day = F.date_format("o_orderdate", "yyyyMMdd")
    return t.orders.select(
        F.col("o_orderpriority").alias("feature_name"), F.col("o_custkey").cast("string").alias("metric_value"),
        F.concat(day, F.lpad(F.col("o_orderkey").cast("string"), 9, "0")).alias("log_date"), F.lit("feature").alias("layer"), day.alias("snapshot"),
        F.lit("orders_daily").alias("destination"), F.when(F.col("o_orderkey") % 2 == 0, "completeness").otherwise("validity").alias("dimension"),
        F.lit("null_count").alias("metric_name"), F.lit("soft").alias("severity"), F.lit(0.2).alias("hard_threshold"), F.lit(0.05).alias("soft_threshold"),
        F.lit("soft3").alias("method"), F.when(F.col("o_orderstatus") == "F", "ERROR").when(F.col("o_orderstatus") == "O", "WARNING").otherwise("PASS").alias("status"))


MA_SQL = f"""WITH d AS (SELECT feature_name, snapshot, CAST(metric_value AS DOUBLE) AS v FROM (SELECT *, row_number() OVER (PARTITION BY feature_name, snapshot ORDER BY log_date DESC) AS rn
        FROM ({LOG_SQL}) WHERE snapshot < '20010715' AND dimension = 'completeness') WHERE rn = 1),
    l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY feature_name ORDER BY snapshot DESC) AS rn FROM d) WHERE rn <= 3)
    SELECT feature_name, count(*) AS observations, CASE WHEN count(*) = 3 THEN avg(v) END AS ma FROM l GROUP BY 1"""


@query("dq_moving_average", f"SELECT feature_name, observations, {R('ma', 'ma')} FROM ({MA_SQL})")
def _(t):
    return dq.moving_average(dq.past_logs(log_of(t), "20010715", dimension="completeness", destination="orders/daily"), 3)


@query("dq_status", f"""WITH ma AS ({MA_SQL}), v AS (SELECT o_orderpriority AS feature_name, o_orderkey, o_custkey AS x FROM orders)
    SELECT o_orderkey, CASE WHEN ma IS NULL THEN 'PASS' WHEN abs(x - ma) / ma > 0.2 THEN 'ERROR' WHEN abs(x - ma) / ma >= 0.05 THEN 'WARNING' ELSE 'PASS' END AS status,
    CASE WHEN ma IS NULL THEN 'PASS' WHEN abs(x - ma) / ma >= 0.05 THEN 'WARNING' ELSE 'PASS' END AS feature_status FROM v LEFT JOIN ma USING (feature_name)""")
def _(t):
    ma = dq.moving_average(dq.past_logs(log_of(t), "20010715", dimension="completeness"), 3)
    rows = t.orders.select(F.col("o_orderpriority").alias("feature_name"), "o_orderkey", F.col("o_custkey").cast("double").alias("x")).join(ma, "feature_name", "left")
    return rows.select("o_orderkey", dq.status(F.col("x"), F.col("ma"), 0.05, 0.2).alias("status"),
                       dq.status(F.col("x"), F.col("ma"), 0.05, 0.2, "feature").alias("feature_status"))


@query("dq_range_validity", """SELECT 'l_quantity' AS feature_name, count(*) FILTER (WHERE NOT l_quantity >= 5) AS metric_value, CASE WHEN count(*) FILTER (WHERE l_quantity < 5) > 0 THEN 'ERROR' ELSE 'PASS' END AS status FROM lineitem
    UNION ALL SELECT 'l_tax', count(*) FILTER (WHERE NOT l_tax <= 0.07), CASE WHEN count(*) FILTER (WHERE l_tax > 0.07) > 0 THEN 'ERROR' ELSE 'PASS' END FROM lineitem
    UNION ALL SELECT 'l_extendedprice', count(*) FILTER (WHERE NOT l_extendedprice > 0), CASE WHEN count(*) FILTER (WHERE l_extendedprice <= 0) > 0 THEN 'ERROR' ELSE 'PASS' END FROM lineitem""")
def _(t):
    return dq.validity(t.lineitem, {"l_quantity": (">=", 5), "l_tax": ("<=", 0.07), "l_extendedprice": (">", 0)})


@query("dq_domain_validity", "SELECT 'o_orderstatus' AS feature_name, count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) AS metric_value, CASE WHEN count(*) FILTER (WHERE o_orderstatus NOT IN ('F', 'O')) > 0 THEN 'ERROR' ELSE 'PASS' END AS status FROM orders")
def _(t):
    return dq.validity(t.orders, {"o_orderstatus": ("in", ["F", "O"])})


@query("dq_gate", f"""WITH k AS (SELECT *, row_number() OVER (PARTITION BY destination, metric_name, feature_name, left(log_date, 8) ORDER BY log_date DESC) AS rn FROM ({LOG_SQL}) WHERE snapshot = '20010713')
    SELECT count(*) AS checks, count(*) FILTER (WHERE status = 'ERROR') AS errors, CASE WHEN count(*) FILTER (WHERE status = 'ERROR') > 0 THEN 'ERROR' ELSE 'PASS' END AS status FROM k WHERE rn = 1""")
def _(t):
    return dq.gate(log_of(t), "20010713", "feature")


_TOP = "SELECT o_orderpriority AS feature_name FROM orders WHERE o_orderpriority LIKE '%H%'"


@query("dq_report_filter", f"SELECT feature_name, log_date, dimension FROM ({LOG_SQL}) WHERE dimension <> 'completeness' OR feature_name IN ({_TOP})")
def _(t):
    top = t.orders.where("o_orderpriority LIKE '%H%'").select(F.col("o_orderpriority").alias("feature_name"))
    return dq.report_rows(log_of(t), top).select("feature_name", "log_date", "dimension")


_SUITE = {"columns": ["o_custkey", "o_totalprice"], "date": "date", "update_type": "daily", "expected_day": 1, "key": ["o_orderkey"],
          "validity": {"o_totalprice": (">=", 1000)}}


@query("dq_suite", f"""WITH o AS ({DATED_SQL})
    SELECT feature_name, metric_value, dimension, metric_name, status FROM (
      SELECT c AS feature_name, CASE m WHEN 'null_ratio' THEN '0.0' WHEN 'null_count' THEN '0' ELSE CAST((SELECT count(*) FROM o) AS VARCHAR) END AS metric_value, 'completeness' AS dimension, m AS metric_name, 'PASS' AS status
        FROM (VALUES ('o_custkey'), ('o_totalprice')) c(c), (VALUES ('null_ratio'), ('null_count'), ('row_count')) m(m)
      UNION ALL SELECT 'date', max(date), 'timeliness', 'freshness', CASE WHEN max(date) = '20010731' THEN 'PASS' ELSE 'ERROR' END FROM o
      UNION ALL SELECT 'o_orderkey', CAST(count(*) AS VARCHAR), 'uniqueness', 'primary_key', CASE WHEN count(*) > 0 THEN 'ERROR' ELSE 'PASS' END FROM (SELECT o_orderkey FROM o GROUP BY 1 HAVING count(*) > 1)
      UNION ALL SELECT '*', CAST(coalesce(sum(n), 0) AS VARCHAR), 'uniqueness', 'duplicate_records', CASE WHEN count(*) > 0 THEN 'ERROR' ELSE 'PASS' END FROM (SELECT count(*) AS n FROM o GROUP BY o_orderkey, o_custkey, o_totalprice, date HAVING count(*) > 1)
      UNION ALL SELECT 'o_totalprice', CAST(count(*) FILTER (WHERE o_totalprice < 1000) AS VARCHAR), 'validity', 'rule', CASE WHEN count(*) FILTER (WHERE o_totalprice < 1000) > 0 THEN 'ERROR' ELSE 'PASS' END FROM o)""")
def _(t):
    return dq.run_suite(dated(t), "orders", _SUITE, "20010801").select("feature_name", "metric_value", "dimension", "metric_name", "status")


_LAYER_DATES = ["20010709", "20010710", "20010716"]
_LAYER = {"orders/daily": {"columns": ["o_custkey", "o_clerk"], "partition": "date", "date": "date", "update_type": "weekly", "key": ["o_custkey"], "validity": {"o_totalprice": (">=", 50000)}},
          "parts": {"columns": ["p_size"], "key": ["p_brand", "p_size"]}}
_LAYER_ORDERS = f"SELECT o_custkey, CASE WHEN o_orderkey % 4 > 0 THEN o_orderstatus END AS o_clerk, o_totalprice, date FROM ({DATED_SQL}) JOIN (SELECT o_orderkey, o_orderstatus FROM orders) USING (o_orderkey)"
_LAYER_LOG = """SELECT 'orders_daily' AS destination, 'completeness' AS dimension, 'null_count' AS metric_name, 'o_clerk' AS feature_name,
    strftime(o_orderdate, '%Y%m%d') AS log_date, strftime(o_orderdate, '%Y%m%d') AS snapshot, count(*) AS v FROM orders WHERE o_orderkey % 4 = 0 AND o_orderdate >= TIMESTAMP '2001-06-01' GROUP BY ALL"""


def _layer_log(t):
    days = t.orders.where("o_orderkey % 4 = 0 and o_orderdate >= timestamp_ntz'2001-06-01 00:00:00'").groupBy(F.date_format("o_orderdate", "yyyyMMdd").alias("snapshot"))
    return days.agg(F.count("*").cast("string").alias("metric_value")).select(
        F.lit("orders_daily").alias("destination"), F.lit("completeness").alias("dimension"), F.lit("null_count").alias("metric_name"), F.lit("o_clerk").alias("feature_name"),
        F.col("snapshot").alias("log_date"), "snapshot", "metric_value")


def _layer_sql():
    days = [d for d in _LAYER_DATES if d != "20010710"]  # Mondays
    values = ", ".join(f"('{d}')" for d in days)
    whole = f"""SELECT d, o.* FROM (VALUES {values}) v(d) LEFT JOIN ({_LAYER_ORDERS}) o ON o.date = d"""
    return f"""WITH o AS ({whole}), c AS (SELECT d, count(date) AS n, count(o_custkey) AS a, count(o_clerk) AS b, max(date) AS newest, count(*) FILTER (WHERE o_totalprice < 50000) AS bad FROM o GROUP BY 1),
      k AS (SELECT d, count(*) FILTER (WHERE n > 1) AS dup FROM (SELECT d, o_custkey, count(o_custkey) AS n FROM o GROUP BY 1, 2) GROUP BY 1),
      f AS (SELECT d, coalesce(sum(n) FILTER (WHERE n > 1), 0) AS rows FROM (SELECT d, o_custkey, o_clerk, o_totalprice, count(date) AS n FROM o GROUP BY ALL) GROUP BY 1),
      l AS (SELECT d, avg(v) AS ma, count(*) AS obs FROM (SELECT d, v, row_number() OVER (PARTITION BY d ORDER BY snapshot DESC) AS rn FROM ({_LAYER_LOG}), (VALUES {values}) v(d) WHERE snapshot < d) WHERE rn <= 3 GROUP BY 1),
      p AS (SELECT count(*) AS n, (SELECT count(*) FROM (SELECT 1 FROM part GROUP BY p_brand, p_size HAVING count(*) > 1)) AS dup,
        (SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM part GROUP BY p_partkey, p_name, p_brand, p_type, p_size, p_retailprice HAVING count(*) > 1)) AS rows, count(p_size) AS s FROM part),
      r AS (
        SELECT d, 'orders_daily' AS destination, 'o_custkey' AS feature_name, 'null_ratio' AS metric_name, CAST(round((n - a) / n, 4) AS VARCHAR) AS metric_value, 'PASS' AS status FROM c
        UNION ALL SELECT d, 'orders_daily', 'o_custkey', 'null_count', CAST(n - a AS VARCHAR), 'PASS' FROM c UNION ALL SELECT d, 'orders_daily', 'o_custkey', 'row_count', CAST(a AS VARCHAR), 'PASS' FROM c
        UNION ALL SELECT d, 'orders_daily', 'o_clerk', 'null_ratio', CAST(round((n - b) / n, 4) AS VARCHAR), 'PASS' FROM c UNION ALL SELECT d, 'orders_daily', 'o_clerk', 'row_count', CAST(b AS VARCHAR), 'PASS' FROM c
        UNION ALL SELECT d, 'orders_daily', 'o_clerk', 'null_count', CAST(n - b AS VARCHAR), CASE WHEN coalesce(obs, 0) < 3 THEN 'PASS' WHEN abs(n - b - ma) / ma >= 0.05 THEN 'WARNING' ELSE 'PASS' END FROM c LEFT JOIN l USING (d)
        UNION ALL SELECT d, 'orders_daily', 'date', 'freshness', newest, CASE WHEN newest = d THEN 'PASS' ELSE 'ERROR' END FROM c
        UNION ALL SELECT d, 'orders_daily', 'o_totalprice', 'rule', CAST(bad AS VARCHAR), CASE WHEN bad > 0 THEN 'ERROR' ELSE 'PASS' END FROM c
        UNION ALL SELECT d, 'orders_daily', 'o_custkey', 'primary_key', CAST(dup AS VARCHAR), CASE WHEN dup > 0 THEN 'ERROR' ELSE 'PASS' END FROM k
        UNION ALL SELECT d, 'orders_daily', '*', 'duplicate_records', CAST(rows AS VARCHAR), CASE WHEN rows > 0 THEN 'ERROR' ELSE 'PASS' END FROM f
        UNION ALL SELECT d, 'parts', 'p_size', m, CASE m WHEN 'null_ratio' THEN CAST(round((n - s) / n, 4) AS VARCHAR) WHEN 'null_count' THEN CAST(n - s AS VARCHAR) ELSE CAST(s AS VARCHAR) END, 'PASS'
          FROM p, (VALUES {values}) v(d), (VALUES ('null_ratio'), ('null_count'), ('row_count')) m(m)
        UNION ALL SELECT d, 'parts', 'p_brand,p_size', 'primary_key', CAST(dup AS VARCHAR), CASE WHEN dup > 0 THEN 'ERROR' ELSE 'PASS' END FROM p, (VALUES {values}) v(d)
        UNION ALL SELECT d, 'parts', '*', 'duplicate_records', CAST(rows AS VARCHAR), CASE WHEN rows > 0 THEN 'ERROR' ELSE 'PASS' END FROM p, (VALUES {values}) v(d))
    SELECT d AS snapshot, destination, feature_name, metric_name, metric_value, status FROM r"""


@query("dq_layer", _layer_sql)
def _(t):
    """Two tables at three dates, of which two are Mondays."""
    orders = dated(t).join(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderkey").select(
        "o_custkey", F.when(F.col("o_orderkey") % 4 > 0, F.col("o_orderstatus")).alias("o_clerk"), "o_totalprice", "date")
    log = dq.run_layer({"orders/daily": orders, "parts": t.part}, _LAYER, _LAYER_DATES, "feature", _layer_log(t))
    return log.select("snapshot", "destination", "feature_name", "metric_name", "metric_value", "status")


@query("ingest_rowcount_check", f"""WITH c AS (SELECT date, count(*) AS row_count FROM ({DATED_SQL}) GROUP BY 1), b AS (SELECT avg(row_count) AS b FROM (SELECT * FROM c WHERE date < '20010715' ORDER BY date DESC LIMIT 3))
    SELECT date, row_count, {R('b', 'value_compare')}, CASE WHEN abs(row_count - b) / b <= 0.05 THEN 'pass' ELSE 'fail' END AS status FROM c, b WHERE date >= '20010715'""")
def _(t):
    history = dated(t).groupBy("date").agg(F.count("*").alias("row_count"))
    return dq.rowcount_check(dated(t), "date", history, "20010715")


@query("log_init", f"SELECT feature_name, count(*) AS n FROM ({LOG_SQL}) GROUP BY 1")
def _(t):
    path = scratch(t.spark)
    src.open_log(t.spark, path, dq.LOG_SCHEMA)
    src.append_rows(log_of(t), path)
    return src.open_log(t.spark, path, dq.LOG_SCHEMA).groupBy("feature_name").agg(F.count("*").alias("n"))


# --- job periods ---------------------------------------------------------------------------------------

@query("period_calendar", f"""WITH r AS (SELECT strptime(min(date), '%Y%m%d') AS a, strptime(max(date), '%Y%m%d') AS b FROM ({DATED_SQL}))
    SELECT strftime(d, '%Y%m%d') AS run_date, 'daily' AS freq FROM (SELECT unnest(generate_series(a, b - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM r)
    UNION ALL SELECT strftime(d, '%Y%m%d'), 'weekly' FROM (SELECT unnest(generate_series(a, b, INTERVAL 1 DAY)) AS d FROM r) WHERE dayofweek(d) = 1""")
def _(t):
    d = dated(t)
    return cal.periods_of(d, "date", "daily").withColumn("freq", F.lit("daily")).unionAll(cal.periods_of(d, "date", "weekly").withColumn("freq", F.lit("weekly")))


RUNS_SQL = "SELECT replace(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), '-', '') AS run_date, o_orderkey AS seq, CASE o_orderstatus WHEN 'F' THEN 'DONE' WHEN 'O' THEN 'FAIL' ELSE 'RUNNING' END AS status FROM orders"


def runs(t):
    status = F.when(F.col("o_orderstatus") == "F", "DONE").when(F.col("o_orderstatus") == "O", "FAIL").otherwise("RUNNING")
    return t.orders.select(F.lit("orders").alias("feature_dir"), F.expr("timestamp_ntz'1970-01-01 00:00:00' + make_dt_interval(0, 0, 0, o_orderkey)").alias("update_time"), F.date_format("o_orderdate", "yyyyMMdd").alias("run_date"),
                           status.alias("status"), F.col("o_orderkey").cast("float").alias("duration"), F.col("o_orderkey").alias("seq"))


@query("pending_periods", f"""WITH cal AS (SELECT strftime(d, '%Y%m%d') AS run_date FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate) - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM orders)),
    l AS (SELECT *, row_number() OVER (PARTITION BY run_date ORDER BY seq DESC) AS rn FROM ({RUNS_SQL}))
    SELECT run_date FROM cal WHERE run_date NOT IN (SELECT run_date FROM l WHERE rn = 1 AND status = 'DONE')""")
def _(t):
    return jobs.pending_periods(cal.periods_of(dated(t), "date", "daily"), runs(t))


@query("job_log_append", f"SELECT status, count(*) AS n FROM ({RUNS_SQL}) GROUP BY 1")
def _(t):
    from rollspan.operators.fill import cast_to
    path = scratch(t.spark)
    src.open_log(t.spark, path, jobs.RUN_SCHEMA)
    src.append_rows(cast_to(runs(t).where("status = 'DONE'"), jobs.RUN_SCHEMA), path)
    src.append_rows(cast_to(runs(t).where("status <> 'DONE'"), jobs.RUN_SCHEMA), path)
    return src.open_log(t.spark, path, jobs.RUN_SCHEMA).groupBy("status").agg(F.count("*").alias("n"))


@query("job_log_report", f"SELECT run_date, status, strftime(to_timestamp(seq) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS update_time FROM ({RUNS_SQL}) WHERE seq >= 3600")
def _(t):
    return jobs.run_report(runs(t), "1970-01-01 01:00:00").select("run_date", "status", "update_time")


@query("snapshot_windows", f"""SELECT DISTINCT date, strftime(d - INTERVAL 7 DAY, '%Y%m%d') AS l1w_from, strftime(d - INTERVAL 28 DAY, '%Y%m%d') AS l4w_from, strftime(d - INTERVAL 84 DAY, '%Y%m%d') AS l12w_from, strftime(d - INTERVAL 168 DAY, '%Y%m%d') AS l24w_from,
    strftime(d - INTERVAL 1 MONTH + INTERVAL 1 DAY, '%Y%m%d') AS month_from, strftime(CASE WHEN day(d) >= 15 THEN d - INTERVAL 2 MONTH ELSE d - INTERVAL 3 MONTH END, '%Y%m') AS bill_month
    FROM (SELECT date, strptime(date, '%Y%m%d') AS d FROM ({DATED_SQL}))""")
def _(t):
    return cal.snapshot_bounds(dated(t).select("date").distinct(), "date")
