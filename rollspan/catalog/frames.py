"""Scans, sinks, joins, windows, sets, fills and projections."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F, types as T

from rollspan.catalog.registry import R, query, role_sql
from rollspan.catalog.roles import MONTH_D
from rollspan.catalog.weekly_families import MAP_SQL
from rollspan.operators import fill as fl, joins as jo, rollups as ru, windows as wi
from rollspan.operators.aggregates import sliced_stats, two_party_features
from rollspan.operators.quality import schema_table
from rollspan.plans import cells
from rollspan.session import shared_folder
from rollspan.sources import tables as src

_ODAY = "replace(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), '-', '')"


def scratch(spark) -> str:
    """A new folder in the folder that the cluster shares."""
    return f"{shared_folder(spark).rstrip('/')}/{uuid.uuid4().hex}"


def dated(t):
    return t.orders.select("o_orderkey", "o_custkey", "o_totalprice", F.date_format("o_orderdate", "yyyyMMdd").alias("date"))


DATED_SQL = f"SELECT o_orderkey, o_custkey, o_totalprice, {_ODAY} AS date FROM orders"


# --- A: scans and sinks ----------------------------------------------------------------------

@query("scan_query", f"SELECT o_custkey, count(*) AS n, {R('sum(o_totalprice)', 'price_sum')} FROM orders GROUP BY 1")
def _(t):
    return src.scan_query(t.spark, "SELECT o_custkey, count(*) AS n, sum(o_totalprice) AS price_sum FROM {orders} GROUP BY 1",
                          views={"orders": t.orders})


@query("scan_merge_schema", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 1 THEN c_name END AS c_name, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END AS c_acctbal, CAST(c_custkey % 2 AS VARCHAR) AS part FROM customer")
def _(t):
    path = scratch(t.spark)
    t.customer.where("c_custkey % 2 = 0").select("c_custkey", "c_acctbal").write.parquet(f"{path}/part=0")
    t.customer.where("c_custkey % 2 = 1").select("c_custkey", "c_name").write.parquet(f"{path}/part=1")
    return src.scan(t.spark, path, merge_schema=True)


@query("sink_partition_overwrite", f"SELECT status, count(*) AS n, {R('sum(CASE WHEN status = ' + repr('F') + ' THEN 2 * o_totalprice ELSE o_totalprice END)', 'price_sum')} FROM (SELECT *, o_orderstatus AS status FROM orders) GROUP BY 1")
def _(t):
    path = scratch(t.spark)
    rows = t.orders.select("o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("status"))
    src.write_partition(rows, path, ["status"])
    src.write_partition(rows.where("status = 'F'").withColumn("o_totalprice", F.col("o_totalprice") * 2), path, ["status"])
    return src.scan(t.spark, path).groupBy("status").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("price_sum"))


@query("sink_append_log", "SELECT run_time, count(*) AS n FROM (SELECT 'r1' AS run_time FROM orders UNION ALL SELECT 'r2' FROM orders WHERE o_orderstatus = 'P') GROUP BY 1")
def _(t):
    path = scratch(t.spark)
    src.append_rows(cells.stamped(t.orders.select("o_orderkey"), "r1"), path)
    src.append_rows(cells.stamped(t.orders.where("o_orderstatus = 'P'").select("o_orderkey"), "r2"), path)
    return src.scan(t.spark, path).groupBy("run_time").agg(F.count("*").alias("n"))


@query("sink_two_level", f"SELECT left({_ODAY}, 4) AS fix_date, left({_ODAY}, 6) AS date, count(*) AS n FROM orders WHERE left({_ODAY}, 4) = '1999' GROUP BY 1, 2")
def _(t):
    path = scratch(t.spark)
    rows = dated(t).withColumns({"fix_date": F.left("date", F.lit(4)), "date": F.left("date", F.lit(6))})
    src.write_partition(rows, path, ["fix_date", "date"])
    return src.scan(t.spark, path).where("fix_date = '1999'").groupBy("fix_date", "date").agg(F.count("*").alias("n"))


@query("ingest_incremental_slices", f"SELECT 'orders' AS table_name, date, left(CAST(o_custkey AS VARCHAR), 1) AS partition_col, count(*) AS n FROM ({DATED_SQL}) WHERE date > '20010601' AND date <= '20010615' GROUP BY 1, 2, 3")
def _(t):
    path = scratch(t.spark)
    src.ingest_slices(dated(t), path, "orders", "date", "o_custkey", "20010601", "20010615")
    return src.scan(t.spark, path).groupBy("table_name", "date", "partition_col").agg(F.count("*").alias("n"))


@query("sink_rebalanced", f"SELECT count(*) AS n, {R('sum(l_quantity)', 'q_sum')} FROM lineitem")
def _(t):
    path = scratch(t.spark)
    src.rebalance(t.lineitem.select("l_orderkey", "l_quantity")).write.parquet(path)
    return src.scan(t.spark, path).agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q_sum"))


@query("sink_sized", f"SELECT count(*) AS n, {R('sum(l_quantity)', 'q_sum')}, true AS sized FROM lineitem")
def _(t):
    """Written twice: the second write is cut by the bytes a row took in the first."""
    first, second = scratch(t.spark), scratch(t.spark)
    rows = t.lineitem.select("l_orderkey", "l_quantity", "l_shipdate")
    src.write_sized(rows, first, 64 << 10)
    src.write_sized(rows, second, 64 << 10, like=first)
    sizes = src.file_sizes(t.spark, second)
    sized = len(sizes) == 1 or all(32 << 10 <= s <= 128 << 10 for s in sizes)
    return src.scan(t.spark, second).agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q_sum"), F.lit(sized).alias("sized"))


@query("source_cutover_union", f"SELECT date, tag, count(*) AS n FROM (SELECT *, CASE WHEN date < '19990101' THEN 'old' ELSE 'new' END AS tag FROM ({DATED_SQL})) GROUP BY 1, 2")
def _(t):
    both = src.cutover_union(dated(t).withColumn("tag", F.lit("old")), dated(t).withColumn("tag", F.lit("new")), "date", "19990101")
    return both.groupBy("date", "tag").agg(F.count("*").alias("n"))


@query("latest_snapshot", f"SELECT o_orderkey, date FROM ({DATED_SQL}) WHERE date = (SELECT max(date) FROM ({DATED_SQL}) WHERE date <= '{MONTH_D}' AND date >= '20010415')")
def _(t):
    return src.latest_snapshot(dated(t).select("o_orderkey", "date"), "date", MONTH_D, 3)


@query("sql_over_view", "SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def _(t):
    return src.sql_over(t.spark, {"c": t.customer, "n": t.nation}, "SELECT n_name, count(*) AS n FROM {c} JOIN {n} ON c_nationkey = n_nationkey GROUP BY 1")


_TYPES = "CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'INTEGER' THEN 'int' ELSE lower(column_type) END"


@query("schema_table", f"SELECT column_name AS col_name, {_TYPES} AS data_type, CAST(row_number() OVER () - 1 AS INT) AS ordinal FROM (DESCRIBE lineitem)")
def _(t):
    return schema_table(t.lineitem)


@query("partition_dates", f"SELECT DISTINCT date FROM ({DATED_SQL}) WHERE date BETWEEN '20010616' AND '20010715'")
def _(t):
    return src.partition_dates(dated(t), "date", "20010616", "20010715")


@query("pending_partitions", f"SELECT DISTINCT date FROM ({DATED_SQL}) WHERE date NOT IN (SELECT date FROM ({DATED_SQL}) WHERE o_orderkey % 5 = 0)")
def _(t):
    from rollspan.operators.jobs import pending_partitions
    return pending_partitions(dated(t), dated(t).where("o_orderkey % 5 = 0"), "date")


@query("cast_to_target_schema", "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_totalprice AS DOUBLE) AS o_totalprice, CAST(NULL AS VARCHAR) AS note FROM orders")
def _(t):
    target = T.StructType([T.StructField("o_orderkey", T.StringType()), T.StructField("o_totalprice", T.DoubleType()), T.StructField("note", T.StringType())])
    return fl.cast_to(t.orders, target)


# --- B: fills, projections, renames -----------------------------------------------------------

def gappy(t):
    o = t.orders
    return o.select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status_item"), F.nullif("o_orderpriority", F.lit("5-LOW")).alias("prio"),
                    F.when(F.col("o_orderkey") % 3 > 0, F.col("o_totalprice")).alias("price"), F.when(F.col("o_orderkey") % 4 > 0, F.col("o_custkey")).alias("cust"))


GAPPY_SQL = ("SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status_item, nullif(o_orderpriority, '5-LOW') AS prio, "
             "CASE WHEN o_orderkey % 3 > 0 THEN o_totalprice END AS price, CASE WHEN o_orderkey % 4 > 0 THEN o_custkey END AS cust FROM orders")


@query("fillna_by_strategy", f"""SELECT o_orderkey, coalesce(status_item, 'ukn') AS t_status_item, coalesce(prio, 'ukn') AS t_prio, coalesce(price, 0) AS t_price, coalesce(cust, 0) AS t_cust,
    coalesce(status_item, 'null') AS i_status_item, prio AS i_prio, coalesce(prio, 'none') AS m_prio, coalesce(price, -1) AS m_price FROM ({GAPPY_SQL})""")
def _(t):
    g = gappy(t)
    a = fl.fill(g).toDF("o_orderkey", "t_status_item", "t_prio", "t_price", "t_cust")
    b = fl.fill(g, "items").select("o_orderkey", F.col("status_item").alias("i_status_item"), F.col("prio").alias("i_prio"))
    c = fl.fill(g, {"prio": "none", "price": -1.0}).select("o_orderkey", F.col("prio").alias("m_prio"), F.col("price").alias("m_price"))
    return a.join(b, "o_orderkey").join(c, "o_orderkey")


@query("cap_at_quantile", f"SELECT o_orderkey, least(coalesce(price, 0), 250000) AS price FROM ({GAPPY_SQL})")
def _(t):
    return fl.cap(gappy(t).select("o_orderkey", "price"), {"price": 250000})


@query("winsorize_table", f"SELECT o_orderkey, CASE WHEN price IS NOT NULL THEN greatest(50000.0, least(400000.0, price)) END AS price FROM ({GAPPY_SQL})")
def _(t):
    return fl.winsorize(gappy(t).select("o_orderkey", "price"), {"price": (50000, 400000)})


@query("cast_numeric", "SELECT l_orderkey, CAST(l_linenumber AS DOUBLE) AS l_linenumber, CAST(l_partkey AS DOUBLE) AS l_partkey FROM lineitem")
def _(t):
    return fl.cast_numeric(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), ["l_orderkey"])


@query("feature_projection", "SELECT c_custkey, c_acctbal, c_mktsegment FROM customer")
def _(t):
    return fl.project(t.customer, {"num": ["c_acctbal"], "cat": ["c_mktsegment"]}, ["c_custkey"])


@query("rename_by_stem", "SELECT c_custkey, c_acctbal AS f7_bal, c_nationkey AS f9_other FROM customer")
def _(t):
    rows = t.customer.select("c_custkey", F.col("c_acctbal").alias("f3_bal"), F.col("c_nationkey").alias("f9_other"))
    return fl.rename_by_stem(rows, ["f7_bal"])


@query("indexed_rename", "SELECT c_custkey, c_acctbal AS f130_c_acctbal, c_nationkey AS f131_c_nationkey FROM customer")
def _(t):
    return fl.index_names(t.customer.select("c_custkey", "c_acctbal", "c_nationkey"), 130, ["c_custkey"])


@query("active_population", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def _(t):
    return jo.restrict(t.orders.select("o_orderkey", "o_custkey"), t.customer.where("c_mktsegment = 'BUILDING'"), "o_custkey", "c_custkey")


# --- C: joins -------------------------------------------------------------------------------------

_KEYS = ("o_custkey", "o_orderstatus")


def _span(t, name, test, keys=_KEYS):
    return t.orders.where(f"year(o_orderdate) {test}").groupBy(*keys).agg(F.count("*").alias(name))


def _span_sql(name, test, keys=_KEYS):
    return f"(SELECT {', '.join(keys)}, count(*) AS {name} FROM orders WHERE year(o_orderdate) {test} GROUP BY ALL)"


#: Spans of years that cover the table.
SPANS = {"n_before": "< 1999", "n1999": "= 1999", "n_after": "> 1999"}
HALVES = {"n_early": "< 1999", "n_late": ">= 1999"}


@query("outer_join_windows", "SELECT * FROM {} a FULL OUTER JOIN {} b USING (o_custkey) FULL OUTER JOIN {} c USING (o_custkey)".format(*[_span_sql(n, s, _KEYS[:1]) for n, s in SPANS.items()]))
def _(t):
    return jo.outer_merge_long([_span(t, n, s, _KEYS[:1]) for n, s in SPANS.items()], ["o_custkey"])


@query("outer_join_composite", "SELECT * FROM {} a FULL OUTER JOIN {} b USING (o_custkey, o_orderstatus)".format(*[_span_sql(n, s) for n, s in HALVES.items()]))
def _(t):
    return jo.outer_merge([_span(t, n, s) for n, s in HALVES.items()], list(_KEYS))


@query("outer_coalesce_key", "SELECT coalesce(a.k, b.k) AS k, a.n AS n_sup, b.n AS n_part FROM (SELECT l_suppkey AS k, count(*) AS n FROM lineitem GROUP BY 1) a FULL OUTER JOIN (SELECT l_partkey + 7 AS k, count(*) AS n FROM lineitem GROUP BY 1) b ON a.k = b.k")
def _(t):
    a = t.lineitem.groupBy(F.col("l_suppkey").alias("k")).agg(F.count("*").alias("n_sup"))
    b = t.lineitem.groupBy((F.col("l_partkey") + 7).alias("k")).agg(F.count("*").alias("n_part"))
    return jo.outer_merge([a, b], ["k"])


@query("cell_map_join", f"SELECT bts_id, count(*) AS n FROM ({role_sql('session')}) JOIN ({MAP_SQL.replace(', s3_file_date FROM (', ' FROM (', 1)}) USING (lac, cell_id) GROUP BY 1")
def _(t):
    return cells.at_cells(t.session, cells.cell_map(t.cells, "20010701")).groupBy("bts_id").agg(F.count("*").alias("n"))


@query("cell_map_join_spread", f"SELECT bts_id, l AS l_linenumber, count(*) AS n FROM (SELECT CASE WHEN l_orderkey % 3 = 0 THEN '1' ELSE CAST(l_suppkey % 10 AS VARCHAR) END AS lac, CASE WHEN l_orderkey % 3 = 0 THEN '1' ELSE CAST(l_suppkey % 25 AS VARCHAR) END AS cell_id, l_linenumber AS l FROM lineitem) JOIN ({MAP_SQL.replace(', s3_file_date FROM (', ' FROM (', 1)}) USING (lac, cell_id) GROUP BY 1, 2")
def _(t):
    """One cell holds a third of the events."""
    hot = F.col("l_orderkey") % 3 == 0
    events = t.lineitem.select(*[F.when(hot, "1").otherwise((F.col("l_suppkey") % n).cast("string")).alias(c) for c, n in (("lac", 10), ("cell_id", 25))], "l_linenumber", "l_orderkey")
    return cells.at_cells(events, cells.cell_map(t.cells, "20010701"), heavy_share=0.02).groupBy("bts_id", "l_linenumber").agg(F.count("*").alias("n"))


@query("left_enrich", "SELECT o_orderkey, c_mktsegment, n_name FROM orders LEFT JOIN customer ON o_custkey = c_custkey + 100 LEFT JOIN nation ON c_nationkey = n_nationkey")
def _(t):
    cust = t.customer.select((F.col("c_custkey") + 100).alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey"), "c_mktsegment")
    out = jo.enrich(jo.enrich(t.orders, cust, ["o_custkey"]), t.nation.select("n_nationkey", "n_name"), ["n_nationkey"])
    return out.select("o_orderkey", "c_mktsegment", "n_name")


LATEST_SQL = "SELECT o_custkey, o_orderkey, o_orderdate_s FROM (SELECT o_custkey, o_orderkey, {d} AS o_orderdate_s, max(o_orderdate) OVER (PARTITION BY o_custkey) AS md, o_orderdate FROM orders) WHERE o_orderdate = md".format(d=_ODAY)


@query("latest_per_key_join", LATEST_SQL)
def _(t):
    rows = t.orders.select("o_custkey", "o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").alias("o_orderdate_s"))
    return wi.latest_per_key(rows, ["o_custkey"], ["o_orderdate_s"], ties="all")


@query("cohort_semi_join", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT l_suppkey FROM lineitem WHERE l_quantity > 49)")
def _(t):
    return jo.restrict(t.orders, t.lineitem.where("l_quantity > 49"), "o_custkey", "l_suppkey").select("o_orderkey")


_MON = "o_orderdate > TIMESTAMP '2001-06-15' AND o_orderdate <= TIMESTAMP '2001-07-15'"


@query("densify_calendar", f"""WITH f AS (SELECT o_custkey, {_ODAY} AS date, count(*) AS n, sum(o_totalprice) AS price FROM orders WHERE {_MON} GROUP BY 1, 2)
    SELECT k.o_custkey, d.date, coalesce(n, 0) AS n, {R('coalesce(price, 0)', 'price')} FROM (SELECT DISTINCT o_custkey FROM f) k CROSS JOIN (SELECT DISTINCT date FROM f) d LEFT JOIN f ON f.o_custkey = k.o_custkey AND f.date = d.date""")
def _(t):
    rows = dated(t).where("date > '20010615' AND date <= '20010715'")
    return jo.densify(rows.groupBy("o_custkey", "date").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("price")), ["o_custkey"], "date")


@query("spine_join", f"""SELECT k, coalesce(a, 0) AS a, coalesce(b, 0) AS b FROM (SELECT o_custkey AS k FROM orders UNION SELECT l_suppkey FROM lineitem)
    LEFT JOIN (SELECT o_custkey AS k, count(*) AS a FROM orders GROUP BY 1) USING (k) LEFT JOIN (SELECT l_suppkey AS k, count(*) AS b FROM lineitem GROUP BY 1) USING (k)""")
def _(t):
    a = t.orders.groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("a"))
    b = t.lineitem.groupBy(F.col("l_suppkey").alias("k")).agg(F.count("*").alias("b"))
    return jo.spine_join([a, b], "k", 0)


@query("guarded_inner_join", "SELECT c_custkey, c_name, coalesce(n, 0) AS n FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey")
def _(t):
    ids = t.customer.select("c_custkey")
    n = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"))
    right = ids.join(n, "c_custkey", "left").fillna(0)
    return jo.guarded_join(t.customer.select("c_custkey", "c_name"), right, ["c_custkey"], "inner", mode="raise")


@query("guarded_outer_merge", """WITH a AS (SELECT o_orderkey AS k, o_orderstatus FROM orders), b AS (SELECT l_orderkey + 9 AS k, l_tax FROM lineitem),
    j AS (SELECT coalesce(a.k, b.k) AS k FROM a FULL OUTER JOIN b ON a.k = b.k)
    SELECT (SELECT count(*) FROM a) AS left_rows, (SELECT count(*) FROM b) AS right_rows, count(*) AS merged_rows, count(DISTINCT k) AS merged_keys, count(*) = count(DISTINCT k) AS ok FROM j""")
def _(t):
    a = t.orders.select(F.col("o_orderkey").alias("k"), "o_orderstatus")
    b = t.lineitem.select((F.col("l_orderkey") + 9).alias("k"), "l_tax")
    return jo.merge_report(a, b, ["k"], "full_outer")


@query("month_shift_join", """WITH m AS (SELECT o_custkey, date_trunc('month', o_orderdate) AS d, count(*) AS n FROM orders GROUP BY 1, 2)
    SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, strftime(coalesce(a.d, b.d + INTERVAL 1 MONTH), '%Y%m%d') AS month, a.n, b.n AS n_prev
    FROM m a FULL OUTER JOIN m b ON a.o_custkey = b.o_custkey AND a.d = b.d + INTERVAL 1 MONTH""")
def _(t):
    m = t.orders.groupBy("o_custkey", F.trunc("o_orderdate", "month").alias("d")).agg(F.count("*").alias("n"))
    out = jo.month_shift_join(m, ["o_custkey"], "d", 1)
    return out.select("o_custkey", F.date_format("d", "yyyyMMdd").alias("month"), "n", "n_prev")


@query("membership_filter_join", f"SELECT msisdn, count(*) AS n FROM ({role_sql('call')}) WHERE msisdn IN (SELECT msisdn FROM ({role_sql('call')}) WHERE imsi LIKE '45202%') GROUP BY 1")
def _(t):
    return jo.restrict(t.call, t.call.where("imsi LIKE '45202%'"), "msisdn").groupBy("msisdn").agg(F.count("*").alias("n"))


@query("label_score_join", "SELECT l.doc_id, l.quality, CASE WHEN d.lang = 'en' THEN d.n_chars END AS n_chars FROM labels l LEFT JOIN documents d ON l.doc_id = d.doc_id")
def _(t):
    feats = t.documents.select(F.col("doc_id").alias("id"), F.expr("CASE WHEN lang = 'en' THEN n_chars END").alias("n_chars"))
    return jo.attach_labels(t.labels.select("doc_id", "quality"), feats, [("doc_id", "id")])


@query("sender_receiver_features", f"""WITH r AS (SELECT * FROM ({role_sql('transfer')})),
    s AS (SELECT sender AS msisdn, count(*) AS money_transfer_sender_count, count(DISTINCT s3_file_date) AS money_transfer_sender_count_days, sum(amount) AS a, max(amount) AS money_transfer_sender_amount_max FROM r GROUP BY 1),
    q AS (SELECT receiver AS msisdn, count(*) AS money_transfer_receiver_count, count(DISTINCT s3_file_date) AS money_transfer_receiver_count_days, sum(amount) AS b, max(amount) AS money_transfer_receiver_amount_max FROM r GROUP BY 1)
    SELECT msisdn, money_transfer_sender_count, coalesce(money_transfer_sender_count_days, 0) AS money_transfer_sender_count_days, {R('a', 'money_transfer_sender_amount_sum')}, money_transfer_sender_amount_max,
    money_transfer_receiver_count, coalesce(money_transfer_receiver_count_days, 0) AS money_transfer_receiver_count_days, {R('b', 'money_transfer_receiver_amount_sum')}, money_transfer_receiver_amount_max FROM s FULL OUTER JOIN q USING (msisdn)""")
def _(t):
    daily, ms = two_party_features(t.transfer, "sender", "receiver", "amount", "s3_file_date")
    return sliced_stats(daily, ["msisdn"], ms)


# --- E, F: windows and top-k --------------------------------------------------------------------------

@query("dedup_latest", f"SELECT o_custkey, o_orderkey, d FROM (SELECT o_custkey, o_orderkey, {_ODAY} AS d, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1")
def _(t):
    rows = t.orders.select("o_custkey", F.date_format("o_orderdate", "yyyyMMdd").alias("d"), "o_orderkey")
    return wi.latest_per_key(rows, ["o_custkey"], ["d"])


@query("top1_by_count", "SELECT o_custkey, o_orderpriority, n FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority) AS rn FROM (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2)) WHERE rn = 1")
def _(t):
    return wi.top1_by_count(t.orders, ["o_custkey"], "o_orderpriority")


@query("keep_max_partition", "SELECT l_suppkey, l_orderkey, l_linenumber, l_quantity FROM (SELECT *, max(l_quantity) OVER (PARTITION BY l_suppkey) AS mq FROM lineitem) WHERE l_quantity = mq")
def _(t):
    return wi.keep_max(t.lineitem.select("l_suppkey", "l_orderkey", "l_linenumber", "l_quantity"), ["l_suppkey"], "l_quantity")


@query("cumulative_delta", f"""WITH s AS (SELECT o_custkey, {_ODAY} AS date, sum(o_totalprice) AS v FROM orders GROUP BY 1, 2)
    SELECT o_custkey, date, {R('CASE WHEN d > 0 THEN d END', 'v_sum')} FROM (SELECT *, coalesce(abs(v - lag(v) OVER (PARTITION BY o_custkey ORDER BY date)), v) AS d FROM s)""")
def _(t):
    return ru.cumulative_delta(dated(t).withColumnRenamed("o_totalprice", "v_sum"), ["o_custkey"], "date", ["v_sum"])


@query("population_ntile", "SELECT o_orderkey, CAST(ntile(100) OVER (ORDER BY o_totalprice, o_orderkey) AS INT) AS bucket FROM orders")
def _(t):
    return wi.population_ntile(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey").select("o_orderkey", "bucket")


@query("last_n_values", f"SELECT o_orderstatus, date, n FROM (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY date DESC) AS rn FROM (SELECT o_orderstatus, {_ODAY} AS date, count(*) AS n FROM orders GROUP BY 1, 2)) WHERE rn <= 3")
def _(t):
    per_day = t.orders.groupBy("o_orderstatus", F.date_format("o_orderdate", "yyyyMMdd").alias("date")).agg(F.count("*").alias("n"))
    return wi.last_n(per_day, ["o_orderstatus"], [F.col("date").desc()], 3)


@query("last_success", f"SELECT o_orderpriority, max({_ODAY}) AS success_date FROM orders WHERE o_orderstatus = 'F' GROUP BY 1")
def _(t):
    from rollspan.operators.jobs import last_success
    log = t.orders.where("o_orderstatus = 'F'").select("o_orderpriority", F.date_format("o_orderdate", "yyyyMMdd").alias("success_date"))
    return last_success(log, "o_orderpriority")


@query("topk_cumulative_cut", f"""WITH p AS (SELECT p_brand, sum(l_quantity) / (SELECT sum(l_quantity) FROM lineitem JOIN part ON p_partkey = l_partkey) AS share FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1),
    c AS (SELECT *, sum(share) OVER (ORDER BY share DESC, p_brand ROWS UNBOUNDED PRECEDING) AS cumulative FROM p) SELECT p_brand, {R('share', 'share')}, {R('cumulative', 'cumulative')} FROM c WHERE cumulative <= 0.5""")
def _(t):
    from rollspan.session import with_scalars
    rows = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey"))
    brands = rows.groupBy("p_brand").agg(F.sum("l_quantity").alias("q"))
    share = with_scalars(brands, brands.agg(F.sum("q").alias("w"))).select("p_brand", (F.col("q") / F.col("w")).alias("share"))
    return wi.cumulative_cut(share, "share", ["p_brand"], 0.5)


# --- G: sets ----------------------------------------------------------------------------------------------

@query("union_all", "SELECT k, count(*) AS n FROM (SELECT l_suppkey AS k FROM lineitem UNION ALL SELECT l_partkey FROM lineitem) GROUP BY 1")
def _(t):
    return t.lineitem.select(F.col("l_suppkey").alias("k")).unionAll(t.lineitem.select("l_partkey")).groupBy("k").agg(F.count("*").alias("n"))


@query("union_by_name", "SELECT c_custkey AS id, c_acctbal, NULL::VARCHAR AS p_name FROM customer UNION ALL SELECT p_partkey, NULL, p_name FROM part")
def _(t):
    return t.customer.select(F.col("c_custkey").alias("id"), "c_acctbal").unionByName(t.part.select(F.col("p_partkey").alias("id"), "p_name"), allowMissingColumns=True)


@query("union_distinct_ids", "SELECT o_custkey AS k FROM orders UNION SELECT l_suppkey FROM lineitem")
def _(t):
    return jo.spine([t.orders.select(F.col("o_custkey").alias("k")), t.lineitem.select(F.col("l_suppkey").alias("k"))], "k")


@query("distinct_on_subset", f"SELECT tac, max(gsma_device_type) AS t FROM (SELECT tac, gsma_device_type FROM ({role_sql('catalogue')})) GROUP BY 1")
def _(t):
    rows = t.catalogue.select("tac", F.col("gsma_device_type").alias("t"))
    return wi.latest_per_key(rows, ["tac"], [])
