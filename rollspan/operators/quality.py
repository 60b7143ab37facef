"""Data-quality checks. Every check returns rows of one metric layout, stays lazy and uses
one scan per table; status comes from a moving-average baseline over the stored log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rollspan.functions.calendar import YMD, as_date, shift_months, ymd
from rollspan.functions.numeric import ratio
from rollspan.operators.fill import q
from rollspan.operators.windows import last_n, latest_per_key
from rollspan.session import with_scalars

LOG_SCHEMA = T.StructType([
    T.StructField("feature_name", T.StringType()), T.StructField("metric_value", T.StringType()),
    T.StructField("log_date", T.StringType()), T.StructField("layer", T.StringType()),
    T.StructField("snapshot", T.StringType()), T.StructField("destination", T.StringType()),
    T.StructField("dimension", T.StringType()), T.StructField("metric_name", T.StringType()),
    T.StructField("severity", T.StringType()), T.StructField("hard_threshold", T.DoubleType()),
    T.StructField("soft_threshold", T.DoubleType()), T.StructField("method", T.StringType()),
    T.StructField("status", T.StringType()),
])


def long_form(row: DataFrame, columns: Sequence[str], name: str = "feature_name", value: str = "metric_value") -> DataFrame:
    """Turn one wide row of metrics into (name, value) rows."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias(name), F.col(q(c)).alias(value)) for c in columns]))
    return row.select(pairs.alias("_p")).select(f"_p.{name}", f"_p.{value}")


def completeness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``feature_name, row_count, null_count, null_ratio`` of every column in one scan.

    ``row_count`` is the number of non-NULL values, the ratio is rounded to 4 digits.
    """
    columns = list(columns or df.columns)
    counts = df.agg(F.count(F.lit(1)).alias("_total"), *[F.count(q(c)).alias(f"n_{c}") for c in columns])
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("feature_name"), F.col(q(f"n_{c}")).alias("row_count")) for c in columns]))
    return (counts.select("_total", pairs.alias("_p"))
            .select("_p.feature_name", "_p.row_count", (F.col("_total") - F.col("_p.row_count")).alias("null_count"), "_total")
            .withColumn("null_ratio", F.round(ratio("null_count", "_total"), 4)).drop("_total"))


def schema_table(df: DataFrame) -> DataFrame:
    """``col_name, data_type, ordinal`` of a frame."""
    return df.sparkSession.createDataFrame(
        [(n, t, i) for i, (n, t) in enumerate(df.dtypes)], "col_name string, data_type string, ordinal int")


def column_names(schema: DataFrame, ref: DataFrame) -> DataFrame:
    """One row: both sorted name lists and PASS when they are the same set."""
    def names(s, alias):
        return s.agg(F.array_join(F.array_sort(F.collect_set("col_name")), ",").alias(alias))
    both = with_scalars(names(schema, "names"), names(ref, "ref_names"))
    return both.withColumn("status", F.when(F.col("names") == F.col("ref_names"), "PASS").otherwise("WARNING"))


def column_types(schema: DataFrame, ref: DataFrame) -> DataFrame:
    """Current vs reference type per column; added, dropped or changed columns warn."""
    joined = schema.select("col_name", "data_type").join(
        ref.select("col_name", F.col("data_type").alias("ref_type")), "col_name", "full_outer")
    return joined.withColumn("status", F.when(F.col("data_type").eqNullSafe(F.col("ref_type")), "PASS").otherwise("WARNING"))


def freshness_rule(newest: Column, asof: str, update_type: str, allow: int = 1) -> tuple[str, Column]:
    """The partition expected at ``asof``, and whether the newest one is good.

    daily: exactly ``allow`` days ago; weekly: this week's Monday; monthly: not older than
    ``allow`` months before the first of this month (``yyyyMM`` partitions).
    """
    d = as_date(asof)
    if update_type == "daily":
        expected = (d.fromordinal(d.toordinal() - allow)).strftime("%Y%m%d")
        return expected, newest == expected
    if update_type == "weekly":
        expected = d.fromordinal(d.toordinal() - d.weekday()).strftime("%Y%m%d")
        return expected, newest == expected
    if update_type == "monthly":
        expected = ymd(shift_months(d.replace(day=1), -allow))[:6]
        return expected, F.substring(newest, 1, 6) >= expected
    raise ValueError(f"unknown update type {update_type!r}")


def freshness(df: DataFrame, date_col: str, asof: str, update_type: str, allow: int = 1) -> DataFrame:
    """Newest partition against the one expected at ``asof`` (see :func:`freshness_rule`)."""
    newest = F.max(F.col(date_col).cast("string"))
    expected, good = freshness_rule(newest, asof, update_type, allow)
    return df.agg(newest.alias("latest"), F.lit(expected).alias("expected"),
                  F.when(good, "PASS").otherwise("ERROR").alias("status"))


def pk_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many key values occur more than once and how many rows they hold."""
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    twice = F.col("_n") > 1
    return groups.agg(F.count(F.when(twice, 1)).alias("duplicate_keys"),
                      F.coalesce(F.sum(F.when(twice, F.col("_n"))), F.lit(0)).alias("duplicate_rows"),
                      F.when(F.count(F.when(twice, 1)) > 0, "ERROR").otherwise("PASS").alias("status"))


def row_digest(columns: Sequence[str]) -> Column:
    """SHA-256 of a whole row. NULL has its own marker so that rows which differ only in
    where a NULL stands keep different digests."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(q(c)).cast("string")), F.lit("~")) for c in columns]
    return F.sha2(F.concat_ws("||", *parts), 256)


def row_duplicates(df: DataFrame) -> DataFrame:
    """One row: digests seen more than once; only the digest is shuffled, not the row."""
    return pk_duplicates(df.select(F.unhex(row_digest(df.columns)).alias("_d")), ["_d"])


def validity(df: DataFrame, rules: Mapping[str, tuple[str, object]]) -> DataFrame:
    """Rows violating each ``column: (op, value)`` rule, all rules in one scan.

    Ops ``>=``, ``<=``, ``>``, ``<`` compare with a bound, ``in`` tests a domain. NULL is a
    completeness matter and violates nothing.
    """
    row = df.agg(*[F.count(F.when(violated(c, op, v), 1)).alias(c) for c, (op, v) in rules.items()])
    return long_form(row, list(rules)).withColumn(
        "status", F.when(F.col("metric_value") > 0, "ERROR").otherwise("PASS"))


def violated(c: str, op: str, value) -> Column:
    """Whether a row breaks a rule of :func:`validity`."""
    v = F.col(q(c))
    return ~{"in": lambda: v.isin(list(value)), ">=": lambda: v >= value, "<=": lambda: v <= value,
             ">": lambda: v > value, "<": lambda: v < value}[op]()


def past_logs(log: DataFrame, asof: str, **fields: str) -> DataFrame:
    """Log rows before ``asof`` with the given dimension/metric_name/severity/destination.

    Destinations are compared in one canonical form (``/`` as ``_``).
    """
    out = log.where(F.col("snapshot") < asof)
    for name, value in fields.items():
        out = out.where(F.col(name) == (value.replace("/", "_") if name == "destination" else value))
    return out


def moving_average(log: DataFrame, n: int = 3, keys: Sequence[str] = ("feature_name",)) -> DataFrame:
    """Mean of the last ``n`` daily values per feature, NULL with fewer than ``n``.

    Several log entries on one day count once (the latest).
    """
    rows = log.select(*keys, F.substring(F.col("log_date"), 1, 8).alias("day"), "log_date",
                      F.col("metric_value").try_cast("double").alias("metric_value"))
    daily = latest_per_key(rows, [*keys, "day"], ["log_date"])
    recent = last_n(daily, keys, [F.col("day").desc()], n)
    return recent.groupBy(*keys).agg(
        F.count("metric_value").alias("observations"),
        F.when(F.count("metric_value") == n, F.avg("metric_value")).alias("ma"))


def status(value: Column, ma: Column, soft: float, hard: float, layer: Column | str = "database") -> Column:
    """Relative distance from the baseline: above ``hard`` ERROR (WARNING on feature
    tables), from ``soft`` on WARNING, else PASS; no baseline passes."""
    layer = F.lit(layer) if isinstance(layer, str) else layer
    gap = F.when(ma == 0, F.when(value == 0, 0.0).otherwise(float("inf"))).otherwise(ratio(F.abs(value - ma), F.abs(ma)))
    return (F.when(ma.isNull() | value.isNull(), "PASS")
            .when(gap > hard, F.when(layer == "database", "ERROR").otherwise("WARNING"))
            .when(gap >= soft, "WARNING").otherwise("PASS"))


def gate(log: DataFrame, snapshot: str, layer: str) -> DataFrame:
    """Errors among the latest result per check and day of one snapshot."""
    rows = log.where((F.col("snapshot") == snapshot) & (F.col("layer") == layer)).withColumn(
        "day", F.substring("log_date", 1, 8))
    keys = ["destination", "metric_name", "feature_name", "day"]
    latest = latest_per_key(rows.select(*keys, "log_date", "status"), keys, ["log_date"])
    return latest.agg(F.count(F.lit(1)).alias("checks"), F.count(F.when(F.col("status") == "ERROR", 1)).alias("errors"),
                      F.when(F.count(F.when(F.col("status") == "ERROR", 1)) > 0, "ERROR").otherwise("PASS").alias("status"))


class QualityError(RuntimeError):
    """The gate found an ERROR result."""


def enforce(log: DataFrame, snapshot: str, layer: str) -> None:
    """Fail the job when the gate is red (one small row is read)."""
    row = gate(log, snapshot, layer).first()
    if row["status"] == "ERROR":
        raise QualityError(f"{row['errors']} failed checks for {snapshot} ({layer})")


def report_rows(log: DataFrame, top_features: DataFrame) -> DataFrame:
    """Drop completeness rows about features that are not in the watched list."""
    watched = log.join(top_features.select("feature_name").distinct(), "feature_name", "left_semi")
    return log.where(F.col("dimension") != "completeness").unionByName(
        watched.where(F.col("dimension") == "completeness"))


def rowcount_check(df: DataFrame, date_col: str, history: DataFrame, asof: str, n: int = 3, tol: float = 0.05) -> DataFrame:
    """Rows per date from ``asof`` on against the mean of the last ``n`` logged counts.

    ``history`` holds ``(date, row_count)``; without ``n`` observations there is no
    baseline and the status is NULL (first run).
    """
    recent = history.where(F.col("date") < asof).orderBy(F.col("date").desc()).limit(n)
    base = recent.agg(F.when(F.count(F.lit(1)) == n, F.avg("row_count")).alias("value_compare"))
    counts = df.where(F.col(date_col) >= asof).groupBy(F.col(date_col).alias("date")).agg(F.count(F.lit(1)).alias("row_count"))
    gap = ratio(F.abs(F.col("row_count") - F.col("value_compare")), F.col("value_compare"))
    return with_scalars(counts, base).withColumn(
        "status", F.when(F.col("value_compare").isNull(), None).when(gap <= tol, "pass").otherwise("fail"))


def _repeated(df: DataFrame, snapshot: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """Per snapshot: groups of equal keys that occur more than once, and their rows."""
    groups = df.groupBy(*snapshot, *keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    return groups.groupBy(*snapshot).agg(F.count(F.lit(1)).alias("groups"), F.sum("_n").alias("rows"))


def table_checks(df: DataFrame, name: str, config: Mapping, dates: Sequence[str]) -> DataFrame:
    """``snapshot, destination, dimension, metric_name, severity, feature_name, metric_value, status`` of all checks of a table at some dates.

    All counts of all columns, rules and dates are one aggregate in one scan, turned into rows by one unpivot; repeated keys and repeated rows take
    a scan each, because they group by something else. ``status`` is NULL where the log decides. ``config["partition"]`` names the column that
    holds each row's date: a check then sees the rows of its date only (none: counts of 0); without it, every date sees the whole table.
    """
    columns, rules, part = list(config.get("columns") or df.columns), config.get("validity") or {}, config.get("partition")
    by = ["snapshot"] if part else []
    rows = df.withColumn("snapshot", F.col(q(part)).cast("string")).where(F.col(q(part)).isin(list(dates))) if part else df
    counts = [F.count(F.lit(1)).alias("total"), *[F.count(q(c)).alias(f"n{i}") for i, c in enumerate(columns)],
              *[F.count(F.when(violated(c, op, v), 1)).alias(f"v{i}") for i, (c, (op, v)) in enumerate(rules.items())]]
    if config.get("date"):
        counts.append(F.max(F.col(q(config["date"])).cast("string")).alias("newest"))

    def at_dates(one: DataFrame) -> DataFrame:
        """One row per wanted date."""
        wanted = df.sparkSession.createDataFrame([(d,) for d in dates], "snapshot string")
        return wanted.join(one, "snapshot", "left") if part else one.withColumn("snapshot", F.explode(F.array(*map(F.lit, dates))))

    def unpivot(one: DataFrame, checks: Sequence[tuple]) -> DataFrame:
        cells = F.explode(F.array(*[F.struct(
            F.lit(dimension).alias("dimension"), F.lit(metric).alias("metric_name"), F.lit(severity).alias("severity"), F.lit(feature).alias("feature_name"),
            value.cast("string").alias("metric_value"), state.cast("string").alias("status")) for dimension, metric, severity, feature, value, state in checks]))
        return at_dates(one).select("snapshot", F.lit(name.replace("/", "_")).alias("destination"), cells.alias("_c")).select("snapshot", "destination", "_c.*")

    total, none, zero = F.coalesce("total", F.lit(0)), F.lit(None), F.lit(0)
    checks = []
    for i, c in enumerate(columns):
        present = F.coalesce(f"n{i}", zero)
        checks += [("completeness", "null_ratio", "moving_average", c, F.round(ratio(total - present, total), 4), none),
                   ("completeness", "null_count", "moving_average", c, total - present, none),
                   ("completeness", "row_count", "moving_average", c, present, none)]
    if config.get("date"):
        good, allow = F.lit(False), 1 if config.get("expected_day") is None else config["expected_day"]
        for d in dates:
            good = F.when(F.col("snapshot") == d, freshness_rule(F.col("newest"), d, config.get("update_type", "daily"), allow)[1]).otherwise(good)
        checks.append(("timeliness", "freshness", "fixed", config["date"], F.col("newest"), F.when(good, "PASS").otherwise("ERROR")))
    for i, c in enumerate(rules):
        broken = F.coalesce(f"v{i}", zero)
        checks.append(("validity", "rule", "fixed", c, broken, F.when(broken > 0, "ERROR").otherwise("PASS")))
    out = [unpivot(rows.groupBy(*by).agg(*counts), checks)]
    repeated = F.when(F.coalesce("groups", zero) > 0, "ERROR").otherwise("PASS")
    if config.get("key"):
        out.append(unpivot(_repeated(rows, by, config["key"]), [
            ("uniqueness", "primary_key", "fixed", ",".join(config["key"]), F.coalesce("groups", zero), repeated)]))
    digest = F.unhex(row_digest(df.columns)).alias("_d")
    out.append(unpivot(_repeated(rows.select(*by, digest), by, ["_d"]), [
        ("uniqueness", "duplicate_records", "fixed", "*", F.coalesce("rows", zero), repeated)]))
    if config.get("ref_schema") is not None:
        types = column_types(schema_table(df), config["ref_schema"])
        out.append(types.select(F.explode(F.array(*map(F.lit, dates))).alias("snapshot"), F.lit(name.replace("/", "_")).alias("destination"), F.lit("consistency").alias("dimension"),
                                F.lit("data_type").alias("metric_name"), F.lit("fixed").alias("severity"), F.col("col_name").alias("feature_name"),
                                F.col("data_type").alias("metric_value"), "status"))
    return reduce(DataFrame.unionByName, out)


def judge(checks: DataFrame, log: DataFrame | None, dates: Sequence[str], layer: str, soft: float, hard: float, n: int,
          log_date: str | None = None) -> DataFrame:
    """Log rows of ``checks``: open ones are compared with the moving average of the log before their date.

    One pass over the log serves all tables and dates.
    """
    if log is None:
        judged = checks.withColumn("status", F.coalesce("status", F.lit("PASS")))
    else:
        keys = ["destination", "metric_name", "feature_name", "asof"]
        later = F.filter(F.array(*map(F.lit, dates)), lambda d: d > F.col("snapshot"))
        past = log.where((F.col("dimension") == "completeness") & (F.col("snapshot") < max(dates))).withColumn("asof", F.explode(later))
        base = moving_average(past, n, keys).withColumnRenamed("asof", "snapshot").drop("observations")
        judged = checks.join(base, ["destination", "metric_name", "feature_name", "snapshot"], "left")
        compared = status(F.col("metric_value").try_cast("double"), F.col("ma"), soft, hard, layer)
        judged = judged.withColumn("status", F.coalesce("status", F.when(F.col("dimension") == "completeness", compared).otherwise("PASS")))
    return judged.select(
        "feature_name", "metric_value", F.coalesce(F.lit(log_date), F.col("snapshot")).alias("log_date"), F.lit(layer).alias("layer"), "snapshot",
        "destination", "dimension", "metric_name", "severity", F.lit(hard).alias("hard_threshold"), F.lit(soft).alias("soft_threshold"),
        F.concat("severity", F.lit(str(n))).alias("method"), "status")


def run_suite(df: DataFrame, name: str, config: Mapping, asof: "str | Sequence[str]", layer: str = "database",
              log: DataFrame | None = None, log_date: str | None = None,
              soft: float = 0.05, hard: float = 0.2, n: int = 3) -> DataFrame:
    """All configured checks of one table, at one or several dates, as log rows, in at most three scans of it.

    ``config`` may hold ``columns``, ``partition``, ``date``, ``update_type``, ``expected_day``, ``key``,
    ``validity`` and ``ref_schema``. Completeness metrics are compared with the moving
    average of ``log`` when one is given.
    """
    dates = [asof] if isinstance(asof, str) else list(asof)
    return judge(table_checks(df, name, config, dates), log, dates, layer, soft, hard, n, log_date)


def run_layer(tables: Mapping[str, DataFrame], config: Mapping[str, Mapping], asof: "str | Sequence[str]", layer: str,
              log: DataFrame | None = None, log_date: str | None = None, soft: float = 0.05, hard: float = 0.2, n: int = 3) -> DataFrame | None:
    """The suite over every configured table and date; feature tables are checked on Mondays only (None if there is none)."""
    dates = [asof] if isinstance(asof, str) else list(asof)
    if layer == "feature":
        dates = [d for d in dates if as_date(d).weekday() == 0]
    if not dates:
        return None
    checks = [table_checks(tables[t], t, config[t], dates) for t in config if t in tables]
    return judge(reduce(DataFrame.unionByName, checks), log, dates, layer, soft, hard, n, log_date)
