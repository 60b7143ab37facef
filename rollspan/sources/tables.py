"""Scans and sinks. File layout is hive-partitioned parquet with string partition keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rollspan.functions.calendar import as_date, shift_months, ymd


def scan(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """Parquet directory whose partition values stay strings.

    Inferred integers would lose leading zeros and would be compared with ``yyyyMMdd``
    literals through casts. Inference happens while the frame is created and can only be
    switched per session, so the setting is put back right after.
    """
    key = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        return spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path)
    finally:
        spark.conf.set(key, before)


def scan_query(spark: SparkSession, query: str, options: Mapping[str, str] | None = None,
               views: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """A SQL query pushed to a database (JDBC ``options``) or run over ``views``.

    For a parallel JDBC read pass ``dbtable`` with ``partitionColumn``, ``lowerBound``,
    ``upperBound`` and ``numPartitions`` in ``options`` and leave ``query`` empty.
    """
    if options is not None:
        reader = spark.read.format("jdbc").options(**options)
        return (reader.option("query", query) if query else reader).load()
    return spark.sql(query, **(views or {}))


def scan_jdbc_slices(spark: SparkSession, table: str, url: str, predicates: Sequence[str],
                     properties: Mapping[str, str]) -> DataFrame:
    """One task per predicate, e.g. one per (date, key prefix) slice."""
    return spark.read.jdbc(url, table, predicates=list(predicates), properties=dict(properties))


def sql_over(spark: SparkSession, views: Mapping[str, DataFrame], sql: str) -> DataFrame:
    """SQL text over named frames (``{name}`` placeholders)."""
    return spark.sql(sql, **views)


def rebalance(df: DataFrame, *cols: str) -> DataFrame:
    """Ask AQE to size output partitions to the advisory size, splitting skewed ones.

    The target is ``spark.sql.adaptive.advisoryPartitionSizeInBytes``; sizes are measured
    on shuffle output at run time instead of being estimated by a count up front.
    """
    return df.hint("rebalance", *[F.col(c) for c in cols]) if cols else df.hint("rebalance")


def write_partition(df: DataFrame, path: str, by: Sequence[str] = ("date",), mode: str = "overwrite",
                    balanced: bool = True) -> None:
    """Overwrite only the partitions present in ``df`` (or append to them)."""
    out = rebalance(df, *by) if balanced else df
    (out.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path))


def file_sizes(spark: SparkSession, path: str) -> list[int]:
    """Bytes of each data file under ``path``."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(folder, True)
    out = []
    while found.hasNext():
        f = found.next()
        if not f.getPath().getName().startswith(("_", ".")):
            out.append(f.getLen())
    return out


def write_sized(df: DataFrame, path: str, target: int = 128 << 20, like: str | None = None, mode: str = "overwrite") -> int:
    """Write ``df`` in files of about ``target`` bytes each; returns their number.

    ``like`` is a folder with an earlier write of such rows: its bytes per row say how large the files get. Without one, the size that
    Spark estimates for the plan does, which knows nothing of encoding and compression. Partitions are merged if there are too many, else rows are dealt anew.
    """
    spark = df.sparkSession
    rows = df.count()
    if like is not None and (before := spark.read.parquet(like).count()):
        size = rows * sum(file_sizes(spark, like)) / before
    else:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    files = max(1, round(size / target))
    df.repartition(files).write.mode(mode).parquet(path)
    return files


def store_by_key(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Store ``df`` as table ``name`` in ``path``, one sorted file per bucket of the keys; the stored table.

    Tables stored with the same keys and number of buckets join and aggregate by these keys without a shuffle.
    """
    placed = df.repartition(buckets, *keys).sortWithinPartitions(*keys)
    placed.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def open_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Log table with a fixed schema; created empty on first use."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        spark.createDataFrame([], schema).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def cutover_union(old: DataFrame, new: DataFrame, date_col: str, cutover: str) -> DataFrame:
    """Old table before the cut-over date, new table from it on. Both filters push down."""
    return old.where(F.col(date_col) < cutover).unionByName(new.where(F.col(date_col) >= cutover), allowMissingColumns=True)


def latest_snapshot(df: DataFrame, date_col: str, upto: str | None = None, months: int | None = 3) -> DataFrame:
    """Rows of the newest snapshot inside the look-back (none: empty result).

    The maximum is a one-row aggregate joined back; the look-back bounds the scan.
    """
    rows = df
    if upto is not None:
        rows = rows.where(F.col(date_col) <= upto)
        if months is not None:
            rows = rows.where(F.col(date_col) >= ymd(shift_months(as_date(upto), -months)))
    newest = rows.agg(F.max(date_col).alias(date_col))
    return rows.join(F.broadcast(newest), date_col, "left_semi")


def latest_per_period(df: DataFrame, date_col: str, period_col: str, periods: Sequence) -> DataFrame:
    """Newest snapshot of each wanted period (e.g. the last day of each month key)."""
    rows = df.where(F.col(period_col).isin(list(periods)))
    newest = rows.groupBy(period_col).agg(F.max(date_col).alias(date_col))
    return rows.join(newest, [period_col, date_col], "left_semi")


def partition_dates(df: DataFrame, col: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Distinct partition values in ``[start, end]``."""
    rows = df.select(col)
    if start is not None:
        rows = rows.where(F.col(col) >= start)
    if end is not None:
        rows = rows.where(F.col(col) <= end)
    return rows.distinct()


def ingest_slices(src: DataFrame, path: str, table: str, date_col: str, key_col: str,
                  after: str | None, upto: str, prefix_len: int = 1) -> None:
    """Copy all new (date, key prefix) slices in one job instead of one query per slice."""
    rows = src.where(F.col(date_col) <= upto)
    if after is not None:
        rows = rows.where(F.col(date_col) > after)
    out = rows.withColumns({"table_name": F.lit(table),
                            "partition_col": F.substring(F.col(key_col).cast("string"), 1, prefix_len)})
    write_partition(out, path, by=["table_name", date_col, "partition_col"])


def today() -> str:
    return ymd(date.today())
