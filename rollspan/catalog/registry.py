"""Registry, test tables and the rounding both engines apply before values are compared."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rollspan.catalog.roles import ROLES
from rollspan.functions.calendar import as_date
from rollspan.functions.numeric import quoted

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()

EVENT_TIME = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


class Data:
    """Test tables and the roles they stand in for, as lazy frames."""

    def __init__(self, spark: SparkSession, sf_dir: str, bounds: tuple[str, str] | None = None):
        self.spark, self._dir, self._bounds = spark, sf_dir, bounds

    def back(self, snapshot: str, weeks: int = 24) -> "Data":
        """The same data with event tables cut to the look-back of a snapshot (inclusive).

        Roles compute their ``yyyyMMdd`` partition column from a timestamp, so this states
        the window on the stored column, where the scan can use it; a table that is
        partitioned by the date string needs no such help.
        """
        d = as_date(snapshot)
        return Data(self.spark, self._dir, (str(d - timedelta(days=7 * weeks)), str(d + timedelta(days=1))))

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            df = self.spark.read.parquet(f"{self._dir}/{name}.parquet")
            if self._bounds and name in EVENT_TIME:
                lo, hi = (F.lit(b).cast("timestamp_ntz") for b in self._bounds)
                df = df.where((F.col(EVENT_TIME[name]) >= lo) & (F.col(EVENT_TIME[name]) < hi))
            return df
        if name in ROLES:
            return self.role(name)
        raise AttributeError(name)

    def role(self, name: str) -> DataFrame:
        text = ROLES[name]
        used = {t: getattr(self, t) for t in TABLES if "{" + t + "}" in text}
        return self.spark.sql(text, **used)


def digits_for(name: str) -> int:
    """Decimals kept per column so that summation order cannot show in a comparison."""
    if "sumsq" in name:
        return -3
    if "_vs_" in name or "ratio" in name or "pct" in name:
        return 6
    if "std" in name:
        return 3
    if "sum" in name or "davg" in name or name.startswith("usageda"):
        return 2
    return 6


def _offset(digits: int) -> float:
    # moves exact halves off the rounding boundary, where the two engines could differ
    return 0.131234567 * 10.0 ** -digits


def rounded(df: DataFrame) -> DataFrame:
    out = []
    for f in df.schema.fields:
        c = quoted(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            d = digits_for(f.name)
            c = f"round(CAST({c} AS DOUBLE) + CAST({_offset(d)!r} AS DOUBLE), {d}) AS {c}"
        out.append(c)
    return df.selectExpr(*out)


def R(expr: str, name: str) -> str:
    """The SQL counterpart of :func:`rounded` for one column."""
    d = digits_for(name)
    return f'round(CAST({expr} AS DOUBLE) + {_offset(d)!r}, {d}) AS "{name}"'


def I(expr: str, name: str) -> str:  # noqa: E743
    return f'CAST({expr} AS BIGINT) AS "{name}"'


def role_sql(name: str) -> str:
    return ROLES[name].format(**{t: t for t in TABLES})


def query(name: str, sql: str | Callable[[], str] | None = None):
    """Register ``f(data) -> DataFrame`` with its oracle."""
    def add(f):
        @wraps(f)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(f(Data(spark, sf_dir)))
        assert name not in _QUERIES, name
        _QUERIES[name] = run
        if sql is not None:
            _SQL[name] = (sql() if callable(sql) else sql).strip()
        return run
    return add


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
