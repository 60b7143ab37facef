"""Filling, capping, casting, projecting and renaming of wide feature tables, always in a
single projection however many columns there are."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from rollspan.functions.numeric import quoted as q


def present(df: DataFrame, columns: Iterable[str], absent: str = "raise") -> list[str]:
    """Those of ``columns`` that ``df`` has; one that it lacks raises unless ``absent="skip"``."""
    if absent not in ("raise", "skip"):
        raise ValueError(f"absent must be 'raise' or 'skip', not {absent!r}")
    columns, have = list(columns), set(df.columns)
    lacking = [c for c in columns if c not in have]
    if lacking and absent == "raise":
        raise ValueError(f"absent columns: {', '.join(lacking)}")
    return [c for c in columns if c in have]


def fill(df: DataFrame, strategy: str | Mapping[str, object] = "by_type", text: str = "ukn",
         item_text: str = "null", absent: str = "raise") -> DataFrame:
    """Replace NULLs.

    ``by_type``: numbers 0, strings ``text``; ``numeric``: numbers only; ``items``: columns
    named ``...item...`` get ``item_text``, other columns 0; a mapping gives explicit values
    (``absent``: see :func:`present`).
    """
    if not isinstance(strategy, str):
        return df.fillna({c: strategy[c] for c in present(df, strategy, absent)})
    values = {}
    for f in df.schema.fields:
        number = isinstance(f.dataType, T.NumericType)
        if strategy == "items" and "item" in f.name:
            values[f.name] = item_text
        elif number:
            values[f.name] = 0
        elif isinstance(f.dataType, T.StringType) and strategy == "by_type":
            values[f.name] = text
    return df.fillna(values)


def cap(df: DataFrame, caps: Mapping[str, float]) -> DataFrame:
    """Zero-fill, then cut at the stored upper bound."""
    return df.withColumns({c: F.least(F.coalesce(F.col(q(c)), F.lit(0.0)), F.lit(float(u))) for c, u in caps.items()})


def winsorize(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Clamp into ``feature: (lower, upper)``; NULL stays NULL."""
    return df.withColumns({
        c: F.when(F.col(q(c)).isNotNull(), F.greatest(F.lit(float(lo)), F.least(F.lit(float(hi)), F.col(q(c)))))
        for c, (lo, hi) in bounds.items()
    })


def cast_numeric(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(q(c)) if c in keys else F.col(q(c)).cast("double").alias(c) for c in df.columns])


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of a stored table, in its order and types; absent ones become NULL."""
    return df.select(*[
        (F.col(q(f.name)) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def project(df: DataFrame, features: Mapping[str, Sequence[str]], keys: Sequence[str]) -> DataFrame:
    """Keys plus the ``num`` and ``cat`` features of a feature dictionary entry."""
    return df.select(*keys, *[q(c) for c in (*features.get("num", ()), *features.get("cat", ()))])


def rename_by_stem(df: DataFrame, wanted: Sequence[str], prefix: str = r"^f\d+_") -> DataFrame:
    """Give columns the wanted numbered names when only the number prefix differs."""
    stems = {re.sub(prefix, "", w): w for w in wanted}
    present = set(df.columns)
    return df.withColumnsRenamed({
        c: stems[s] for c in df.columns
        if (s := re.sub(prefix, "", c)) in stems and stems[s] not in present
    })


def index_names(df: DataFrame, base: int, keys: Sequence[str]) -> DataFrame:
    """Prefix features with ``f<n>_`` counted from ``base`` in column order."""
    features = [c for c in df.columns if c not in keys]
    return df.withColumnsRenamed({c: f"f{base + i}_{c}" for i, c in enumerate(features)})
