"""Null-safe arithmetic used by ratio, share, trend and score features."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(part: Column | str, whole: Column | str) -> Column:
    """``part / whole``; NULL when ``whole`` is 0 or either side is NULL."""
    return F.try_divide(col(part).cast("double"), col(whole).cast("double"))


def quoted(name: str) -> str:
    """Column name as SQL text."""
    return "`" + name.replace("`", "``") + "`"


# Wide tables add hundreds of columns at once. As SQL text a whole batch is one call into
# the JVM; built as Column objects each operator of each column is several calls, which for
# such tables costs far more than planning and running the query.

def ratio_text(part: str, whole: str) -> str:
    """:func:`ratio` of two columns as SQL text."""
    return f"try_divide(CAST({quoted(part)} AS DOUBLE), CAST({quoted(whole)} AS DOUBLE))"


def total_text(cols: Sequence[str]) -> str:
    """:func:`total` of columns as SQL text (NULL when all parts are NULL)."""
    some = ", ".join(quoted(c) for c in cols)
    return f"CASE WHEN coalesce({some}) IS NOT NULL THEN {' + '.join(f'coalesce({quoted(c)}, 0)' for c in cols)} END"


def add_text(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    """Append computed columns given as SQL text in one projection."""
    return df.selectExpr("*", *[f"{e} AS {quoted(n)}" for n, e in exprs.items()])


def total(cols: Sequence[Column | str], null_if_all_null: bool = True) -> Column:
    """Sum treating NULL as 0; NULL only when every part is NULL."""
    parts = [col(c) for c in cols]
    summed = reduce(add, [F.coalesce(p, F.lit(0)) for p in parts])
    return F.when(F.coalesce(*parts).isNotNull(), summed) if null_if_all_null else summed


def share_entropy(shares: Sequence[Column | str]) -> Column:
    """Shannon entropy in bits of already computed shares; empty shares add 0."""
    terms = [F.when(col(p) > 0, -col(p) * F.log2(col(p))).otherwise(0.0) for p in shares]
    return reduce(add, terms)


def shares(df: DataFrame, parts: dict[str, Column | str], whole: Column | str) -> DataFrame:
    return df.withColumns({name: ratio(part, whole) for name, part in parts.items()})


def pair_ratios(df: DataFrame, cols: dict[str, str], name: str) -> DataFrame:
    """Ratio of every unordered pair; ``name`` has ``{a}`` and ``{b}`` for the labels."""
    labels = list(cols)
    return add_text(df, {
        name.format(a=a, b=b): ratio_text(cols[a], cols[b])
        for i, a in enumerate(labels) for b in labels[i + 1:]
    })


def rescale(df: DataFrame, factors: dict[str, float]) -> DataFrame:
    """Divide columns by a unit factor (60 for seconds to minutes, 1e6 for bytes to MB)."""
    return df.withColumns({c: F.col(c) / F.lit(float(f)) for c, f in factors.items()})


def logit(p: Column | str) -> Column:
    return F.ln(ratio(p, F.lit(1.0) - col(p)))


def band_flags(df: DataFrame, value: str, bands: dict[str, tuple]) -> DataFrame:
    """One 0/1 column per ``name: (low, high)`` band with ``low <= value < high``.

    A bound of None is open; ``low == high`` tests equality; a third tuple item
    ``"open"`` makes the lower bound strict.
    """
    def flag(low, high, kind="closed"):
        v = F.col(value)
        if low is not None and low == high:
            test = v == low
        else:
            test = F.lit(True)
            if low is not None:
                test = test & ((v > low) if kind == "open" else (v >= low))
            if high is not None:
                test = test & (v < high)
        return F.when(test, 1).otherwise(0)

    return df.withColumns({name: flag(*band) for name, band in bands.items()})


def segment(value: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label right-closed intervals ``(edge, next edge]``; outside all of them is NULL."""
    v = col(value)
    out = F.when(v <= edges[0], F.lit(None).cast("string"))
    for high, label in zip(edges[1:], labels):
        out = out.when(v <= F.lit(high), label)
    return out
