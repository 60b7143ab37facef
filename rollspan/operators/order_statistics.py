"""Exact order statistics of many columns without sorting or shuffling their values.

A quantile sketch per column brackets each wanted rank between two values of the column. One pass counts, for all columns, the
rows between and at these values; a rank that falls on one of them is found, any other is bracketed again by a sketch of
the values inside its bracket. Each round leaves about 1 / ``GRID`` of a bracket's rows, so columns of a billion values take three
rounds, and a round always takes a value out of every bracket, so the result is exact whatever the sketches say.

Rows are spread over columns inside the tasks only and combined there: what is shuffled is one sketch and a few counts
per task and column. The driver holds the bracket values: columns x (ranks + ``GRID``) numbers.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Points at which a sketch is read, and its accuracy.
GRID, ACCURACY = 200, 10_000


def number(x: float) -> str:
    """A double as SQL text."""
    return f"CAST('{x!r}' AS DOUBLE)"


def spread(df: DataFrame, columns: Sequence[Column], keep: Sequence[str] = ()) -> DataFrame:
    """``keep..., i, x``: one row per non-NULL value, where ``i`` is the column's place. Meant to be aggregated right away."""
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), c.alias("x")) for i, c in enumerate(columns)])
    rows = df.select(*keep, F.explode(pairs).alias("_p")).select(*keep, "_p.i", "_p.x")
    return rows.where(F.col("x").isNotNull())


def below(x: str, cuts: Sequence[float], first: int = 0) -> str:
    """SQL text: ``first`` plus the number of sorted ``cuts`` below ``x``, by bisection, so that many cuts don't nest deeply."""
    if not cuts:
        return str(first)
    mid = len(cuts) // 2
    return f"CASE WHEN {x} > {number(cuts[mid])} THEN {below(x, cuts[mid + 1:], first + mid + 1)} ELSE {below(x, cuts[:mid], first)} END"


def _slot(x: str, cuts: Sequence[float], first: int = 0) -> str:
    """SQL text: 2 x the number of sorted, distinct ``cuts`` below ``x``, plus 1 if ``x`` is a cut."""
    if not cuts:
        return str(2 * first)
    mid = len(cuts) // 2
    cut = number(cuts[mid])
    return (f"CASE WHEN {x} > {cut} THEN {_slot(x, cuts[mid + 1:], first + mid + 1)} WHEN {x} >= {cut} THEN {2 * (first + mid) + 1} "
            f"ELSE {_slot(x, cuts[:mid], first)} END")


def _slotted(values: DataFrame, cuts: Mapping[int, Sequence[float]]) -> DataFrame:
    """``i, x, slot`` of the columns that have cuts."""
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"x{i}").alias("x"), F.expr(_slot(f"x{i}", c)).alias("slot")) for i, c in cuts.items()])
    return values.select(F.explode(pairs).alias("_p")).select("_p.i", "_p.x", "_p.slot").where(F.col("x").isNotNull())


def order_statistics(df: DataFrame, columns: Sequence[Column], ranks: Callable[[int], Sequence[int]]) -> tuple[list[int], list[list[float]]]:
    """Number of non-NULL values of each column, and its values at the ranks (from 1) that ``ranks`` names for that number.

    NaN is a value above all others. A column without values has no ranks.
    """
    values = df.select(*[c.cast("double").alias(f"x{i}") for i, c in enumerate(columns)])
    rows = spread(values, [F.col(c) for c in values.columns])
    grid = [g / GRID for g in range(GRID + 1)]
    sketch = F.percentile_approx("x", grid, ACCURACY).alias("at")
    first = {r.i: r for r in rows.groupBy("i").agg(F.count("x").alias("n"), sketch).collect()}
    sizes = [first[i].n if i in first else 0 for i in range(len(columns))]
    wanted = {i: [min(max(1, r), n) for r in ranks(n)] for i, n in enumerate(sizes) if n}
    found: dict[int, dict[int, float]] = {i: {} for i in wanted}
    # (column, rank): grid of the bracket, rank and number of rows inside it
    open_ranks = {(i, r): (first[i].at, r, sizes[i]) for i, rs in wanted.items() for r in rs}
    bounds: dict[int, set[float]] = {i: set() for i in wanted}
    while open_ranks:
        cuts = {i: set(bounds[i]) for i, _ in open_ranks}
        for (i, _), (at, r, n) in open_ranks.items():
            g = (r - 0.5) / n * GRID
            cuts[i].update(at[min(max(0, k), GRID)] for k in range(math.floor(g) - 1, math.ceil(g) + 2))
            # the ends of the bracket, where the rank is certain to lie between
            cuts[i].update((at[0], at[GRID]))
        # a set of floats may hold several NaN; they sort last and count as one
        cuts = {i: [v for k, v in enumerate(vs) if k == 0 or not (v == vs[k - 1] or (v != v and vs[k - 1] != vs[k - 1]))]
                for i, vs in ((i, sorted(v, key=lambda x: (x != x, x if x == x else 0.0))) for i, v in cuts.items())}
        counted = _slotted(values, cuts)
        by_slot: dict[int, dict[int, int]] = {i: {} for i in cuts}
        for i, slot, n in counted.groupBy("i", "slot").agg(F.count("x")).collect():
            by_slot[i][slot] = n
        left: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        for i, r in open_ranks:
            before = 0
            for slot in sorted(by_slot[i]):
                n = by_slot[i][slot]
                if before + n >= r:
                    break
                before += n
            if slot % 2:
                found[i][r] = cuts[i][slot // 2]
            else:
                left.setdefault((i, slot), []).append((r, r - before, n))
        open_ranks, bounds = {}, {i: set() for i in wanted}
        if left:
            inside = F.struct("i", "slot").isin([F.struct(F.lit(i), F.lit(s)) for i, s in left])
            for i, slot, at in counted.where(inside).groupBy("i", "slot").agg(sketch).collect():
                bounds[i].update(cuts[i][max(0, slot // 2 - 1):slot // 2 + 1])
                open_ranks |= {(i, r): (at, inner, n) for r, inner, n in left[i, slot]}
    return sizes, [[found[i][r] for r in wanted[i]] if i in wanted else [] for i in range(len(columns))]


def percentiles(df: DataFrame, columns: Sequence[Column], ps: Sequence[float]) -> list[list[float | None]]:
    """Linearly interpolated percentiles of each column; None without values."""
    def ranks(n: int) -> list[int]:
        return [k for p in ps for k in (math.floor((n - 1) * p) + 1, math.ceil((n - 1) * p) + 1)]
    sizes, found = order_statistics(df, columns, ranks)
    out = []
    for n, v in zip(sizes, found):
        at = [(n - 1) * p for p in ps]
        out.append([lo if lo == hi else lo + (hi - lo) * (a - math.floor(a)) for a, lo, hi in zip(at, v[::2], v[1::2])] if n else [None] * len(ps))
    return out


def equal_frequency_edges(df: DataFrame, columns: Sequence[Column], n: int) -> list[list[float]]:
    """Distinct inner edges of ``n`` equal-frequency bins: each the smallest value with its share of the non-NULL rows at or below it."""
    values = order_statistics(df, columns, lambda rows: [-(-rows * i // n) for i in range(1, n)])[1]
    return [list(dict.fromkeys(v)) for v in values]
