"""The shape all windowed families share."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from rollspan.operators.aggregates import Measure, sliced_stats
from rollspan.operators.rollups import WEEKS, daily_to_weekly, lookback, weekly, widen, widen_rings


@dataclass(frozen=True)
class Family:
    """prepare raw rows -> weekly snapshot rows -> all windows -> ratios and trends.

    With ``extremes`` the weekly rows come from daily sums so that minima and maxima of
    daily sums exist. ``reduced`` says that ``prepare`` already leaves only a few rows per
    key and day: they are placed by key once and everything after runs in place, also the
    distinct counts. ``weekly()`` is what a scheduled job stores once per week;
    ``from_weekly()`` turns stored weeks into the wide table, ``features()`` does both in
    one plan.
    """

    name: str
    prepare: Callable[[DataFrame], DataFrame]
    measures: Sequence[Measure]
    finish: Callable[[DataFrame, Sequence[int]], DataFrame]
    keys: Sequence[str] = ("msisdn",)
    day: str = "s3_file_date"
    extremes: Mapping[str, str] = field(default_factory=dict)
    reduced: bool = False

    @property
    def stored(self) -> list[Measure]:
        out = list(self.measures)
        for source, template in self.extremes.items():
            out += [Measure(template.format(op="dmin"), "min", source),
                    Measure(template.format(op="dmax"), "max", source)]
        return out

    def daily(self, raw: DataFrame) -> DataFrame:
        return sliced_stats(self.prepare(raw), [*self.keys, self.day], self.measures)

    def weekly(self, raw: DataFrame, snapshot: str, weeks: int = 24, bands: Sequence[int] | None = None) -> DataFrame:
        if self.reduced:
            placed = lookback(self.prepare(raw), self.day, snapshot, weeks).repartition(*self.keys)
            return sliced_stats(placed, [*self.keys, "week_back"], self.measures)
        if not self.extremes:
            return weekly(self.prepare(raw), self.keys, self.day, snapshot, self.measures, weeks, bands)
        sums = [m.name for m in self.measures]
        return daily_to_weekly(self.daily(raw), self.keys, self.day, snapshot, sums, self.extremes, weeks, bands)[0]

    def from_weekly(self, weeks_df: DataFrame, windows: Sequence[int] = WEEKS, placed: bool = False) -> DataFrame:
        return self.finish(widen(weeks_df, self.keys, self.stored, windows, placed=placed), windows)

    def features(self, raw: DataFrame, snapshot: str, windows: Sequence[int] = WEEKS) -> DataFrame:
        # sums, minima and maxima of a ring of weeks equal those of its weeks; distinct counts
        # are defined per week
        weekly_only = any(m.agg == "ndistinct" for m in self.measures)
        placed = bool(self.extremes) or self.reduced
        if weekly_only or self.reduced:
            return self.from_weekly(self.weekly(raw, snapshot, max(windows), None if weekly_only else windows), windows, placed=placed)
        rings = self.weekly(raw, snapshot, max(windows), windows)
        return self.finish(widen_rings(rings, self.keys, self.stored, windows, placed=placed), windows)
