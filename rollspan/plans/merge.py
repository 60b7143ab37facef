"""The wide model table: feature dictionary projections merged per subscriber."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from rollspan.functions.text import valid_id
from rollspan.operators.fill import fill, project
from rollspan.operators.joins import GuardedMerge, enrich, guarded_outer_merge
from rollspan.sources.tables import store_by_key


def picked(tables: Mapping[str, DataFrame], features: Mapping[str, Mapping[str, Sequence[str]]], key: str = "msisdn",
           only_valid: bool = True) -> dict[str, DataFrame]:
    """The features of each table that the dictionary names, for valid subscribers only unless told otherwise."""
    out = {name: project(tables[name], wanted, [key]) for name, wanted in features.items()}
    return {name: df.where(valid_id(key)) for name, df in out.items()} if only_valid else out


def model_table(tables: Mapping[str, DataFrame], features: Mapping[str, Mapping[str, Sequence[str]]],
                key: str = "msisdn", only_valid: bool = True, ids: DataFrame | None = None) -> GuardedMerge:
    """Selected features of every table, merged on the subscriber with row guards.

    Projection and id filter sit below the joins, so the scans read only what the
    dictionary names.
    """
    return guarded_outer_merge(picked(tables, features, key, only_valid), [key], ids)


def with_device(tac_of: DataFrame, device: DataFrame) -> DataFrame:
    """Device features of a subscriber through its device type code."""
    return enrich(tac_of, device, ["tac"]).drop("tac")


def filled_merge(tables: Mapping[str, DataFrame], features: Mapping[str, Mapping[str, Sequence[str]]], key: str = "msisdn",
                 strategy: str = "items", only_valid: bool = True, ids: DataFrame | None = None) -> GuardedMerge:
    """:func:`model_table` with the gaps filled, as scoring reads it."""
    merged = model_table(tables, features, key, only_valid, ids)
    merged.frame = fill(merged.frame, strategy)
    return merged


def active_only(df: DataFrame, flag: str = "sub_activated_flag") -> DataFrame:
    return df.where(F.col(flag) == 1).drop(flag)


def store_features(tables: Mapping[str, DataFrame], features: Mapping[str, Mapping[str, Sequence[str]]], folder: str, prefix: str,
                   buckets: int, key: str = "msisdn") -> dict[str, DataFrame]:
    """Store the snapshot of each table by subscriber, once; merges of any choice of them read it without a shuffle."""
    return {name: store_by_key(df, f"{prefix}_{name}", f"{folder}/{name}", [key], buckets)
            for name, df in picked(tables, features, key).items()}
