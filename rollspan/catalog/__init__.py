"""Registered queries: each operator and family over the test tables, with its SQL oracle."""

from rollspan.catalog.registry import oracle_sql, queries
from rollspan.catalog import features, frames, monthly_families, quality, scoring, selection, weekly_families  # noqa: F401

__all__ = ["oracle_sql", "queries"]
