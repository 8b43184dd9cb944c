"""Registered queries (Spark) and their oracle SQL (DuckDB spelling).

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
registered tables (or data Spark derives from them).  Computed columns carry
the same aliases in both spellings.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def _load():
    # importing the modules registers their queries
    from aerolake.plans import q_build, q_core, q_measures, q_quality, q_io, q_stream  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(ORACLE)
