"""Logical-name access to tables (the registered test tables and layer paths)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the registered Parquet tables under ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def source(spark: SparkSession, registry: dict, layer: str, name: str) -> DataFrame:
    """Resolve a declared source ``(layer, name)`` to a DataFrame.

    ``registry`` maps ``"layer.name"`` to a path, a catalog table name or a
    DataFrame; a missing entry falls back to the catalog table ``layer.name``.
    """
    target = registry.get(f"{layer}.{name}")
    if isinstance(target, DataFrame):
        return target
    if target is None:
        return spark.table(f"{layer}.{name}")
    if "/" in target or ":" in target:
        return spark.read.parquet(target)
    return spark.table(target)
