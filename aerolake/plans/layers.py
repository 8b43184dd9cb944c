"""Layers (raw / silver / gold) and materialisation of models.

A model is materialised as a *view* (re-evaluated by its readers: silver) or
a *table* (full refresh: dimensions) under ``<root>/<layer>/<name>``.  A
model's own layer name is used verbatim, as the schema-name macro did.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aerolake.storage import path_exists, recover_table, replace_table

LAYERS = ("raw", "silver", "gold")


def layer_path(root: str, layer: str, name: str) -> str:
    layer = layer.strip()
    return f"{root.rstrip('/')}/{layer}/{name}"


def materialise(df: DataFrame, name: str, kind: str = "table", root: str | None = None,
                layer: str = "gold", partition_by=None) -> DataFrame:
    """``view``: temp view ``<layer>_<name>`` (nothing is computed).
    ``table``: replace the Parquet table at ``layer_path`` (written aside, then
    swapped) and return a DataFrame reading it back (a lineage cut that survives
    executor loss)."""
    spark = df.sparkSession
    if kind == "view":
        view = f"{layer}_{name}"
        df.createOrReplaceTempView(view)
        return spark.table(view)
    if kind != "table":
        raise ValueError(kind)
    if root is None:
        raise ValueError("a table needs a root folder on shared storage")
    by = [] if not partition_by else [partition_by] if isinstance(partition_by, str) else list(partition_by)
    return replace_table(df, layer_path(root, layer, name), by)


def stored_layer(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame | None:
    """The table of a model, None before its first build."""
    path = layer_path(root, layer, name)
    recover_table(spark, path)
    return spark.read.parquet(path) if path_exists(spark, path) else None
