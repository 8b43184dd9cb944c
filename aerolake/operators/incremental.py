"""Incremental build: high-water-mark filter and key-based upsert.

No lake table format is assumed (plain Parquet on any Hadoop FS): the upsert merges
the partitions that a batch touches and commits them in a manifest
(``aerolake.snapshots``).  Which loads are new is told by a ledger
(``aerolake.loads``); the mark serves bronze that has none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.snapshots import merge_frames, upsert

__all__ = ["high_water_mark", "merge_frames", "new_rows", "newer_than", "upsert"]


def high_water_mark(target: DataFrame | None, target_col: str = "ingestion_timestamp") -> str | None:
    """The target's high-water mark as text (one aggregate; a single scalar
    reaches the driver, as text so no time-zone conversion happens there).
    ``None`` for no target or an empty one (a first load)."""
    if target is None:
        return None
    return target.agg(F.max(target_col).cast("string").alias("m")).first()["m"]


def newer_than(df: DataFrame, ts_col: str, mark: str | None) -> DataFrame:
    """Rows with ``ts_col`` strictly above ``mark`` (all rows for ``None``)."""
    if mark is None:
        return df
    return df.filter(F.col(ts_col) > F.lit(mark).cast(df.schema[ts_col].dataType))


def new_rows(df: DataFrame, ts_col: str, target: DataFrame | None = None,
             target_col: str = "ingestion_timestamp") -> DataFrame:
    """Rows strictly newer than the target's high-water mark.

    The mark becomes a literal in the filter (a scalar subquery would be
    planned once per reference and, in ``mark IS NULL OR ts > mark``,
    aggregate the target twice).  No target, or an empty target (NULL mark),
    is a first load: all rows qualify.
    """
    return newer_than(df, ts_col, high_water_mark(target, target_col))
