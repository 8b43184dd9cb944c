"""Keep the newest row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(col, descending: bool) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    # DESC puts NULLs last, ASC first: a NULL order value never wins.
    return c.desc_nulls_last() if descending else c.asc_nulls_last()


def dedup_latest(df: DataFrame, keys, order_by="inserted_at", tie_break=None,
                 descending: bool = True) -> DataFrame:
    """One row per ``keys``: the first by ``order_by`` (newest when
    ``descending``), ties broken by ``tie_break`` (also descending).

    NULL keys form one group, as in SQL ``PARTITION BY``.  Written as
    ``row_number() == 1`` so Catalyst plans a WindowGroupLimit on *both*
    sides of the shuffle: every map task first keeps only its newest row
    per key, so a hot key (even a third of all rows) ships one row per map
    partition, not all of them, before the final ranking.
    """
    keys = [keys] if isinstance(keys, (str, Column)) else list(keys)
    orders = [order_by] if isinstance(order_by, (str, Column)) else list(order_by)
    ties = [] if tie_break is None else ([tie_break] if isinstance(tie_break, (str, Column)) else list(tie_break))
    spec = [_order(c, descending) for c in orders] + [_order(c, True) for c in ties]
    w = Window.partitionBy(*keys).orderBy(*spec)
    rn = "__rn"
    return df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) == 1).drop(rn)
