"""Data-quality checks.  Each returns the violating rows (or keys with their
row counts), never just a boolean; ``dq_run`` folds a suite into one verdict
table.

Scale notes: ``unique`` and ``relationships`` pre-aggregate the child keys
(partial aggregation on the map side) before any shuffle, so a hot key —
even a third of all rows — is one row per map task by the time it moves.
Single-column checks on the same table share one scan through conditional
aggregates in ``dq_run``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def _cols(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


# ------------------------------------------------------------------ row predicates
def not_null_violation(col: str) -> Column:
    return F.col(col).isNull()


def accepted_values_violation(col: str, values, case_sensitive: bool = True) -> Column:
    """NULL is not a violation (``col NOT IN (...)`` is unknown for NULL)."""
    if case_sensitive:
        return ~F.col(col).isin(list(values))
    return ~F.lower(F.col(col)).isin([v.lower() for v in values])


def accepted_range_violation(col: str, lo=None, hi=None, inclusive: bool = True) -> Column:
    """Outside [lo, hi]; NULL passes."""
    c = F.col(col)
    conds = []
    if lo is not None:
        conds.append(c < lo if inclusive else c <= lo)
    if hi is not None:
        conds.append(c > hi if inclusive else c >= hi)
    bad = reduce(lambda a, b: a | b, conds)
    return F.coalesce(bad, F.lit(False))


# ------------------------------------------------------------------ D1-D5, J4
def dq_unique(df: DataFrame, cols) -> DataFrame:
    """Keys that occur more than once (NULL keys skipped), with their count."""
    cols = _cols(cols)
    keyed = df.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))
    return keyed.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def dq_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(not_null_violation(col))


def dq_accepted_values(df: DataFrame, col: str, values, case_sensitive: bool = True) -> DataFrame:
    return df.filter(accepted_values_violation(col, values, case_sensitive))


def dq_accepted_range(df: DataFrame, col: str, lo=None, hi=None, inclusive: bool = True) -> DataFrame:
    return df.filter(accepted_range_violation(col, lo, hi, inclusive))


def _anti(child: DataFrame, col: str, parent: DataFrame, pcol: str) -> DataFrame:
    """Anti join on ``col`` without a hint: adaptive execution broadcasts the
    parent only when its measured size is under the threshold, else both sides
    shuffle and skewed child partitions are split."""
    keys = parent.select(F.col(pcol).alias(col)).filter(F.col(col).isNotNull())
    return child.filter(F.col(col).isNotNull()).join(keys, col, "left_anti")


def orphans(child: DataFrame, col: str, parent: DataFrame, pcol: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent (anti join)."""
    return _anti(child, col, parent, pcol)


def dq_relationships(child: DataFrame, col: str, parent: DataFrame, pcol: str) -> DataFrame:
    """Orphan keys with their child row count: child keys are aggregated
    first (map-side), so the anti join sees one row per distinct key."""
    keys = child.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n_rows"))
    return _anti(keys, col, parent, pcol)


# ------------------------------------------------------------------ D6 suite
@dataclass
class Check:
    model: str
    kind: str                      # unique | not_null | accepted_values | accepted_range | relationships
    column: str
    params: dict = field(default_factory=dict)


def _violation_count(kind: str, column: str, params: dict) -> Column:
    if kind == "not_null":
        cond = not_null_violation(column)
    elif kind == "accepted_values":
        cond = accepted_values_violation(column, params["values"], params.get("case_sensitive", True))
    elif kind == "accepted_range":
        cond = accepted_range_violation(column, params.get("lo"), params.get("hi"), params.get("inclusive", True))
    else:
        raise ValueError(kind)
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


def dq_run(models: dict[str, DataFrame], checks: list[Check]) -> DataFrame:
    """One verdict row per check: (model, check_name, column_name, violations, passed).

    Row-level checks of a model are evaluated together in one aggregate
    (one scan); ``unique`` counts duplicated keys; ``relationships`` counts
    orphan keys.  ``violations`` counts violating rows for row-level checks
    and violating keys for key checks.
    """
    spark = next(iter(models.values())).sparkSession
    parts: list[DataFrame] = []
    row_level = [c for c in checks if c.kind in ("not_null", "accepted_values", "accepted_range")]
    for model in dict.fromkeys(c.model for c in row_level):
        mine = [c for c in row_level if c.model == model]
        aggs = [_violation_count(c.kind, c.column, c.params).alias(f"c{i}") for i, c in enumerate(mine)]
        one = models[model].agg(*aggs)
        labels = F.array(*[F.struct(F.lit(c.kind).alias("check_name"), F.lit(c.column).alias("column_name"),
                                    F.coalesce(F.col(f"c{i}"), F.lit(0).cast("bigint")).alias("violations"))
                           for i, c in enumerate(mine)])
        parts.append(one.select(F.lit(model).alias("model"), F.inline(labels)))
    for c in checks:
        if c.kind == "unique":
            n = dq_unique(models[c.model], c.column).agg(F.count(F.lit(1)).cast("bigint").alias("violations"))
        elif c.kind == "relationships":
            p = c.params
            n = dq_relationships(models[c.model], c.column, models[p["to"]], p["field"]).agg(
                F.count(F.lit(1)).cast("bigint").alias("violations"))
        else:
            continue
        parts.append(n.select(F.lit(c.model).alias("model"), F.lit(c.kind).alias("check_name"),
                              F.lit(c.column).alias("column_name"), "violations"))
    if not parts:
        return spark.createDataFrame([], "model string, check_name string, column_name string, violations bigint, passed boolean")
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.withColumn("passed", F.col("violations") == 0)
