"""Data-quality verdicts from state that is kept by partition.

A check of a large partitioned table need not read the table again: what each
partition adds to the verdict is kept as a few rows, and a run replaces those of the
partitions whose data changed.  The state names the write that it describes, so what
is stale follows from the table's manifest alone: a run without new data changes
nothing (and keeps a failing verdict), one that stopped half way is made up for.

count    violating rows of a row-level check, and keys repeated within a partition
         (for the key of the table, which lies in one partition by its definition)
ids      for another unique column of whole numbers: the number of rows and a bitmap
         for each bucket of 32,768 values.  Where the rows of a bucket over all
         partitions outnumber the bits of its united bitmaps, a value is repeated:
         only such buckets are read again, to count the repeated values
orphan   values without a parent, with their rows (parents only gain values, so no
         value becomes an orphan later; stored ones are held against the parents anew)
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake import snapshots
from aerolake.operators import quality as D
from aerolake.session import local_rows

STATE = ("model string, part string, write string, kind string, check_name string, column_name string, "
         "n bigint, key string, bucket bigint, bits binary")
ROW_LEVEL = ("not_null", "accepted_values", "accepted_range")
VERDICT = ["model", "check_name", "column_name", "violations"]


def part_name(partition_by, part: str) -> Column:
    """The partition folder of the values in the struct ``part``, for values that need
    no escaping in a path (dates, numbers, plain words)."""
    values = [F.col(part)[c].cast("string") for c in partition_by]
    return F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.coalesce(v, F.lit("__HIVE_DEFAULT_PARTITION__")))
                              for c, v in zip(partition_by, values)])


def _row_counts(frame: DataFrame, checks: list[D.Check], by: list[str]) -> DataFrame:
    aggs = [D._violation_count(c.kind, c.column, c.params).alias(f"c{i}") for i, c in enumerate(checks)]
    labels = F.array(*[F.struct(F.lit(c.kind).alias("check_name"), F.lit(c.column).alias("column_name"),
                                F.coalesce(F.col(f"c{i}"), F.lit(0)).cast("bigint").alias("n")) for i, c in enumerate(checks)])
    return frame.groupBy(*by).agg(*aggs).select(*by, F.lit("count").alias("kind"), F.inline(labels))


def _described(frame: DataFrame, key: str, checks: list[D.Check], parents: dict[str, DataFrame]) -> DataFrame:
    """State rows of ``frame``, which has a column ``part`` (never NULL)."""
    rows = [_row_counts(frame, [c for c in checks if c.kind in ROW_LEVEL], ["part"])]
    for c in checks:
        named = [F.lit(c.kind).alias("check_name"), F.lit(c.column).alias("column_name")]
        if c.kind == "unique" and c.column == key:
            repeated = D.dq_unique(frame, ["part", key]).groupBy("part").agg(F.count(F.lit(1)).alias("n"))
            rows.append(repeated.select("part", F.lit("count").alias("kind"), *named, "n"))
        elif c.kind == "unique":
            value = F.col(c.column).cast("bigint")
            # these are sorted to be aggregated: by the number first
            per = frame.where(F.col(c.column).isNotNull()).groupBy(F.bitmap_bucket_number(value).alias("bucket"), "part").agg(
                F.count(F.lit(1)).alias("n"), F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bits"))
            rows.append(per.select("part", F.lit("ids").alias("kind"), *named, "n", "bucket", "bits"))
        elif c.kind == "relationships":
            values = frame.where(F.col(c.column).isNotNull()).groupBy("part", c.column).agg(F.count(F.lit(1)).alias("n"))
            bad = D.orphans(values, c.column, parents[c.params["to"]], c.params["field"])
            rows.append(bad.select("part", F.lit("orphan").alias("kind"), *named, "n", F.col(c.column).cast("string").alias("key")))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)


def refresh(spark: SparkSession, state_path: str, model: str, table_path: str, key: str, checks: list[D.Check],
            parents: dict[str, DataFrame], aside: dict[str, DataFrame | None] | None = None, everything: bool = False) -> list[str]:
    """Bring the state of ``model`` up to date with the snapshot table at
    ``table_path``; returns the partitions that were read for it.

    ``checks``: those of the suite for this model; ``aside``: further rows (those
    that had no key), by a name of their own, for the row-level checks (None: there
    are none under this name any more)."""
    snap = snapshots.snapshot(spark, table_path)
    known: dict[str, str] = {}
    if snapshots.exists(spark, state_path):
        kept = snapshots.read(spark, state_path).where(F.col("model") == model).where("kind = 'seen' OR write = 'aside'")
        known = {r["part"]: r["write"] for r in kept.select("part", "write").collect()}
    folders = snap.folders if snap else {}
    stale = [p for p, w in folders.items() if everything or known.get(p) != w]
    found = []
    if stale:
        # grouped by the values; what is left then gets the names
        frame = snapshots.read_snapshot(spark, snap, stale).withColumn("part", F.struct(*snap.partition_by))
        named = _described(frame, key, checks, parents).withColumn("part", part_name(snap.partition_by, "part"))
        writes = local_rows(spark, [(p, folders[p]) for p in stale], "part string, write string")
        # a partition always has a row, so that it is known to be described
        described = named.unionByName(
            writes.select("part", F.lit("seen").alias("kind")), allowMissingColumns=True)
        found.append(described.join(writes, "part"))
    aside = aside or {}
    gone = [p for p, w in known.items() if (aside[p] is None if p in aside else p not in folders and w != "aside")]
    for name, rows in aside.items():
        if rows is None:
            continue
        counts = _row_counts(rows, [c for c in checks if c.kind in ROW_LEVEL], [])
        found.append(counts.select(F.lit(name).alias("part"), F.lit("aside").alias("write"), *counts.columns))
    if found or gone:
        full = local_rows(spark, [], STATE)
        state = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [full, *found]).withColumn("model", F.lit(model))
        parts = snapshots.partition_names(spark, local_rows(spark, [(model, p) for p in gone], "model string, part string"),
                                          ["model", "part"]) if gone else []
        snapshots.replace_partitions(spark, state_path, state.select(*full.columns), ["model", "part"], drop=parts)
    return stale


def repeated_values(spark: SparkSession, state: DataFrame, tables: dict[str, str]) -> dict[tuple[str, str], int]:
    """(model, column) -> repeated values, for the ``ids`` state; reads the table only
    in buckets whose rows outnumber their distinct values."""
    ids = state.where("kind = 'ids'")
    suspects = ids.groupBy("model", "column_name", "bucket").agg(
        F.sum("n").alias("n"), F.bitmap_count(F.bitmap_or_agg("bits")).alias("distinct")).where(
        F.col("n") > F.col("distinct")).select("model", "column_name", "bucket").persist()     # few, of all bitmaps
    where = ids.join(suspects, ["model", "column_name", "bucket"], "left_semi").groupBy("model", "column_name").agg(
        F.collect_set("part").alias("parts")).collect()            # names of partition folders
    found = {}
    for r in where:
        column = F.col(r["column_name"]).cast("bigint")
        mine = suspects.where((F.col("model") == r["model"]) & (F.col("column_name") == r["column_name"])).select("bucket")
        rows = snapshots.read(spark, tables[r["model"]], partitions=r["parts"]).where(column.isNotNull()).select(
            column.alias("value"), F.bitmap_bucket_number(column).alias("bucket")).join(mine, "bucket", "left_semi")
        found[(r["model"], r["column_name"])] = D.dq_unique(rows, "value").count()
    suspects.unpersist()
    return found


def verdict(spark: SparkSession, state_path: str, tables: dict[str, str], checks: list[D.Check],
            parents: dict[str, DataFrame]) -> DataFrame:
    """(model, check_name, column_name, violations, passed) of ``checks`` from the
    state of the models in ``tables`` (model -> path of its snapshot table)."""
    mine = [c for c in checks if c.model in tables]
    state = snapshots.read(spark, state_path) if snapshots.exists(spark, state_path) else local_rows(spark, [], STATE)
    rows = [state.where("kind = 'count'").select("model", "check_name", "column_name", F.col("n").alias("violations"))]
    for c in mine:
        if c.kind == "relationships":
            stored = state.where((F.col("kind") == "orphan") & (F.col("model") == c.model) & (F.col("column_name") == c.column))
            still = D.orphans(stored.select("key").distinct(), "key", parents[c.params["to"]], c.params["field"])
            rows.append(still.select(F.lit(c.model).alias("model"), F.lit(c.kind).alias("check_name"),
                                     F.lit(c.column).alias("column_name"), F.lit(1).cast("bigint").alias("violations")))
    repeated = [(m, "unique", c, n) for (m, c), n in repeated_values(spark, state, tables).items()]
    # a row of nothing for each check, so that none is missing
    base = [(c.model, c.kind, c.column, 0) for c in mine]
    rows.append(local_rows(spark, base + repeated, "model string, check_name string, column_name string, violations bigint"))
    out = reduce(lambda a, b: a.unionByName(b), rows).groupBy("model", "check_name", "column_name").agg(
        F.sum("violations").cast("bigint").alias("violations"))
    return out.withColumn("passed", F.col("violations") == 0)
