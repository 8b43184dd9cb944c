"""Plan properties the design relies on (checked on executed plans)."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from aerolake.session import fresh_path
from aerolake.sources import ingest, sinks

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_prunes_columns_and_limits_before_shuffle(spark):
    df = entry.entry(spark)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan
    assert "Partial" in plan and "WindowGroupLimit" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan   # no Python UDF
    assert "ExistingRDD" not in plan                                          # no Python-built relation


def test_partition_reads_list_one_folder(spark):
    path = fresh_path(spark, "pp")
    spark.range(1000).select((F.col("id") % 10).alias("d"), "id").write.partitionBy("d").parquet(path)
    df = ingest.scan_partition(spark, path, "d", 3)
    assert df.count() == 100 and df.columns == ["id", "d"]
    assert all("/d=3/" in f for f in df.inputFiles())
    assert ingest.scan_partition(spark, path, "d", 77).count() == 0


def test_star_reads_pruned_silver(spark):
    df = entry.queries()["rollup_geo"](spark, SF)
    plan = _plan(df)
    assert "Window" not in plan                 # silver is read back, not deduplicated again
    scans = [ln for ln in plan.splitlines() if "ReadSchema" in ln]
    assert scans and all("callsign" not in ln for ln in scans)
    sliced = _plan(entry.queries()["slice_star"](spark, SF))
    assert "PushedFilters: [" in sliced


def test_partitioned_write_has_few_files(spark):
    """About one file for a small date, several for a hot one."""
    import os
    path = fresh_path(spark, "files")
    df = spark.range(200_000, numPartitions=16).select(
        "id", F.sha2(F.col("id").cast("string"), 256).alias("pad"),
        F.when(F.col("id") < 180_000, 0).otherwise(F.col("id") % 30).alias("d"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        sinks.write_partitions(df, path, "d")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {d: len([f for f in os.listdir(os.path.join(path.replace("file:", ""), d)) if f.endswith(".parquet")])
             for d in os.listdir(path.replace("file:", "")) if d.startswith("d=")}
    assert files.pop("d=0") > 1 and len(files) == 29 and sum(files.values()) <= 2 * len(files)


def test_near_any_pushes_a_range_superset_to_parquet(spark):
    from aerolake.operators.geo import near_any
    path = fresh_path(spark, "pts")
    spark.range(2000).select((F.lit(-24.0) + F.col("id") / 1000).alias("latitude"),
                             (F.lit(-47.0) + F.col("id") / 2000).alias("longitude")).write.parquet(path)
    df = near_any(spark.read.parquet(path))
    plan = _plan(df)
    pushed = [ln.split("PushedFilters:")[1] for ln in plan.splitlines() if "PushedFilters" in ln][0]
    assert "Or(" in pushed and "GreaterThanOrEqual(latitude" in pushed
    exact = spark.read.parquet(path).filter(
        ((F.abs(F.col("latitude") + 23.43) < 0.2) & (F.abs(F.col("longitude") + 46.47) < 0.2))
        | ((F.abs(F.col("latitude") + 23.63) < 0.2) & (F.abs(F.col("longitude") + 46.65) < 0.2))
        | ((F.abs(F.col("latitude") + 23.01) < 0.2) & (F.abs(F.col("longitude") + 47.13) < 0.2)))
    assert df.count() == exact.count() > 0
