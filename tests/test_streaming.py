import os

import pytest
from pyspark.sql import functions as F

from aerolake import snapshots
from aerolake.plans import build, fact, telemetry
from aerolake.session import fresh_path
from aerolake.sources import sinks
from aerolake.streaming import drain as S
from tests.fixtures import bronze_rows

SF = "/root/testdata/sf0.001"


def _local(p):
    return p.replace("file:", "")


def test_drain_twice_reads_nothing_new(spark):
    src = fresh_path(spark, "topic")
    sinks.publish(bronze_rows(spark).select(*sinks.STATE_VECTOR_NAMES), fmt="text", path=src)
    out, ckpt = fresh_path(spark, "out"), fresh_path(spark, "ckpt")
    first = S.drain(S.ingest_messages(S.open_stream(spark, "text", src)), ckpt, out)
    second = S.drain(S.ingest_messages(S.open_stream(spark, "text", src)), ckpt, out)
    assert first["input_rows"] == 6 and second["input_rows"] == 0
    assert spark.read.parquet(out).count() == 6


def test_stage_batch_is_idempotent_and_gate_skips_empty(spark):
    path = fresh_path(spark, "staged")
    df = spark.range(3)
    S.stage_batch(df, 0, path)
    S.stage_batch(df, 0, path)              # retry of batch 0
    S.stage_batch(spark.range(2), 1, path)
    assert spark.read.parquet(path).count() == 5
    stats = []
    S.staging_writer(path, stats=stats)(spark.range(0), 2)
    assert stats == [(2, False)] and spark.read.parquet(path).count() == 5
    jpath = fresh_path(spark, "staged-json")
    S.stage_batch(df, 0, jpath, fmt="json")
    S.stage_batch(df, 0, jpath, fmt="json")
    assert spark.read.json(jpath).count() == 3


def test_archive_moves_processed_files(spark):
    src, archive = fresh_path(spark, "src"), fresh_path(spark, "arch")
    sinks.publish(bronze_rows(spark).select(*sinks.STATE_VECTOR_NAMES).repartition(3), fmt="text", path=src)
    out, ckpt = fresh_path(spark, "out"), fresh_path(spark, "ckpt")
    stream = S.open_stream(spark, "text", src, options={"maxFilesPerTrigger": "1", "cleanSource": "archive",
                                                        "sourceArchiveDir": archive})
    S.drain(S.ingest_messages(stream), ckpt, out)
    archived = [f for _, _, fs in os.walk(_local(archive)) for f in fs if f.endswith(".txt")]
    assert spark.read.parquet(out).count() == 6 and len(archived) >= 1


def test_stream_fact_upsert_equals_batch_build(spark):
    bronze = telemetry.bronze(spark, SF)
    src = fresh_path(spark, "bronze")
    bronze.write.partitionBy("processing_date").parquet(src)
    fact_path, ckpt = fresh_path(spark, "fct"), fresh_path(spark, "ckpt")
    stream = S.open_stream(spark, "parquet", src, schema=bronze.schema, options={"maxFilesPerTrigger": "3"})
    S.drain(stream, ckpt, foreach_batch=S.fact_upsert_writer(spark, fact_path))
    got = sorted(map(tuple, snapshots.read(spark, fact_path).select(*fact.FACT_COLUMNS).collect()))
    want = sorted(map(tuple, build.gold_fact(spark, SF).collect()))
    assert got == want


def test_stream_dedup_and_hourly(spark):
    bronze = bronze_rows(spark).unionByName(bronze_rows(spark, inserted_at="2026-01-31 00:00:00"))
    src = fresh_path(spark, "b")
    bronze.write.parquet(src)
    from aerolake.functions.clean import typed_telemetry
    typed = lambda: typed_telemetry(S.open_stream(spark, "parquet", src, schema=bronze.schema))
    out, ckpt = fresh_path(spark, "d"), fresh_path(spark, "ckpt")
    writer = S.dedup_writer(out, ["aircraft_id", "position_timestamp"], "position_timestamp")
    S.drain(typed(), ckpt, foreach_batch=writer)
    assert snapshots.read(spark, out).count() == 6
    writer(typed_telemetry(bronze), 99)                     # everything again, however late: nothing new
    assert snapshots.read(spark, out).count() == 6
    out2, ckpt2 = fresh_path(spark, "h"), fresh_path(spark, "ckpt")
    hourly = S.hourly_writer(out2, "position_timestamp")
    S.drain(typed(), ckpt2, foreach_batch=hourly)
    hourly(typed_telemetry(bronze_rows(spark)), 7)
    hourly(typed_telemetry(bronze_rows(spark)), 7)          # a retried batch replaces itself
    hours = {str(r.window_start): (r.n_signals, r.approx_aircraft) for r in S.hourly_activity(spark, out2).collect()}
    assert hours["2026-01-17 21:00:00"] == (9, 3)
    assert sum(v[0] for v in hours.values()) == 18


def test_broken_messages_abort_or_are_set_aside(spark):
    good = bronze_rows(spark).select(*sinks.STATE_VECTOR_NAMES)
    src = fresh_path(spark, "topic")
    sinks.publish(good, fmt="text", path=src)
    spark.createDataFrame([('["cut", 1',), ('["short", 2]',)], "value string").coalesce(1).write.mode("append").text(src)
    with pytest.raises(Exception):
        S.drain(S.ingest_messages(S.open_stream(spark, "text", src)), fresh_path(spark, "c"), fresh_path(spark, "o"))
    ok, aside = fresh_path(spark, "ok"), fresh_path(spark, "aside")
    S.drain(S.open_stream(spark, "text", src), fresh_path(spark, "c"), foreach_batch=S.quarantine_writer(ok, aside))
    assert spark.read.parquet(ok).count() == 6
    assert {(r.value, r.problem) for r in spark.read.parquet(aside).collect()} == {
        ('["cut", 1', "malformed"), ('["short", 2]', "width")}


def test_progress_counts_every_batch(spark):
    src = fresh_path(spark, "many")
    spark.range(12).selectExpr("cast(id AS string) AS value").repartition(6).write.text(src)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        stream = S.open_stream(spark, "text", src, options={"maxFilesPerTrigger": "1"})
        done = S.drain(stream, fresh_path(spark, "c"), fresh_path(spark, "o"))
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert done == {"batches": 6, "input_rows": 12}


def test_stream_ties_end_as_in_a_batch(spark):
    """One load split over two micro-batches, the greater id first."""
    rows = bronze_rows(spark)
    low = rows.withColumn("velocity", F.lit(1.0))
    high = rows.withColumn("velocity", F.lit(2.0)).withColumn("id_surrogate", F.col("id_surrogate") + 1000)
    path = fresh_path(spark, "fct")
    writer = S.fact_upsert_writer(spark, path)
    writer(high, 0)
    writer(low, 1)
    assert {r.speed_kmh for r in snapshots.read(spark, path).collect()} == {2.0}
