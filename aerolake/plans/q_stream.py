"""Registered queries: streaming drains and refreshes (T1-T7).

Each replays data derived from the registered tables through a file source
under a fresh folder of the shared checkpoint dir, drains it with
``availableNow`` and returns what the sink holds afterwards.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolake import constants as K
from aerolake import snapshots, storage
from aerolake.functions.clean import instant_to_ntz, typed_telemetry
from aerolake.operators.geo import near_any
from aerolake.plans import telemetry
from aerolake.plans.fact import FACT_COLUMNS
from aerolake.plans.oracle import sql
from aerolake.plans.registry import register
from aerolake.plans.telemetry_vectors import SV_SQL_COLS, state_vectors
from aerolake.session import fresh_path
from aerolake.sources import sinks
from aerolake.streaming import drain as S
from aerolake.streaming.archive import archive_committed, noting_files, with_source_file
from aerolake.streaming.dedup_index import indexed_dedup_writer, read_keys

SV_SQL = sql(f"SELECT {SV_SQL_COLS} FROM telemetry", "telemetry")


def _bronze_files(spark, sf_dir):
    """Bronze rows landed as Parquet, one folder per load date."""
    bronze = telemetry.bronze(spark, sf_dir)
    path = fresh_path(spark, "bronze")
    sinks.cluster_for_partitioned_write(bronze, "processing_date").write.partitionBy("processing_date").parquet(path)
    return path, bronze.schema, bronze.columns


def _message_files(spark, sf_dir, n_files: int = 8):
    path = fresh_path(spark, "topic")
    sinks.publish(state_vectors(telemetry.telemetry(spark, sf_dir)).repartition(n_files), fmt="text", path=path)
    return path


# ------------------------------------------------------------------ T1
@register("drain_available", SV_SQL)
def q_drain_available(spark, sf_dir):
    src = _message_files(spark, sf_dir)
    out, ckpt = fresh_path(spark, "drained"), fresh_path(spark, "ckpt")
    stream = S.open_stream(spark, "text", src, options={"maxFilesPerTrigger": "2"})
    S.drain(S.ingest_messages(stream), ckpt, out)
    S.drain(S.ingest_messages(S.open_stream(spark, "text", src)), ckpt, out)   # rerun: nothing new
    return spark.read.parquet(out)


# ------------------------------------------------------------------ T2
@register("stage_batches", sql("SELECT * FROM bronze", "bronze"))
def q_stage_batches(spark, sf_dir):
    src, schema, cols = _bronze_files(spark, sf_dir)
    out, ckpt = fresh_path(spark, "staged"), fresh_path(spark, "ckpt")
    stream = S.open_stream(spark, "parquet", src, schema=schema, options={"maxFilesPerTrigger": "4"})
    S.drain(stream, ckpt, foreach_batch=S.staging_writer(out))
    return spark.read.parquet(out).select(*cols)


# ------------------------------------------------------------------ T3
def _near_sql() -> str:
    terms = " OR ".join(
        f"(abs(latitude - CAST({la!r} AS DOUBLE)) < {K.PRODUCER_MAX_DEG} AND "
        f"abs(longitude - CAST({lo!r} AS DOUBLE)) < {K.PRODUCER_MAX_DEG})"
        for la, lo in K.PRODUCER_CENTRES.values())
    return f"SELECT {SV_SQL_COLS} FROM telemetry WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND ({terms})"


@register("empty_batch_gate", sql(_near_sql(), "telemetry"))
def q_empty_batch_gate(spark, sf_dir):
    """Files of near and of far positions, one a micro-batch: those of far ones leave nothing to stage."""
    vectors = state_vectors(telemetry.telemetry(spark, sf_dir))
    src = fresh_path(spark, "topic")
    near = near_any(vectors)
    for part in (near, vectors.exceptAll(near)):
        messages = sinks.to_messages(part.repartition(2))
        messages.write.mode("append").text(src)
    out, ckpt, staged = fresh_path(spark, "gated"), fresh_path(spark, "ckpt"), []
    stream = S.ingest_messages(S.open_stream(spark, "text", src, options={"maxFilesPerTrigger": "1"}))
    S.drain(stream, ckpt, foreach_batch=S.staging_writer(out, transform=near_any, stats=staged))
    if all(done for _, done in staged):
        raise AssertionError("no empty micro-batch was met")
    return spark.read.parquet(out).drop("batch_id")


# ------------------------------------------------------------------ T4
@register("archive_source", SV_SQL)
def q_archive_source(spark, sf_dir):
    src = _message_files(spark, sf_dir)
    archive = fresh_path(spark, "archive")
    out, ckpt = fresh_path(spark, "drained"), fresh_path(spark, "ckpt")
    stream = S.open_stream(spark, "text", src, options={
        "maxFilesPerTrigger": "2", "cleanSource": "archive", "sourceArchiveDir": archive})
    S.drain(S.ingest_messages(stream), ckpt, out)
    # the drained files lie in the archive, but for those of the last batch, which
    # stay until the next: together they are every message
    files = spark.read.option("recursiveFileLookup", "true")
    messages = files.text(archive).union(files.text(src))
    return S.ingest_messages(messages)


@register("archive_committed", SV_SQL)
def q_archive_committed(spark, sf_dir):
    """Every drained file lies in the archive, the last batch's too, and none in the
    source: the messages are read from the archive alone."""
    src = _message_files(spark, sf_dir)
    archive, ledger = fresh_path(spark, "archive"), fresh_path(spark, "archive-ledger")
    out, ckpt = fresh_path(spark, "staged"), fresh_path(spark, "ckpt")
    stream = with_source_file(S.open_stream(spark, "text", src, options={"maxFilesPerTrigger": "3"}))
    S.drain(stream, ckpt, foreach_batch=noting_files(ledger, S.staging_writer(out, transform=S.ingest_messages)))
    archive_committed(spark, ledger, ckpt, archive)
    if left := [n for n in storage.file_names(spark, src) if n.startswith("part-")]:
        raise AssertionError(f"{len(left)} drained files are still in the source")
    return S.ingest_messages(spark.read.text(archive).select("value"))


# ------------------------------------------------------------------ T5
@register("stream_fact_upsert", sql("SELECT * FROM fct", "fct"))
def q_stream_fact_upsert(spark, sf_dir):
    src, schema, _ = _bronze_files(spark, sf_dir)
    fact_path, ckpt = fresh_path(spark, "fct_flights"), fresh_path(spark, "ckpt")
    stream = S.open_stream(spark, "parquet", src, schema=schema, options={"maxFilesPerTrigger": "8"})
    S.drain(stream, ckpt, foreach_batch=S.fact_upsert_writer(spark, fact_path))
    return snapshots.read(spark, fact_path).select(*FACT_COLUMNS)


# ------------------------------------------------------------------ T1 with broken messages
_BROKEN = "CASE WHEN event_id % 41 = 0 THEN 'malformed' WHEN event_id % 31 = 0 THEN 'width' END"


@register("stream_quarantine", sql(
    f"SELECT problem, count(*) AS n FROM (SELECT {_BROKEN} AS problem FROM telemetry) GROUP BY 1", "telemetry"))
def q_stream_quarantine(spark, sf_dir):
    src = broken_message_files(spark, sf_dir)
    good, bad, ckpt = fresh_path(spark, "drained"), fresh_path(spark, "quarantine"), fresh_path(spark, "ckpt")
    stream = S.open_stream(spark, "text", src, options={"maxFilesPerTrigger": "3"})
    S.drain(stream, ckpt, foreach_batch=S.quarantine_writer(good, bad))
    return spark.read.parquet(bad).groupBy("problem").agg(F.count("*").alias("n")).union(
        spark.read.parquet(good).agg(F.lit(None).cast("string"), F.count("*")))


def broken_message_files(spark, sf_dir, n_files: int = 8) -> str:
    """State-vector messages, some cut off and some one value short."""
    tel = telemetry.telemetry(spark, sf_dir)
    text = sinks.json_array_text(sinks.STATE_VECTOR_NAMES)
    short = sinks.json_array_text(sinks.STATE_VECTOR_NAMES[:-1])
    path = fresh_path(spark, "broken-topic")
    rows = state_vectors(tel, keep=["event_id"])
    rows.select(F.when(F.expr("event_id % 41 = 0"), F.substr(text, F.lit(1), F.length(text) - 5))
                .when(F.expr("event_id % 31 = 0"), short).otherwise(text).alias("value")).repartition(n_files).write.text(path)
    return path


# ------------------------------------------------------------------ T6
@register("stream_dedup", sql("SELECT DISTINCT aircraft_id, position_timestamp FROM typed", "typed"))
def q_stream_dedup(spark, sf_dir):
    """Several micro-batches, the newer half of the loads first, so that event
    times go backwards."""
    bronze = telemetry.bronze(spark, sf_dir)
    middle = bronze.agg(F.date_add(F.min("processing_date"), F.floor(F.datediff(
        F.max("processing_date"), F.min("processing_date")) / 2).cast("int"))).first()[0]
    out, ckpt = fresh_path(spark, "dedup"), fresh_path(spark, "ckpt")
    for half, part in enumerate((F.col("processing_date") > F.lit(middle), F.col("processing_date") <= F.lit(middle))):
        src = fresh_path(spark, "bronze")
        sinks.cluster_for_partitioned_write(bronze.where(part), "processing_date").write.partitionBy("processing_date").parquet(src)
        typed = typed_telemetry(S.open_stream(spark, "parquet", src, schema=bronze.schema, options={"maxFilesPerTrigger": "8"}))
        S.drain(typed, f"{ckpt}-{half}", foreach_batch=S.dedup_writer(out, ["aircraft_id", "position_timestamp"], "position_timestamp"))
    return snapshots.read(spark, out).select("aircraft_id", "position_timestamp")


@register("stream_dedup_indexed", sql("SELECT DISTINCT aircraft_id, position_timestamp FROM typed", "typed"))
def q_stream_dedup_indexed(spark, sf_dir):
    """The even events first, the odd ones (which share most keys with them) after, in
    micro-batches that probe the index before they read a stored key."""
    bronze = telemetry.bronze(spark, sf_dir)
    out, ckpt = fresh_path(spark, "dedup-indexed"), fresh_path(spark, "ckpt")
    for half in (0, 1):
        src = fresh_path(spark, "bronze")
        bronze.where(f"event_id % 2 = {half}").repartition(2).write.parquet(src)
        typed = typed_telemetry(S.open_stream(spark, "parquet", src, schema=bronze.schema, options={"maxFilesPerTrigger": "1"}))
        writer = indexed_dedup_writer(out, ["aircraft_id", "position_timestamp"], "position_timestamp")
        # batch numbers go on where the first half's stopped
        S.drain(typed, f"{ckpt}-{half}", foreach_batch=lambda df, n, half=half, writer=writer: writer(df, 1000 * half + n))
    return read_keys(spark, out).select("aircraft_id", "position_timestamp")


# ------------------------------------------------------------------ T7
def _hourly(spark, sf_dir):
    src, schema, _ = _bronze_files(spark, sf_dir)
    out, ckpt = fresh_path(spark, "hourly"), fresh_path(spark, "ckpt")
    typed = typed_telemetry(S.open_stream(spark, "parquet", src, schema=schema, options={"maxFilesPerTrigger": "8"}))
    S.drain(typed, ckpt, foreach_batch=S.hourly_writer(out, "position_timestamp"))
    return S.hourly_activity(spark, out)


@register("stream_hourly_signals", sql(
    "SELECT date_trunc('hour', position_timestamp) AS window_start, CAST(count(*) AS BIGINT) AS n_signals FROM typed GROUP BY 1",
    "typed"))
def q_stream_hourly_signals(spark, sf_dir):
    return _hourly(spark, sf_dir).select("window_start", "n_signals")


@register("stream_hourly_active", sql(
    "SELECT date_trunc('hour', position_timestamp) AS window_start, count(DISTINCT aircraft_id) AS active_aircraft, "
    "true AS estimate_is_close FROM typed GROUP BY 1", "typed"))
def q_stream_hourly_active(spark, sf_dir):
    """Exact from the stream's own bitmaps, next to the stream's estimate (within 5 % or
    one aircraft)."""
    src, schema, _ = _bronze_files(spark, sf_dir)
    out, names, ckpt = fresh_path(spark, "hourly-bitmaps"), fresh_path(spark, "dictionary"), fresh_path(spark, "ckpt")
    typed = typed_telemetry(S.open_stream(spark, "parquet", src, schema=schema, options={"maxFilesPerTrigger": "8"}))
    S.drain(typed, ckpt, foreach_batch=S.hourly_bitmap_writer(out, names, "position_timestamp"))
    gap = F.abs(F.col("approx_aircraft") - F.col("active_aircraft"))
    return S.hourly_aircraft(spark, out).join(_hourly(spark, sf_dir), "window_start").select(
        "window_start", "active_aircraft", (gap <= F.greatest(F.lit(1.0), F.col("active_aircraft") * 0.05)).alias("estimate_is_close"))
