"""Structured Streaming: bounded drains and incremental refresh.

The workflow polls a topic, drains what is there and stops.  Here that is a
streaming query run with ``trigger(availableNow=True)``: it processes every
record available at start (in as many micro-batches as the source's rate
limits allow) and stops; the checkpoint remembers the offsets, so the next
run reads only new records and a crash re-reads, never loses, a batch.
Sources are parameters: ``kafka`` on a cluster (``startingOffsets=earliest``),
file sources (json/text/parquet) here.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from aerolake.functions.clean import instant_to_ntz, ntz_to_instant
from aerolake.operators.bitmaps import batch_dictionary, distinct_counts, group_bitmaps
from aerolake.operators.incremental import upsert
from aerolake.plans import dims
from aerolake.plans.fact import fct_flights
from aerolake.plans.staging import stg_flights
from aerolake.sources.ingest import BAD_WIDTH, MALFORMED, typed_projection, width_violation


def open_stream(spark: SparkSession, fmt: str, path: str | None = None, schema=None,
                options: dict | None = None) -> DataFrame:
    """A streaming DataFrame over ``fmt`` (kafka: ``value`` cast to string and,
    unless given, ``startingOffsets=earliest`` so a first drain reads the
    whole topic; later drains resume from the checkpointed offsets)."""
    options = dict(options or {})
    if fmt == "kafka":
        options.setdefault("startingOffsets", "earliest")
    r = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        r = r.schema(schema)
    df = r.load(path) if path else r.load()
    if fmt == "kafka":
        df = df.select(F.col("value").cast("string").alias("value"), "topic", "partition", "offset", "timestamp")
    return df


class _Progress(StreamingQueryListener):
    """Sums the progress of one run; a query itself keeps only its last updates."""

    def __init__(self):
        self.counts: dict[str, list[int]] = {}
        self.ended: dict[str, threading.Event] = {}

    def event(self, run: str) -> threading.Event:
        return self.ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        if p.numInputRows > 0:
            c = self.counts.setdefault(str(p.runId), [0, 0])
            c[0] += 1
            c[1] += p.numInputRows

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.event(str(event.runId)).set()


def drain(stream: DataFrame, checkpoint: str, sink_path: str | None = None, fmt: str = "parquet",
          foreach_batch: Callable | None = None, output_mode: str = "append",
          partition_by=None) -> dict:
    """Run a streaming query until everything available now is processed.

    Either a file sink (exactly-once through the sink's metadata log) or a
    ``foreach_batch(df, batch_id)`` function.  Returns the progress numbers
    (batches, input rows) of this run, however many batches it had."""
    w = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True)
    progress, streams = _Progress(), stream.sparkSession.streams
    streams.addListener(progress)
    try:
        if foreach_batch is not None:
            q = w.foreachBatch(foreach_batch).start()
        else:
            w = w.format(fmt)
            if partition_by:
                w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
            q = w.start(sink_path)
        q.awaitTermination()
        if q.exception() is not None:
            raise q.exception()
        progress.event(str(q.runId)).wait(60)       # events arrive in order: the last one ends the sums
    finally:
        streams.removeListener(progress)
    batches, rows = progress.counts.get(str(q.runId), (0, 0))
    return {"batches": batches, "input_rows": rows}


# ------------------------------------------------------------------ T2 / T3
def gate(df: DataFrame, fn: Callable[[DataFrame], None]) -> bool:
    """Skip downstream work for an empty batch (reads at most one row)."""
    if df.isEmpty():
        return False
    fn(df)
    return True


def stage_batch(df: DataFrame, batch_id: int, path: str, batch_col: str = "batch_id",
                fmt: str = "parquet") -> None:
    """Write one micro-batch under ``batch_id=<id>`` (``fmt`` parquet or
    json); a retried batch replaces its own folder (idempotent), other
    batches are untouched."""
    (df.withColumn(batch_col, F.lit(batch_id).cast("long"))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(batch_col).format(fmt).save(path))


def staging_writer(path: str, transform: Callable[[DataFrame], DataFrame] | None = None,
                   stats: list | None = None, fmt: str = "parquet") -> Callable:
    def fn(df: DataFrame, batch_id: int):
        out = transform(df) if transform else df
        done = gate(out, lambda d: stage_batch(d, batch_id, path, fmt=fmt))
        if stats is not None:
            stats.append((batch_id, done))
    return fn


# ------------------------------------------------------------------ ingest path per batch
def parsed_messages(df: DataFrame, value_col: str = "value") -> DataFrame:
    """(value, row, problem) of every message; ``problem`` is NULL for a good one."""
    row = F.from_json(F.col(value_col), "array<string>")
    return df.select(F.col(value_col).alias("value"), row.alias("row")).withColumn(
        "problem", F.when(F.col("row").isNull(), MALFORMED).when(width_violation("row"), BAD_WIDTH))


def ingest_messages(stream: DataFrame, value_col: str = "value") -> DataFrame:
    """Message text -> positional row -> contract -> typed state vectors; a broken
    message aborts the batch (``quarantine_writer`` sets it aside instead)."""
    problem = F.concat(F.lit("CONTRACT BROKEN: "), "problem", F.lit(" message "), F.coalesce("value", F.lit("NULL")))
    rows = parsed_messages(stream, value_col).withColumn(
        "row", F.when(F.col("problem").isNull(), F.col("row")).otherwise(F.raise_error(problem)))
    return typed_projection(rows)


def quarantine_writer(path: str, quarantine_path: str, value_col: str = "value") -> Callable:
    """foreachBatch body: typed rows staged under ``path``, broken messages under
    ``quarantine_path``, each by batch id (a retried batch replaces its own)."""
    def fn(df: DataFrame, batch_id: int):
        parsed = parsed_messages(df, value_col)
        gate(typed_projection(parsed.where("problem is null")), lambda d: stage_batch(d, batch_id, path))
        gate(parsed.where("problem is not null"), lambda d: stage_batch(d, batch_id, quarantine_path))
    return fn


# ------------------------------------------------------------------ T5
def fact_upsert_writer(spark: SparkSession, fact_path: str, airports: DataFrame | None = None,
                       partition_by=("flight_date",)) -> Callable:
    """foreachBatch body: bronze rows -> silver (dedup in batch) -> fact ->
    upsert by ``flight_pk``.  The newest load wins, then the greatest surrogate
    id, as in a batch build, so batch order does not matter; the fact keeps the
    id for that.  Rows without a key are quarantined under the batch's id.  For a
    frequent trigger pass ``partition_by=("flight_date", "hour_24")``: each batch
    then rewrites the hours it touches instead of the whole day."""
    airports = airports if airports is not None else dims.dim_airports(spark)

    def fn(df: DataFrame, batch_id: int):
        # an empty batch stages nothing and returns before touching the fact
        f = fct_flights(stg_flights(df), airports, n_airports=dims.N_AIRPORTS, keep=["id_surrogate"])
        upsert(df.sparkSession, fact_path, f, "flight_pk", list(partition_by),
               order_by=["ingestion_timestamp", "id_surrogate"], on_null_key="quarantine", run_id=f"batch-{batch_id}")
    return fn


# ------------------------------------------------------------------ T6 / T7
def dedup_writer(path: str, keys, ts_col: str) -> Callable:
    """foreachBatch body: the distinct ``keys`` seen so far, as a table partitioned
    by day.  An upsert of the batch's keys, so late rows are never dropped, no
    state grows, and a batch reads and rewrites the days it touches only."""
    keys = [keys] if isinstance(keys, str) else list(keys)

    def fn(df: DataFrame, batch_id: int):
        day = F.to_date(ts_col)
        rows = df.select(*keys, day.alias("key_date")).distinct().withColumn("dedup_key", F.to_json(F.array(
            *(F.col(k).cast("string") for k in keys), F.col("key_date").cast("string"))))
        upsert(df.sparkSession, path, rows, "dedup_key", "key_date")
    return fn


def hourly_writer(path: str, ts_col: str, id_col: str = "aircraft_id") -> Callable:
    """foreachBatch body: each batch's signals and aircraft sketch per event-time
    hour, appended under its batch id (a retried batch replaces its own).  There
    is no state to bound, and a row counts however late it comes."""
    def fn(df: DataFrame, batch_id: int):
        hour = F.date_trunc("hour", event_time(ts_col))
        partial = df.groupBy(hour.alias("hour")).agg(
            F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(F.coalesce(id_col, F.lit("")), F.lit(12)).alias("aircraft"))
        gate(partial.select(instant_to_ntz("hour").alias("window_start"), "n", "aircraft"),
             lambda d: stage_batch(d, batch_id, path))
    return fn


def hourly_bitmap_writer(path: str, dictionary: str, ts_col: str, id_col: str = "aircraft_id") -> Callable:
    """foreachBatch body: each batch's aircraft per event-time hour as bitmaps over the
    dictionary of ids that grows with the batches; appended under the batch's id, so
    totals are exact whatever batches an hour is spread over and however late."""
    def fn(df: DataFrame, batch_id: int):
        def body(rows: DataFrame) -> None:
            # read by the dictionary and by the bitmaps
            signals = rows.select(F.date_trunc("hour", event_time(ts_col)).alias("hour"), id_col).distinct().persist()
            try:
                numbers = batch_dictionary(rows.sparkSession, dictionary, signals, id_col, batch_id)
                bitmaps = group_bitmaps(signals, ["hour"], id_col, numbers)
                stage_batch(bitmaps.select(instant_to_ntz("hour").alias("window_start"), "bucket", "bits"), batch_id, path)
            finally:
                signals.unpersist()
        gate(df, body)
    return fn


def hourly_aircraft(spark: SparkSession, path: str) -> DataFrame:
    """(window_start, active_aircraft): exact, from the bitmaps of all batches."""
    return distinct_counts(spark.read.parquet(path), ["window_start"], "active_aircraft")


def hourly_activity(spark: SparkSession, path: str) -> DataFrame:
    """Signals and approximate unique aircraft per hour from the batches' partial
    rows (sums and mergeable sketches)."""
    return spark.read.parquet(path).groupBy("window_start").agg(
        F.sum("n").alias("n_signals"), F.hll_sketch_estimate(F.hll_union_agg("aircraft")).alias("approx_aircraft"))


def event_time(col: str) -> F.Column:
    """NTZ wall clock read as UTC, independent of the session time zone."""
    return ntz_to_instant(col)
