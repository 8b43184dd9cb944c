"""Registered queries: sources and sinks (S1-S12) and incremental /
materialisation operators (N1-N6).  Queries that write do so under a fresh
folder of the shared checkpoint dir and return what they read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from aerolake.operators.incremental import high_water_mark, upsert
from aerolake import jobs, loads, snapshots
from aerolake.plans import build, dims, layers, telemetry
from aerolake.plans.fact import FACT_COLUMNS, fct_flights
from aerolake.plans.oracle import sql, stg_chain
from aerolake.plans.q_stream import broken_message_files
from aerolake.plans.registry import register
from aerolake.plans.staging import stg_flights, stg_flights_since
from aerolake.plans.telemetry_vectors import SV_SQL_COLS, state_vectors
from aerolake.session import fresh_path
from aerolake.sources import ingest, sinks
from aerolake.sources.split_documents import read_documents_split
from aerolake.sources.tables import read_table

SV_SQL = sql(f"SELECT {SV_SQL_COLS} FROM telemetry", "telemetry")


def _vectors(spark, sf_dir):
    return state_vectors(telemetry.telemetry(spark, sf_dir))


def _documents(spark, sf_dir) -> str:
    path = fresh_path(spark, "state-vector-docs")
    sinks.write_state_vector_documents(_vectors(spark, sf_dir), path)
    return path


def _message_lines(spark, sf_dir) -> str:
    path = fresh_path(spark, "state-vector-lines")
    sinks.publish(_vectors(spark, sf_dir), fmt="text", path=path)
    return path


# ------------------------------------------------------------------ S1-S5
@register("read_state_vectors", SV_SQL)
def q_read_state_vectors(spark, sf_dir):
    rows = ingest.read_state_vectors(spark, _documents(spark, sf_dir), layout="document")
    return ingest.typed_projection(rows)


_BRACKETS = "CASE WHEN time_position % 7 = 0 THEN 'x]\"[,' || callsign ELSE callsign END"


@register("read_state_vectors_split", sql(f"SELECT * REPLACE ({_BRACKETS} AS callsign) FROM (SELECT {SV_SQL_COLS} FROM telemetry)", "telemetry"))
def q_read_state_vectors_split(spark, sf_dir):
    """Documents read in byte ranges, some with brackets and quotes in a string."""
    path = fresh_path(spark, "state-vector-docs")
    sinks.write_state_vector_documents(_vectors(spark, sf_dir).withColumn("callsign", F.expr(_BRACKETS)), path)
    return ingest.typed_projection(read_documents_split(spark, path))


@register("read_state_vectors_lines", SV_SQL)
def q_read_state_vectors_lines(spark, sf_dir):
    rows = ingest.read_state_vectors(spark, _message_lines(spark, sf_dir), layout="lines")
    return ingest.typed_projection(rows)


@register("unwrap_states", sql(
    f"SELECT time_position AS poll_time, {SV_SQL_COLS} FROM telemetry WHERE event_id % 23 <> 0 AND event_id % 29 <> 0 "
    "AND event_id % 31 <> 0", "telemetry"))
def q_unwrap_states(spark, sf_dir):
    # one poll envelope per state: {"time": <t>, "states": [[...]]}; some without
    # states, some with null, some with an empty list
    head = F.concat(F.lit('{"time":'), F.col("time_position").cast("string"))
    env = state_vectors(telemetry.telemetry(spark, sf_dir), keep=["event_id"]).select(
        F.when(F.expr("event_id % 23 = 0"), F.concat(head, F.lit("}")))
        .when(F.expr("event_id % 29 = 0"), F.concat(head, F.lit(',"states":null}')))
        .when(F.expr("event_id % 31 = 0"), F.concat(head, F.lit(',"states":[]}')))
        .otherwise(F.concat(head, F.lit(',"states":['), sinks.json_array_text(sinks.STATE_VECTOR_NAMES), F.lit("]}"))).alias("value"))
    path = fresh_path(spark, "poll-envelopes")
    env.write.text(path)
    rows = ingest.unwrap_states(spark.read.text(path))
    return ingest.typed_projection(rows, keep=["poll_time"])


@register("contract_width", sql(
    "SELECT problem, count(*) AS n, true AS reconciled FROM (SELECT CASE WHEN event_id % 41 = 0 THEN 'malformed' "
    "WHEN event_id % 31 = 0 THEN 'width' ELSE 'good' END AS problem FROM telemetry) GROUP BY 1", "telemetry"))
def q_contract_width(spark, sf_dir):
    """An ingest run in quarantine mode over messages of which some are cut off
    and some one value short: what it landed and what it set aside."""
    src, root = broken_message_files(spark, sf_dir), fresh_path(spark, "ingested")
    counts = jobs.ingest(spark, src, root, "2024-02-01", "poll-1", layout="lines", on_violation="quarantine")
    bad = spark.read.json(f"{root}_quarantine").groupBy("problem").agg(F.count("*").alias("n"))
    good = spark.read.parquet(root).agg(F.lit("good").alias("problem"), F.count("*").alias("n"))
    agreed = counts["rows_in"] == counts["rows_out"] + counts["malformed"] + counts["bad_width"]
    return good.union(bad).withColumn("reconciled", F.lit(agreed))


@register("typed_projection", SV_SQL)
def q_typed_projection(spark, sf_dir):
    rows = ingest.read_state_vectors(spark, _message_lines(spark, sf_dir), layout="lines")
    # the contract given as ordered (name, type) pairs, as a config file would list it
    pairs = [(f.name, f.dataType.simpleString()) for f in ingest.STATE_VECTOR_SCHEMA]
    return ingest.typed_projection(rows, schema=pairs)


@register("stamp_date", sql("SELECT *, DATE '2024-02-01' AS processing_date FROM telemetry", "telemetry"))
def q_stamp_date(spark, sf_dir):
    return ingest.with_processing_date(telemetry.telemetry(spark, sf_dir), "2024-02-01")


# ------------------------------------------------------------------ S6, S7 over orders
ORDERS_SQL_MONTH = "CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month"
BUSIEST_SQL = f"(SELECT order_month FROM (SELECT {ORDERS_SQL_MONTH} FROM orders) GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"


def _orders_by_month(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    return o.withColumn("order_month", F.trunc("o_orderdate", "month"))


def _busiest_month(orders) -> str:
    return str(orders.groupBy("order_month").count().orderBy(F.desc("count"), "order_month").first()["order_month"])


@register("partition_overwrite", sql(
    f"SELECT * FROM (SELECT *, {ORDERS_SQL_MONTH} FROM orders) "
    f"WHERE NOT (order_month = {BUSIEST_SQL} AND o_orderpriority <> '1-URGENT')"))
def q_partition_overwrite(spark, sf_dir):
    path = fresh_path(spark, "orders-by-month")
    orders = _orders_by_month(spark, sf_dir)
    sinks.write_partitions(orders, path, "order_month")
    # a rerun of one month with fewer rows replaces that month only
    redo = orders.filter((F.col("order_month") == F.lit(_busiest_month(orders)).cast("date"))
                         & (F.col("o_orderpriority") == "1-URGENT"))
    sinks.write_partitions(redo, path, "order_month")
    return spark.read.parquet(path).select(*orders.columns)


@register("scan_partition", sql(
    f"SELECT * FROM (SELECT *, {ORDERS_SQL_MONTH} FROM orders) WHERE order_month = {BUSIEST_SQL}"))
def q_scan_partition(spark, sf_dir):
    path = fresh_path(spark, "orders-by-month")
    orders = _orders_by_month(spark, sf_dir)
    sinks.write_partitions(orders, path, "order_month")
    return ingest.scan_partition(spark, path, "order_month", _busiest_month(orders)).select(*orders.columns)


@register("poll_batches", sql(
    "SELECT o_orderkey, o_orderpriority, DATE '2024-02-01' AS processing_date, CASE WHEN o_orderkey % 3 = 0 THEN 'p1' ELSE 'p2' END AS batch_id "
    "FROM orders WHERE o_orderkey % 3 = 0 OR o_orderpriority = '1-URGENT'"))
def q_poll_batches(spark, sf_dir):
    """Two polls of one date stay side by side; the second, run again with fewer
    rows, replaces itself only."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority").withColumn(
        "processing_date", F.lit("2024-02-01").cast("date"))
    path = fresh_path(spark, "polls")
    by = ["processing_date", "batch_id"]
    second = orders.where("o_orderkey % 3 <> 0").withColumn("batch_id", F.lit("p2"))
    sinks.write_partitions(orders.where("o_orderkey % 3 = 0").withColumn("batch_id", F.lit("p1")), path, by)
    sinks.write_partitions(second, path, by)
    sinks.write_partitions(second.where("o_orderpriority = '1-URGENT'"), path, by)
    return spark.read.parquet(path).select("o_orderkey", "o_orderpriority", *by)


# ------------------------------------------------------------------ S9-S12
@register("bronze_defaults", sql(
    "SELECT count(*) AS n_rows, count(*) AS n_ids, true AS above_offset, 1::BIGINT AS n_insert_times FROM telemetry", "telemetry"))
def q_bronze_defaults(spark, sf_dir):
    out = sinks.with_bronze_columns(_vectors(spark, sf_dir), "2024-02-01 00:00:00", id_offset=1_000_000)
    return out.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("id_surrogate").alias("n_ids"),
                   (F.min("id_surrogate") >= 1_000_000).alias("above_offset"),
                   F.count_distinct("inserted_at").alias("n_insert_times"))


@register("reconcile_counts", sql(
    "SELECT count(*) AS rows_in, count(*) AS rows_out, true AS matched FROM telemetry", "telemetry"))
def q_reconcile_counts(spark, sf_dir):
    rec = sinks.Reconciliation()
    rows = rec.tap_in(ingest.read_state_vectors(spark, _documents(spark, sf_dir)))
    typed = rec.tap_out(ingest.typed_projection(ingest.check_width(rows)))
    out = fresh_path(spark, "reconciled")
    ingest.with_processing_date(typed, "2024-02-01").write.parquet(out)
    n_in, n_out = rec.result()
    return spark.createDataFrame([(n_in, n_out, n_in == n_out)], "rows_in long, rows_out long, matched boolean")


@register("land_raw", sql("SELECT *, CAST(inserted_at AS DATE) AS dt FROM telemetry", "telemetry"))
def q_land_raw(spark, sf_dir):
    tel = telemetry.telemetry(spark, sf_dir)
    path = fresh_path(spark, "landing")
    sinks.land_raw(tel, path, F.to_date("inserted_at"))
    return sinks.read_landed(spark, path, tel.schema.add("dt", "date"))


@register("publish_messages", SV_SQL)
def q_publish_messages(spark, sf_dir):
    rows = ingest.read_state_vectors(spark, _message_lines(spark, sf_dir), layout="lines")
    return ingest.typed_projection(rows)


# ------------------------------------------------------------------ S14
@register("flight_legs", sql(
    "SELECT trim(icao24) AS icao24, CAST(time_position AS INTEGER) AS \"firstSeen\", CAST(time_position + 3600 AS INTEGER) AS \"lastSeen\", "
    "CASE WHEN event_id % 4 = 0 THEN NULL ELSE 'SBGR' END AS \"estDepartureAirport\", trim(callsign) AS callsign, "
    "CAST(event_id % 5 AS INTEGER) AS \"arrivalAirportCandidatesCount\", CAST(3600 AS BIGINT) AS seconds FROM telemetry", "telemetry"))
def q_flight_legs(spark, sf_dir):
    """Departure and arrival records as the endpoint delivers them, read back with the declared schema."""
    legs = telemetry.telemetry(spark, sf_dir).select(
        F.trim("icao24").alias("icao24"), F.col("time_position").alias("firstSeen"),
        (F.col("time_position") + 3600).alias("lastSeen"),
        F.when(F.expr("event_id % 4 <> 0"), "SBGR").alias("estDepartureAirport"), F.trim("callsign").alias("callsign"),
        (F.col("event_id") % 5).alias("arrivalAirportCandidatesCount"), F.lit("unknown").alias("extra"))
    path = fresh_path(spark, "legs")
    legs.write.json(path)
    got = ingest.read_flight_legs(spark, path)
    return got.select("icao24", "firstSeen", "lastSeen", "estDepartureAirport", "callsign", "arrivalAirportCandidatesCount",
                      (F.unix_seconds("last_seen_ts") - F.unix_seconds("first_seen_ts")).alias("seconds"))


# ------------------------------------------------------------------ N1-N6
# first load: rows inserted before the middle of the time that the table covers
_LOAD1 = {"bronze1": "SELECT * FROM bronze WHERE inserted_at < (SELECT make_timestamp("
                     "(epoch_us(min(inserted_at)) + epoch_us(max(inserted_at))) // 2) FROM bronze)",
          **stg_chain("bronze1", "l1_")}


def _loads(spark, sf_dir):
    bronze_all = telemetry.bronze(spark, sf_dir)
    first, last = bronze_all.agg(F.min("inserted_at"), F.max("inserted_at")).first()
    bronze1 = bronze_all.filter(F.col("inserted_at") < F.lit(str(first + (last - first) // 2)).cast("timestamp_ntz"))
    return bronze1, bronze_all


@register("incremental_filter", sql(
    "SELECT * FROM stg WHERE inserted_at > (SELECT max(ingestion_timestamp) FROM l1_fct)", "stg", "airports",
    extra=_LOAD1))
def q_incremental_filter(spark, sf_dir):
    bronze1, bronze_all = _loads(spark, sf_dir)
    airports = dims.dim_airports(spark)
    fct1 = fct_flights(stg_flights(bronze1), airports, n_airports=dims.N_AIRPORTS)
    return stg_flights_since(bronze_all, high_water_mark(fct1))


@register("incremental_upsert", sql("SELECT * FROM fct", "fct"))
def q_incremental_upsert(spark, sf_dir):
    bronze1, bronze_all = _loads(spark, sf_dir)
    airports = dims.dim_airports(spark)
    path = fresh_path(spark, "fct_flights")
    first = fct_flights(stg_flights(bronze1), airports, n_airports=dims.N_AIRPORTS)
    upsert(spark, path, first, "flight_pk", "flight_date")
    fresh = stg_flights_since(bronze_all, high_water_mark(snapshots.read(spark, path)))
    upsert(spark, path, fct_flights(fresh, airports, n_airports=dims.N_AIRPORTS), "flight_pk", "flight_date")
    return snapshots.read(spark, path).select(*FACT_COLUMNS)


_MONTH_OR_NULL = "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(date_trunc('month', o_orderdate) AS DATE) END"


@register("upsert_null_partition", sql(f"SELECT o_orderkey, o_orderstatus, {_MONTH_OR_NULL} AS order_month FROM orders"))
def q_upsert_null_partition(spark, sf_dir):
    """Three batches that all touch the NULL partition: nothing stored there goes."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.when(
        F.expr("o_orderkey % 7 <> 0"), F.trunc("o_orderdate", "month")).alias("order_month"))
    path = fresh_path(spark, "upsert-null")
    for part in range(3):
        upsert(spark, path, orders.where(f"o_orderkey % 3 = {part}"), "o_orderkey", "order_month")
    return snapshots.read(spark, path).select(*orders.columns)


@register("upsert_ties", sql(
    "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month, 1 AS load_no, "
    "CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 1 END AS v FROM orders"))
def q_upsert_ties(spark, sf_dir):
    """Equal order values: the later batch wins; an older load never does."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", F.trunc("o_orderdate", "month").alias("order_month"))
    path = fresh_path(spark, "upsert-ties")
    for modulus, load_no, v in ((1, 1, 1), (3, 1, 2), (5, 0, 3)):
        batch = orders.where(f"o_orderkey % {modulus} = 0").withColumn("load_no", F.lit(load_no)).withColumn("v", F.lit(v))
        upsert(spark, path, batch, "o_orderkey", "order_month", order_by="load_no")
    return snapshots.read(spark, path).select("o_orderkey", "order_month", "load_no", "v")


_UNTIMED = {"bronze_u": "SELECT * REPLACE (CASE WHEN event_id % 17 = 0 THEN NULL ELSE time_position END AS time_position) FROM bronze",
            **stg_chain("bronze_u", "u_")}


@register("upsert_untimed", sql("SELECT *, flight_pk IS NULL AS rejected FROM u_fct", "stg", "airports", extra=_UNTIMED))
def q_upsert_untimed(spark, sf_dir):
    """Signals without a time have no key: they are set aside, the rest is kept."""
    bronze = telemetry.bronze(spark, sf_dir).withColumn(
        "time_position", F.when(F.expr("event_id % 17 <> 0"), F.col("time_position")))
    path = fresh_path(spark, "upsert-untimed")
    rows = fct_flights(stg_flights(bronze), dims.dim_airports(spark), n_airports=dims.N_AIRPORTS)
    upsert(spark, path, rows, "flight_pk", "flight_date", on_null_key="quarantine", run_id="r1")
    kept = snapshots.read(spark, path).select(*rows.columns, F.lit(False).alias("rejected"))
    aside = spark.read.schema(rows.schema).parquet(f"{path}_rejected/run_id=r1").select(*rows.columns, F.lit(True).alias("rejected"))
    return kept.union(aside)


@register("full_refresh", sql("SELECT * FROM dim_aircrafts", "dim_aircrafts"))
def q_full_refresh(spark, sf_dir):
    root = fresh_path(spark, "warehouse")
    stg = build.silver(spark, sf_dir)
    layers.materialise(dims.dim_aircrafts(stg), "dim_aircrafts", "table", root=root)
    # a second build replaces the table as a whole
    return layers.materialise(dims.dim_aircrafts(stg), "dim_aircrafts", "table", root=root)


@register("silver_view", sql("SELECT * FROM stg", "stg"))
def q_silver_view(spark, sf_dir):
    return layers.materialise(build.silver(spark, sf_dir), f"stg_flights_{uuid.uuid4().hex[:8]}", "view",
                              layer="silver")


@register("build_star", sql("SELECT * FROM star", "star"))
def q_build_star(spark, sf_dir):
    root = fresh_path(spark, "warehouse")
    b = build.build_star(spark, telemetry.bronze(spark, sf_dir))
    ac = layers.materialise(b.aircrafts, "dim_aircrafts", "table", root=root)
    ap = layers.materialise(b.airports, "dim_airports", "table", root=root)
    ca = layers.materialise(b.calendar, "dim_calendar", "table", root=root)
    f = layers.materialise(b.fct, "fct_flights", "table", root=root, partition_by="flight_date").select(*FACT_COLUMNS)
    return build.StarBuild(b.stg, ap, ac, ca, f).star()
