"""Registered queries: builds that may be repeated, come late or find nothing new
(load ledger, quality state, snapshot tables, dense ids, content reconciliation)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake import jobs, loads, snapshots
from aerolake.constants import GEOFENCE_MARGIN_DEG
from aerolake.operators import clustering
from aerolake.plans import build, dims, layers, telemetry
from aerolake.plans.fact import FACT_COLUMNS
from aerolake.plans.oracle import CTES, sql, stg_chain
from aerolake.plans.q_quality import suite_sql
from aerolake.plans.registry import register
from aerolake.plans.telemetry_vectors import state_vectors
from aerolake.session import fresh_path
from aerolake.sources import sinks
from aerolake.sources.tables import read_table, source


def commit_load(spark: SparkSession, raw_path: str, name: str, rows: DataFrame) -> None:
    """Bronze rows that have their ids and times already, as one committed load."""
    keyed = rows.withColumn("load_id", F.lit(name))
    loads.record(spark, raw_path, f"load_id={name}", keyed.count(), "",
                 lambda first_id: sinks.write_partitions(keyed, raw_path, ["load_id"], clustered=False))


# ------------------------------------------------------------------ D1, D6: state by partition
_OTHER_DAY = 400 * 86_400       # seconds
_REPEATS = {"bronze_r": f"SELECT * FROM bronze UNION ALL SELECT * REPLACE (time_position + {_OTHER_DAY} AS time_position) "
                        "FROM bronze WHERE event_id % 50 = 0",
            **stg_chain("bronze_r", "r_"),
            **{f"r_{d}": CTES[d][1].replace("FROM stg", "FROM r_stg") for d in ("dim_aircrafts", "dim_calendar")}}


@register("dq_incremental", suite_sql("r_", _REPEATS))
def q_dq_incremental(spark, sf_dir):
    """Three loads with a build after each: half of the rows; none; the other half and
    ids of the first that are repeated on another day.  Then a build without a load."""
    bronze = telemetry.bronze(spark, sf_dir)
    raw, root = fresh_path(spark, "bronze"), fresh_path(spark, "warehouse")
    again = bronze.where("event_id % 50 = 0").withColumn("time_position", F.col("time_position") + F.lit(_OTHER_DAY))
    for name, rows in (("first", bronze.where("event_id % 2 = 0")), ("nothing", bronze.where("false")),
                       ("second", bronze.where("event_id % 2 <> 0").unionByName(again))):
        commit_load(spark, raw, name, rows)
        jobs.build(spark, raw, root)
    return jobs.build(spark, raw, root).select("model", "check_name", "column_name", "violations", "passed")


# ------------------------------------------------------------------ N1: ledger of loads
@register("incremental_late_load", sql("SELECT * FROM fct", "fct"))
def q_incremental_late_load(spark, sf_dir):
    """The newer half of the loads is committed and built first; the older half comes
    late.  A high-water mark would pass over it."""
    bronze = telemetry.bronze(spark, sf_dir)
    days = bronze.select("processing_date").distinct()
    middle = days.agg(F.percentile(F.datediff("processing_date", F.lit("1970-01-01")), 0.5).cast("int")).first()[0]
    newer = F.datediff("processing_date", F.lit("1970-01-01")) > middle
    raw, root = fresh_path(spark, "bronze"), fresh_path(spark, "warehouse")
    for name, part in (("newer", newer), ("older", ~newer)):
        commit_load(spark, raw, name, bronze.where(part))
        jobs.build(spark, raw, root)
    return snapshots.read(spark, layers.layer_path(root, "gold", "fct_flights")).select(*FACT_COLUMNS)


# ------------------------------------------------------------------ N2: snapshots
@register("upsert_snapshot", sql(
    "SELECT 1 AS version, o_orderkey, o_orderstatus FROM orders UNION ALL "
    "SELECT 3, o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'Y' WHEN o_orderkey % 5 = 0 THEN 'X' ELSE o_orderstatus END FROM orders"))
def q_upsert_snapshot(spark, sf_dir):
    """All orders, then two batches of new statuses; a reader of the first commit still
    sees it after the others."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.trunc("o_orderdate", "month").alias("order_month"))
    path = fresh_path(spark, "upsert-snapshot")
    snapshots.upsert(spark, path, orders, "o_orderkey", "order_month")
    before = snapshots.read(spark, path)
    for modulus, status in ((5, "X"), (3, "Y")):
        batch = orders.where(f"o_orderkey % {modulus} = 0").withColumn("o_orderstatus", F.lit(status))
        last = snapshots.upsert(spark, path, batch, "o_orderkey", "order_month")["version"]
    seen = lambda df, version: df.select(F.lit(version).alias("version"), "o_orderkey", "o_orderstatus")     # noqa: E731
    return seen(before, 1).unionByName(seen(snapshots.read(spark, path), last))


# ------------------------------------------------------------------ S9: dense ids
@register("surrogate_dense", sql(
    "SELECT range AS id_surrogate, true AS kept_by_repetition FROM range(1, (SELECT count(*) + 1 FROM telemetry))", "telemetry"))
def q_surrogate_dense(spark, sf_dir):
    """Three loads and one of them again: ids are 1 to n, and the repeated load has the
    ids that it had."""
    polls = state_vectors(telemetry.telemetry(spark, sf_dir), keep=["event_id"]).withColumns({
        "processing_date": F.date_add(F.lit("2024-02-01").cast("date"), (F.col("event_id") % 3).cast("int")), "batch_id": F.lit("poll")})
    landed, raw = fresh_path(spark, "landed"), fresh_path(spark, "bronze")
    sinks.write_partitions(polls, landed, ["processing_date", "batch_id"])
    for day in ("2024-02-01", "2024-02-02", "2024-02-03"):
        jobs.load(spark, landed, day, raw, f"{day} 06:00:00")
    numbered = lambda: sinks.content_digest(["event_id", "id_surrogate"])     # noqa: E731
    second = f"{raw}/processing_date=2024-02-02"
    before = tuple(spark.read.parquet(second).agg(*numbered()).first())
    jobs.load(spark, landed, "2024-02-02", raw, "2024-02-04 06:00:00")
    same = tuple(spark.read.parquet(second).agg(*numbered()).first()) == before
    return spark.read.parquet(raw).select("id_surrogate", F.lit(same).alias("kept_by_repetition"))


# ------------------------------------------------------------------ S10: contents
@register("reconcile_content", sql(
    "SELECT * FROM (SELECT count(*) AS n_rows FROM telemetry), "
    "(VALUES ('as written', true, true), ('one value changed', true, false)) AS v(landed, counts_agree, contents_agree)", "telemetry"))
def q_reconcile_content(spark, sf_dir):
    """State vectors digested on their way into files, against what lies there; and
    against the same rows of which one has another value."""
    vectors = state_vectors(telemetry.telemetry(spark, sf_dir), keep=["event_id"])
    content = sinks.ContentReconciliation(vectors.columns)
    path = fresh_path(spark, "landed")
    content.tap(vectors, "in").write.parquet(path)
    landed = spark.read.parquet(path)
    one = landed.agg(F.max("event_id")).first()[0]
    changed = landed.withColumn("callsign", F.when(F.col("event_id") == one, F.lit("?")).otherwise(F.col("callsign")))
    sent, rows = content.digest("in"), []
    for what, frame in (("as written", landed), ("one value changed", changed)):
        found = content.of(frame)
        rows.append((what, found[0], found[0] == sent[0], found == sent))
    return spark.createDataFrame(rows, "landed string, n_rows long, counts_agree boolean, contents_agree boolean")


# ------------------------------------------------------------------ S13: sources by name
@register("source_by_name", sql("SELECT id_surrogate, icao24, inserted_at FROM bronze", "bronze"))
def q_source_by_name(spark, sf_dir):
    """Bronze opened by its declared name, through a path and through the catalog."""
    bronze = telemetry.bronze(spark, sf_dir).select("id_surrogate", "icao24", "inserted_at")
    path = fresh_path(spark, "raw")
    bronze.where("id_surrogate % 2 = 0").write.parquet(path)
    view = f"bronze_{path.rsplit('-', 1)[1]}"
    bronze.where("id_surrogate % 2 <> 0").createOrReplaceTempView(view)
    registry = {"raw.flights_even": path, "raw.flights_odd": view}
    return source(spark, registry, "raw", "flights_even").unionByName(source(spark, registry, "raw", "flights_odd"))


# ------------------------------------------------------------------ J1, P22: a fact laid out by place
@register("geofence_clustered", sql(
    "SELECT f.flight_pk, f.airport_code, f.latitude, f.longitude FROM fct f WHERE f.airport_code = 'CGH'", "fct"))
def q_geofence_clustered(spark, sf_dir):
    """The fact in files along a space-filling curve; the signals of one airport are
    those in its box, read from the files whose bounds meet it."""
    fact = build.gold_fact(spark, sf_dir).select("flight_pk", "airport_code", "latitude", "longitude")
    path = fresh_path(spark, "clustered-fact")
    clustering.write_clustered(fact, path, files=64)
    box = dims.dim_airports(spark).where("airport_code = 'CGH'").first()
    m = GEOFENCE_MARGIN_DEG
    found = clustering.read_box(spark, path, fact.schema, box.lat_min - m, box.lat_max + m, box.lon_min - m, box.lon_max + m)
    return found.where("airport_code = 'CGH'")
