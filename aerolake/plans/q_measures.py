"""Registered queries: measures (A1-A7) and business questions (B1-B13)."""

from __future__ import annotations

from functools import reduce

from aerolake import constants as K
from aerolake.operators import bitmaps as B
from aerolake.operators import measures as M
from aerolake.plans import build, questions as Q
from aerolake.plans.dims import dim_aircrafts
from aerolake.plans.oracle import _q, period_case, sql
from aerolake.plans.registry import register
from aerolake.functions.categorise import day_period
from aerolake.session import fresh_path

# ----------------------------------------------------------------- A1-A5
@register("total_signals", sql("SELECT count(flight_pk) AS total_signals FROM fct", "fct"))
def q_total_signals(spark, sf_dir):
    return M.total_signals(build.gold_fact(spark, sf_dir))


@register("active_aircraft", sql(
    "SELECT flight_date, count(DISTINCT aircraft_id) AS active_aircraft FROM fct GROUP BY flight_date", "fct"))
def q_active_aircraft(spark, sf_dir):
    return M.active_aircraft(build.gold_fact(spark, sf_dir), by="flight_date")


@register("avg_speed", sql(
    "SELECT airport_code, round(avg(speed_kmh), 4) AS avg_speed FROM fct GROUP BY airport_code", "fct"))
def q_avg_speed(spark, sf_dir):
    return M.avg_speed(build.gold_fact(spark, sf_dir), by="airport_code")


@register("traffic_peak", sql(
    "SELECT max(active_aircraft) AS traffic_peak FROM (SELECT flight_date, hour_24, "
    "count(DISTINCT aircraft_id) AS active_aircraft FROM fct GROUP BY flight_date, hour_24)", "fct"))
def q_traffic_peak(spark, sf_dir):
    return M.traffic_peak(build.gold_fact(spark, sf_dir))


@register("high_water_mark", sql("SELECT max(ingestion_timestamp) AS high_water_mark FROM fct", "fct"))
def q_high_water_mark(spark, sf_dir):
    return M.high_water(build.gold_fact(spark, sf_dir))


# ----------------------------------------------------------------- A7 roll-ups
_MEAS_SQL = ("count(flight_pk) AS total_signals, count(DISTINCT aircraft_id) AS active_aircraft, "
             "round(avg(speed_kmh), 4) AS avg_speed")
TIME_LEVELS = ["year_num", "quarter_name", "month_num", "day_num", "day_period", "hour_24"]
GEO_LEVELS = ["region", "state", "city", "airport_name", "airport_code"]
AIRCRAFT_LEVELS = ["aircraft_category", "continent", "origin_country", "aircraft_id"]
PHASE_COLUMNS = ["flight_status", "flight_behavior", "altitude_tier", "speed_tier"]
PHASE_SETS = [["flight_status", "flight_behavior", "altitude_tier"],
              ["flight_status", "flight_behavior", "speed_tier"],
              ["flight_status", "flight_behavior"], ["flight_status"], []]


def _rollup_sql(levels, source="star_p") -> str:
    cols = ", ".join(levels)
    return (f"SELECT {cols}, {_MEAS_SQL}, CAST(grouping_id({cols}) AS BIGINT) AS grouping_level "
            f"FROM {source} GROUP BY ROLLUP ({cols})")


_STAR_P = {"star_p": f"SELECT *, {period_case('hour_24')} AS day_period FROM star"}


@register("rollup_time", sql(_rollup_sql(TIME_LEVELS), "star", extra=_STAR_P))
def q_rollup_time(spark, sf_dir):
    s = build.gold_star(spark, sf_dir, "calendar").withColumn("day_period", day_period("hour_24"))
    return M.rollup_hierarchy(s, TIME_LEVELS)


@register("rollup_geo", sql(_rollup_sql(GEO_LEVELS, "star"), "star"))
def q_rollup_geo(spark, sf_dir):
    return M.rollup_hierarchy(build.gold_star(spark, sf_dir, "airports"), GEO_LEVELS)


@register("rollup_aircraft", sql(_rollup_sql(AIRCRAFT_LEVELS, "star"), "star"))
def q_rollup_aircraft(spark, sf_dir):
    return M.rollup_hierarchy(build.gold_star(spark, sf_dir, "aircrafts"), AIRCRAFT_LEVELS)


def _phase_sql() -> str:
    cols = ", ".join(PHASE_COLUMNS)
    sets = ", ".join("(" + ", ".join(s) + ")" for s in PHASE_SETS)
    return (f"SELECT {cols}, {_MEAS_SQL}, CAST(grouping_id({cols}) AS BIGINT) AS grouping_level "
            f"FROM fct GROUP BY GROUPING SETS ({sets})")


@register("rollup_phase", sql(_phase_sql(), "fct"))
def q_rollup_phase(spark, sf_dir):
    return M.grouping_sets_hierarchy(build.gold_fact(spark, sf_dir), PHASE_SETS, PHASE_COLUMNS)


# ----------------------------------------------------------------- B1-B13
@register("q_aircraft_per_hour", sql(
    "SELECT flight_date, hour_24, count(DISTINCT aircraft_id) AS active_aircraft, count(flight_pk) AS total_signals, "
    f"{period_case('hour_24')} AS day_period FROM fct GROUP BY flight_date, hour_24", "fct"))
def q_aircraft_per_hour(spark, sf_dir):
    return Q.aircraft_per_hour(build.gold_fact(spark, sf_dir))


@register("q_traffic_by_airport", sql(
    "SELECT airport_code, count(flight_pk) AS total_signals, count(DISTINCT aircraft_id) AS active_aircraft "
    "FROM fct GROUP BY airport_code", "fct"))
def q_traffic_by_airport(spark, sf_dir):
    return Q.traffic_by_airport(build.gold_fact(spark, sf_dir))


@register("q_approach_speed", sql(
    "SELECT airport_code, round(avg(speed_kmh), 4) AS avg_speed, count(*) AS n_signals FROM fct "
    f"WHERE flight_behavior = {_q(K.BEHAVIOR_DESCENT)} GROUP BY airport_code", "fct"))
def q_approach_speed(spark, sf_dir):
    return Q.approach_speed(build.gold_fact(spark, sf_dir))


@register("q_altitude_profile", sql(
    "SELECT aircraft_category, min(altitude_baro) AS min_altitude, round(avg(altitude_baro), 4) AS avg_altitude, "
    "max(altitude_baro) AS max_altitude, round(stddev_samp(altitude_baro), 4) AS std_altitude, "
    "round(quantile_cont(altitude_baro, 0.25), 4) AS p25_altitude, round(quantile_cont(altitude_baro, 0.5), 4) AS p50_altitude, "
    "round(quantile_cont(altitude_baro, 0.75), 4) AS p75_altitude, "
    f"count(*) AS n_signals FROM star WHERE flight_status = {_q(K.STATUS_AIR)} GROUP BY aircraft_category", "star"))
def q_altitude_profile(spark, sf_dir):
    return Q.altitude_profile(build.gold_star(spark, sf_dir, "aircrafts"))


@register("q_peak_landing_takeoff", sql(
    "SELECT day_of_week_num, movement, hour_24, n_signals FROM ("
    "SELECT *, row_number() OVER (PARTITION BY day_of_week_num, movement ORDER BY n_signals DESC, hour_24 ASC) AS rn "
    "FROM (SELECT day_of_week_num, CASE WHEN flight_behavior = " + _q(K.BEHAVIOR_DESCENT) + " THEN 'landing' "
    "ELSE 'takeoff' END AS movement, hour_24, count(*) AS n_signals FROM star WHERE flight_behavior IN ("
    + _q(K.BEHAVIOR_DESCENT) + ", " + _q(K.BEHAVIOR_CLIMB) + ") GROUP BY 1, 2, 3)) WHERE rn = 1", "star"))
def q_peak_landing_takeoff(spark, sf_dir):
    return Q.peak_landing_takeoff(build.gold_fact(spark, sf_dir))


@register("q_ground_share", sql(
    "SELECT hour_24, CAST(sum(CASE WHEN on_ground = true THEN 1 ELSE 0 END) AS BIGINT) AS n_ground, "
    "count(*) AS n_signals, round(sum(CASE WHEN on_ground = true THEN 1 ELSE 0 END) / count(*), 4) AS ground_share, "
    "round(1 - sum(CASE WHEN on_ground = true THEN 1 ELSE 0 END) / count(*), 4) AS air_share "
    "FROM fct GROUP BY hour_24", "fct"))
def q_ground_share(spark, sf_dir):
    return Q.ground_share(build.gold_fact(spark, sf_dir))


@register("q_crossing_altitude", sql(
    "SELECT hour_24, round(avg(altitude_baro), 4) AS avg_altitude, count(*) AS n_signals FROM fct "
    f"WHERE airport_code = 'N/A' AND flight_status = {_q(K.STATUS_AIR)} GROUP BY hour_24", "fct"))
def q_crossing_altitude(spark, sf_dir):
    return Q.crossing_altitude(build.gold_fact(spark, sf_dir))


@register("q_airport_share", sql(
    "SELECT airport_code, active_aircraft, round(active_aircraft * 100.0 / sum(active_aircraft) OVER (), 4) "
    "AS share_pct FROM (SELECT airport_code, count(DISTINCT aircraft_id) AS active_aircraft FROM fct "
    "GROUP BY airport_code)", "fct"))
def q_airport_share(spark, sf_dir):
    return Q.airport_share(build.gold_fact(spark, sf_dir))


@register("q_fleet_share", sql(
    "SELECT aircraft_category, n_aircraft, round(n_aircraft * 100.0 / sum(n_aircraft) OVER (), 4) AS share_pct "
    "FROM (SELECT aircraft_category, count(*) AS n_aircraft FROM dim_aircrafts GROUP BY aircraft_category)",
    "dim_aircrafts"))
def q_fleet_share(spark, sf_dir):
    return Q.fleet_share(dim_aircrafts(build.silver(spark, sf_dir)))


@register("q_fleet_countries", sql(
    "SELECT aircraft_category, origin_country, n_aircraft, "
    "round(n_aircraft * 100.0 / sum(n_aircraft) OVER (), 4) AS share_pct, "
    "CAST(row_number() OVER (ORDER BY n_aircraft DESC, origin_country ASC) AS INTEGER) AS country_rank "
    "FROM (SELECT aircraft_category, origin_country, count(*) AS n_aircraft FROM dim_aircrafts "
    "GROUP BY aircraft_category, origin_country)", "dim_aircrafts"))
def q_fleet_countries(spark, sf_dir):
    return Q.fleet_countries(dim_aircrafts(build.silver(spark, sf_dir)))


@register("q_speed_altitude_corr", sql(
    "SELECT round(corr(speed_kmh, altitude_baro), 4) AS corr_speed_altitude, count(*) AS n_signals FROM fct "
    f"WHERE flight_status = {_q(K.STATUS_AIR)}", "fct"))
def q_speed_altitude_corr(spark, sf_dir):
    return Q.speed_altitude_corr(build.gold_fact(spark, sf_dir))


@register("q_fast_low", sql(
    "SELECT flight_pk, aircraft_id, airport_code, hour_24, speed_kmh, altitude_baro FROM fct "
    f"WHERE flight_status = {_q(K.STATUS_AIR)} AND speed_kmh >= {Q.FAST_MIN_SPEED} "
    f"AND altitude_baro < {Q.LOW_MAX_ALTITUDE}", "fct"))
def q_fast_low(spark, sf_dir):
    return Q.fast_low(build.gold_fact(spark, sf_dir))


@register("q_speed_by_airport", sql(
    "SELECT airport_code, round(avg(speed_kmh), 4) AS avg_speed, count(*) AS n_signals FROM fct "
    "GROUP BY airport_code", "fct"))
def q_speed_by_airport(spark, sf_dir):
    return Q.speed_by_airport(build.gold_fact(spark, sf_dir))


_HOURLY = "SELECT hour_24, count(DISTINCT aircraft_id) AS active_aircraft FROM fct GROUP BY hour_24"


@register("q_peak_hours", sql(f"SELECT * FROM ({_HOURLY}) ORDER BY active_aircraft DESC, hour_24 ASC LIMIT 3", "fct"))
def q_peak_hours(spark, sf_dir):
    return Q.peak_hours(build.gold_fact(spark, sf_dir))


@register("q_idle_hours", sql(f"SELECT * FROM ({_HOURLY}) ORDER BY active_aircraft ASC, hour_24 ASC LIMIT 3", "fct"))
def q_idle_hours(spark, sf_dir):
    return Q.idle_hours(build.gold_fact(spark, sf_dir))


# ------------------------------------------------------------------ A2, A7 by bitmaps
@register("active_aircraft_cube", sql(
    "SELECT airport_code, flight_date, hour_24, count(DISTINCT aircraft_id) AS active_aircraft FROM fct "
    "GROUP BY GROUPING SETS ((airport_code, flight_date, hour_24), (airport_code, flight_date), (airport_code), (flight_date), ())", "fct"))
def q_active_aircraft_cube(spark, sf_dir):
    """Exact unique aircraft by hour, day, airport and in all: the fact is read once for
    the bitmaps of the hours, every coarser count is of united bitmaps."""
    path = fresh_path(spark, "cube-fact")
    build.gold_fact(spark, sf_dir).select("airport_code", "flight_date", "hour_24", "aircraft_id").distinct().write.parquet(path)
    signals = spark.read.parquet(path)
    finest = ["airport_code", "flight_date", "hour_24"]
    leaves = B.group_bitmaps(signals, finest, "aircraft_id", B.dictionary(signals, "aircraft_id"))
    stored = fresh_path(spark, "cube-bitmaps")
    leaves.write.parquet(stored)
    leaves = spark.read.schema(leaves.schema).parquet(stored)
    levels = [finest, finest[:2], finest[:1], finest[1:2], []]
    counts = [B.distinct_counts(leaves, level, "active_aircraft") for level in levels]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), counts)
