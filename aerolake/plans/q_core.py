"""Registered queries: cleaning, categories, joins, dedup, dimensions, models."""

from __future__ import annotations

from pyspark.sql import functions as F

from aerolake import constants as K
from aerolake.functions import calendar as cal
from aerolake.functions import categorise as cat
from aerolake.functions import clean
from aerolake.functions.units import to_aviation_units
from aerolake.operators import geo
from aerolake.operators.dedup import dedup_latest
from aerolake.operators.star import lookup_join, slice_df
from aerolake.plans import build, dims, staging, telemetry
from aerolake.plans.oracle import (_continent_case, altitude_case, behavior_case, calendar_cols,
                                   period_case, speed_case, sql, status_case, us_week_sql)
from aerolake.plans.registry import register
from aerolake.sources.tables import read_table

STG_ID = "aircraft_id, position_timestamp"


# ----------------------------------------------------------------- models (N7, N8)
@register("stg_flights", sql("SELECT * FROM stg", "stg"))
def q_stg_flights(spark, sf_dir):
    return build.silver(spark, sf_dir)


@register("fct_flights", sql("SELECT * FROM fct", "fct"))
def q_fct_flights(spark, sf_dir):
    return build.gold_fact(spark, sf_dir)


@register("typed_telemetry", sql("SELECT * FROM typed", "typed"))
def q_typed_telemetry(spark, sf_dir):
    return clean.typed_telemetry(telemetry.bronze(spark, sf_dir))


# ----------------------------------------------------------------- P1 / P2
def _near_sql() -> str:
    terms = " OR ".join(
        f"(abs(latitude - CAST({la!r} AS DOUBLE)) < {K.PRODUCER_MAX_DEG} AND "
        f"abs(longitude - CAST({lo!r} AS DOUBLE)) < {K.PRODUCER_MAX_DEG})"
        for la, lo in K.PRODUCER_CENTRES.values())
    return ("SELECT * FROM telemetry WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND (" + terms + ")")


@register("near_any_center", sql(_near_sql(), "telemetry"))
def q_near_any_center(spark, sf_dir):
    return geo.near_any(telemetry.telemetry(spark, sf_dir))


@register("near_any_center_grid", sql(_near_sql(), "telemetry"))
def q_near_any_center_grid(spark, sf_dir):
    # the many-centre form (left-semi grid join), forced on the same centres
    return geo.near_any(telemetry.telemetry(spark, sf_dir), max_or_terms=0)


@register("drop_null_coords", sql("SELECT * FROM telemetry WHERE event_id % 9 <> 0 AND event_id % 14 <> 0", "telemetry"))
def q_drop_null_coords(spark, sf_dir):
    # positions that were not delivered: some lack the latitude, some the longitude
    holes = telemetry.telemetry(spark, sf_dir).withColumns({
        "latitude": F.when(F.expr("event_id % 9 <> 0"), F.col("latitude")),
        "longitude": F.when(F.expr("event_id % 14 <> 0"), F.col("longitude"))})
    return clean.drop_null_coords(holes)


# ----------------------------------------------------------------- P3-P10
@register("clean_identifiers", sql(
    "SELECT event_id, left(upper(trim(icao24)), 50) AS aircraft_id, "
    "left(upper(trim(replace(callsign, '-', ''))), 50) AS flight_number, "
    "trim(origin_country) AS origin_country FROM telemetry", "telemetry"))
def q_clean_identifiers(spark, sf_dir):
    t = telemetry.telemetry(spark, sf_dir)
    return t.select("event_id", clean.normalise_id("icao24").alias("aircraft_id"),
                    clean.normalise_callsign("callsign").alias("flight_number"),
                    clean.trim_text("origin_country").alias("origin_country"))


@register("epoch_to_timestamp", sql(
    "SELECT event_id, time_position, make_timestamp(CAST(time_position AS BIGINT) * 1000000) AS position_timestamp "
    "FROM telemetry", "telemetry"))
def q_epoch_to_timestamp(spark, sf_dir):
    t = telemetry.telemetry(spark, sf_dir)
    return t.select("event_id", "time_position", clean.epoch_to_ts("time_position").alias("position_timestamp"))


@register("null_defaults", sql(
    f"SELECT {STG_ID}, coalesce(speed_kmh, 0) AS speed_kmh, coalesce(altitude_baro, 0) AS altitude_baro, "
    "coalesce(vertical_rate, 0) AS vertical_rate, coalesce(origin_country, 'Desconhecido') AS origin_country "
    "FROM stg", "stg"))
def q_null_defaults(spark, sf_dir):
    s = build.silver(spark, sf_dir).select("aircraft_id", "position_timestamp", "speed_kmh", "altitude_baro",
                                           "vertical_rate", "origin_country")
    return clean.default_nulls(s, {**clean.METRIC_DEFAULTS, **clean.COUNTRY_DEFAULT})


@register("signal_key", sql(
    f"SELECT {STG_ID}, aircraft_id || '-' || strftime(position_timestamp, '%Y-%m-%d %H:%M:%S') AS flight_pk "
    "FROM stg", "stg"))
def q_signal_key(spark, sf_dir):
    s = build.silver(spark, sf_dir)
    return s.select("aircraft_id", "position_timestamp",
                    clean.signal_key("aircraft_id", "position_timestamp").alias("flight_pk"))


@register("date_and_hour", sql(
    f"SELECT {STG_ID}, CAST(position_timestamp AS DATE) AS flight_date, "
    "CAST(hour(position_timestamp) AS INTEGER) AS hour_24 FROM stg", "stg"))
def q_date_and_hour(spark, sf_dir):
    s = build.silver(spark, sf_dir)
    return s.select("aircraft_id", "position_timestamp", clean.to_date_col("position_timestamp").alias("flight_date"),
                    clean.hour_of("position_timestamp").alias("hour_24"))


# ----------------------------------------------------------------- P11-P16, P20, P21
@register("flight_status", sql(f"SELECT {STG_ID}, on_ground, {status_case()} AS flight_status FROM stg", "stg"))
def q_flight_status(spark, sf_dir):
    s = build.silver(spark, sf_dir)
    return s.select("aircraft_id", "position_timestamp", "on_ground", cat.flight_status().alias("flight_status"))


@register("flight_behavior", sql(
    f"SELECT {STG_ID}, on_ground, altitude_baro, vertical_rate, {behavior_case()} AS flight_behavior FROM stg", "stg"))
def q_flight_behavior(spark, sf_dir):
    s = build.silver(spark, sf_dir)
    return s.select("aircraft_id", "position_timestamp", "on_ground", "altitude_baro", "vertical_rate",
                    cat.flight_behavior().alias("flight_behavior"))


@register("altitude_tier", sql(
    f"SELECT {STG_ID}, on_ground, altitude_baro, {altitude_case()} AS altitude_tier FROM stg", "stg"))
def q_altitude_tier(spark, sf_dir):
    s = build.silver(spark, sf_dir)
    return s.select("aircraft_id", "position_timestamp", "on_ground", "altitude_baro",
                    cat.altitude_tier().alias("altitude_tier"))


@register("speed_tier", sql(
    f"SELECT {STG_ID}, on_ground, speed_kmh, {speed_case()} AS speed_tier FROM stg", "stg"))
def q_speed_tier(spark, sf_dir):
    s = build.silver(spark, sf_dir)
    return s.select("aircraft_id", "position_timestamp", "on_ground", "speed_kmh",
                    cat.speed_tier().alias("speed_tier"))


_COUNTRY = "coalesce(origin_country, 'Desconhecido')"


@register("aircraft_category", sql(
    f"SELECT {STG_ID}, {_COUNTRY} AS origin_country, CASE WHEN {_COUNTRY} = 'Brazil' THEN 'Nacional' "
    f"WHEN {_COUNTRY} = 'Desconhecido' THEN 'Não Identificado' ELSE 'Estrangeiro' END AS aircraft_category "
    "FROM stg", "stg"))
def q_aircraft_category(spark, sf_dir):
    s = build.silver(spark, sf_dir)
    c = F.coalesce("origin_country", F.lit(K.UNKNOWN_COUNTRY))
    return s.select("aircraft_id", "position_timestamp", c.alias("origin_country"),
                    cat.aircraft_category(c).alias("aircraft_category"))


@register("continent", sql(
    f"SELECT {STG_ID}, {_COUNTRY} AS origin_country, {_continent_case(_COUNTRY)} AS continent FROM stg", "stg"))
def q_continent(spark, sf_dir):
    s = build.silver(spark, sf_dir)
    c = F.coalesce("origin_country", F.lit(K.UNKNOWN_COUNTRY))
    return s.select("aircraft_id", "position_timestamp", c.alias("origin_country"),
                    cat.continent(c).alias("continent"))


@register("day_period", sql(f"SELECT flight_pk, hour_24, {period_case('hour_24')} AS day_period FROM fct", "fct"))
def q_day_period(spark, sf_dir):
    f = build.gold_fact(spark, sf_dir)
    return f.select("flight_pk", "hour_24", cat.day_period("hour_24").alias("day_period"))


@register("aviation_units", sql(
    f"SELECT {STG_ID}, altitude_baro * {K.FEET_PER_METRE} AS altitude_baro, speed_kmh * {K.KMH_PER_MS} AS speed_kmh, "
    f"vertical_rate * {K.FPM_PER_MS} AS vertical_rate FROM stg", "stg"))
def q_aviation_units(spark, sf_dir):
    s = build.silver(spark, sf_dir).select("aircraft_id", "position_timestamp", "altitude_baro", "speed_kmh",
                                           "vertical_rate")
    return to_aviation_units(s)


# ----------------------------------------------------------------- P17-P19 over orders
@register("calendar_parts", sql(
    "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year_num, "
    "'Q' || CAST(quarter(o_orderdate) AS VARCHAR) AS quarter_name, CAST(month(o_orderdate) AS INTEGER) AS month_num, "
    "CAST(day(o_orderdate) AS INTEGER) AS day_num FROM orders"))
def q_calendar_parts(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    d = F.col("o_orderdate")
    return o.select("o_orderkey", F.year(d).alias("year_num"), cal.quarter_name(d).alias("quarter_name"),
                    F.month(d).alias("month_num"), F.dayofmonth(d).alias("day_num"))


@register("us_week", sql(f"SELECT o_orderkey, o_orderdate, {us_week_sql('o_orderdate')} AS week_of_year FROM orders"))
def q_us_week(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_orderdate", cal.us_week("o_orderdate").alias("week_of_year"))


@register("day_of_week", sql(
    "SELECT o_orderkey, o_orderdate, CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS day_of_week_num FROM orders"))
def q_day_of_week(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_orderdate", F.dayofweek("o_orderdate").alias("day_of_week_num"))


# ----------------------------------------------------------------- J1-J3, P22
_GEO_SQL = sql(
    "SELECT s.aircraft_id, s.position_timestamp, s.latitude, s.longitude, a.airport_code FROM stg s "
    "LEFT JOIN airports a ON s.latitude BETWEEN a.lat_min - 0.005 AND a.lat_max + 0.005 "
    "AND s.longitude BETWEEN a.lon_min - 0.005 AND a.lon_max + 0.005", "stg", "airports")


def _points(spark, sf_dir):
    return build.silver(spark, sf_dir).select("aircraft_id", "position_timestamp", "latitude", "longitude")


@register("geofence_join", _GEO_SQL)
def q_geofence_join(spark, sf_dir):
    return geo.geofence_join(_points(spark, sf_dir), dims.dim_airports(spark), strategy="nested_loop",
                             n_boxes=dims.N_AIRPORTS)


@register("geofence_join_grid", _GEO_SQL)
def q_geofence_join_grid(spark, sf_dir):
    return geo.geofence_join_grid(_points(spark, sf_dir), dims.dim_airports(spark))


# boxes of very unequal size that overlap, one per nation
_BOXES_SQL = """SELECT concat('N', CAST(n_nationkey AS VARCHAR)) AS code, lat AS lat_min, lat + ext AS lat_max,
  lon AS lon_min, lon + ext AS lon_max FROM (SELECT n_nationkey, CAST(-23.85 AS DOUBLE) + n_nationkey * CAST(0.037 AS DOUBLE) AS lat,
  CAST(-47.35 AS DOUBLE) + n_nationkey * CAST(0.04 AS DOUBLE) AS lon,
  CASE WHEN n_nationkey % 6 = 0 THEN CAST(0.4 AS DOUBLE) ELSE CAST(0.03 AS DOUBLE) END AS ext FROM nation)"""
_INSIDE = ("t.latitude BETWEEN b.lat_min - CAST(0.005 AS DOUBLE) AND b.lat_max + CAST(0.005 AS DOUBLE) "
           "AND t.longitude BETWEEN b.lon_min - CAST(0.005 AS DOUBLE) AND b.lon_max + CAST(0.005 AS DOUBLE)")


def _nation_boxes(spark, sf_dir):
    read_table(spark, sf_dir, "nation").createOrReplaceTempView("nation")
    return spark.sql(_BOXES_SQL.replace("VARCHAR", "STRING"))


@register("geofence_join_first", sql(
    f"SELECT t.event_id, min(b.code) AS code FROM telemetry t LEFT JOIN ({_BOXES_SQL}) b ON {_INSIDE} GROUP BY t.event_id",
    "telemetry"))
def q_geofence_join_first(spark, sf_dir):
    points = telemetry.telemetry(spark, sf_dir).select("event_id", "latitude", "longitude")
    return geo.geofence_join(points, _nation_boxes(spark, sf_dir), multi="first", keep=["code"]).select("event_id", "code")


_OVERLAP_SQL = sql(f"SELECT t.event_id, b.code FROM telemetry t LEFT JOIN ({_BOXES_SQL}) b ON {_INSIDE}", "telemetry")


@register("geofence_overlap_all", _OVERLAP_SQL)
def q_geofence_overlap_all(spark, sf_dir):
    points = telemetry.telemetry(spark, sf_dir).select("event_id", "latitude", "longitude")
    return geo.geofence_join(points, _nation_boxes(spark, sf_dir), keep=["code"], nested_loop_max=25).select("event_id", "code")


@register("geofence_overlap_grid", _OVERLAP_SQL)
def q_geofence_overlap_grid(spark, sf_dir):
    points = telemetry.telemetry(spark, sf_dir).select("event_id", "latitude", "longitude")
    return geo.geofence_join_grid(points, _nation_boxes(spark, sf_dir), keep=["code"]).select("event_id", "code")


@register("star_join", sql("SELECT * FROM star", "star"))
def q_star_join(spark, sf_dir):
    return build.gold_star(spark, sf_dir)


@register("star_join_geo", sql(
    "SELECT c.c_custkey, c.c_name, c.c_acctbal, n.n_name, r.r_name FROM customer c "
    "LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"))
def q_star_join_geo(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal",
                                                      F.col("c_nationkey").alias("n_nationkey"))
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", F.col("n_regionkey").alias("r_regionkey"))
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    out = lookup_join(lookup_join(c, n, "n_nationkey"), r, "r_regionkey")
    return out.select("c_custkey", "c_name", "c_acctbal", "n_name", "r_name")


@register("slice_star", sql(
    "SELECT * FROM star WHERE origin_country = 'Brazil' AND aircraft_category = 'Nacional' "
    "AND airport_code IN ('GRU', 'CGH')", "star"))
def q_slice_star(spark, sf_dir):
    return slice_df(build.gold_star(spark, sf_dir), origin_country="Brazil", aircraft_category="Nacional",
                    airport_code=["GRU", "CGH"])


# ----------------------------------------------------------------- W1, W2, A6, O3
@register("dedup_latest", sql("SELECT * FROM stg", "stg"))
def q_dedup_latest(spark, sf_dir):
    typed = clean.typed_telemetry(telemetry.bronze(spark, sf_dir))
    return dedup_latest(typed, staging.SILVER_KEY, order_by="inserted_at", tie_break="id_surrogate")


_LINE_TIES = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus"]


@register("dedup_latest_lineitem", sql(
    "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY "
    "l_shipdate DESC NULLS LAST, " + ", ".join(f"{c} DESC NULLS LAST" for c in _LINE_TIES) +
    ") AS rn FROM lineitem) WHERE rn = 1"))
def q_dedup_latest_lineitem(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return dedup_latest(li, ["l_orderkey", "l_linenumber"], order_by="l_shipdate", tie_break=_LINE_TIES)


@register("dim_aircrafts", sql("SELECT * FROM dim_aircrafts", "dim_aircrafts"))
def q_dim_aircrafts(spark, sf_dir):
    return dims.dim_aircrafts(build.silver(spark, sf_dir))


@register("dim_aircrafts_ranked", sql("SELECT * FROM dim_aircrafts", "dim_aircrafts"))
def q_dim_aircrafts_ranked(spark, sf_dir):
    return dims.dim_aircrafts_ranked(build.silver(spark, sf_dir))


@register("dim_calendar", sql("SELECT * FROM dim_calendar", "dim_calendar"))
def q_dim_calendar(spark, sf_dir):
    return dims.dim_calendar(build.silver(spark, sf_dir))


@register("dim_calendar_orders", sql(f"SELECT DISTINCT {calendar_cols('o_orderdate')} FROM orders"))
def q_dim_calendar_orders(spark, sf_dir):
    return dims.dim_calendar(read_table(spark, sf_dir, "orders"), ts_col="o_orderdate")


@register("dim_airports", sql(
    "SELECT * FROM airports a WHERE EXISTS (SELECT 1 FROM fct f WHERE f.airport_code = a.airport_code)", "fct"))
def q_dim_airports(spark, sf_dir):
    # The dimension itself is a constant; registered as the rows the fact
    # references (a semi join), so the query reads the data it describes.
    f = build.gold_fact(spark, sf_dir).select("airport_code")
    return dims.dim_airports(spark).join(f, "airport_code", "left_semi").select(
        "region", "state", "city", "airport_code", "airport_name", "lat_min", "lat_max", "lon_min", "lon_max")


@register("union_all", sql(
    "SELECT 'customer' AS party_type, c_custkey AS party_key, c_name AS party_name, c_nationkey AS nation_key, "
    "c_acctbal AS acctbal FROM customer UNION ALL "
    "SELECT 'supplier' AS party_type, s_suppkey AS party_key, s_name AS party_name, s_nationkey AS nation_key, "
    "s_acctbal AS acctbal FROM supplier"))
def q_union_all(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer").select(
        F.lit("customer").alias("party_type"), F.col("c_custkey").alias("party_key"),
        F.col("c_name").alias("party_name"), F.col("c_nationkey").alias("nation_key"),
        F.col("c_acctbal").alias("acctbal"))
    s = read_table(spark, sf_dir, "supplier").select(
        F.col("s_acctbal").alias("acctbal"), F.col("s_name").alias("party_name"),
        F.lit("supplier").alias("party_type"), F.col("s_suppkey").alias("party_key"),
        F.col("s_nationkey").alias("nation_key"))
    return c.unionByName(s)

