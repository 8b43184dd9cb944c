"""Gold fact: one row per signal, geofenced and categorised."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake import constants as K
from aerolake.functions.categorise import altitude_tier, flight_behavior, flight_status, speed_tier
from aerolake.functions.clean import MAX_ID_CHARS, signal_key
from aerolake.operators.geo import geofence_join

FACT_COLUMNS = ["flight_pk", "aircraft_id", "flight_date", "airport_code", "latitude", "longitude",
                "speed_kmh", "altitude_baro", "vertical_rate", "on_ground", "flight_status",
                "flight_behavior", "altitude_tier", "speed_tier", "ingestion_timestamp", "hour_24"]


def fct_flights(stg: DataFrame, airports: DataFrame, since=None, margin: float = K.GEOFENCE_MARGIN_DEG,
                strategy: str = "auto", multi: str = "all", n_airports: int | None = None,
                drop_untimed: bool = False, thresholds: dict | None = None, keep=()) -> DataFrame:
    """Fact rows from silver.

    ``since``: high-water mark; only rows with ``inserted_at > since`` are
    built (incremental run).  ``None`` = first/full build.
    Tiers and behaviour read the *raw* metrics (NULL falls through the CASE),
    the stored metrics are NULL -> 0, as published.  ``keep``: silver columns
    to carry along (an upsert orders versions by them).
    """
    th = thresholds or {}
    s = stg.select("aircraft_id", "position_timestamp", "latitude", "longitude", "speed_kmh",
                   "altitude_baro", "vertical_rate", "on_ground", "inserted_at", *keep)
    if since is not None:
        s = s.filter(F.col("inserted_at") > F.lit(since))
    if drop_untimed:
        s = s.filter(F.col("position_timestamp").isNotNull())
    j = geofence_join(s, airports, margin=margin, keep=["airport_code"], strategy=strategy,
                      multi=multi, n_boxes=n_airports)
    aid = F.left(F.col("aircraft_id"), F.lit(MAX_ID_CHARS))
    return j.select(
        signal_key(aid, "position_timestamp").alias("flight_pk"),
        aid.alias("aircraft_id"),
        F.to_date("position_timestamp").alias("flight_date"),
        F.coalesce(F.col("airport_code"), F.lit(K.UNKNOWN_AIRPORT)).alias("airport_code"),
        "latitude", "longitude",
        F.coalesce("speed_kmh", F.lit(0.0)).alias("speed_kmh"),
        F.coalesce("altitude_baro", F.lit(0.0)).alias("altitude_baro"),
        F.coalesce("vertical_rate", F.lit(0.0)).alias("vertical_rate"),
        "on_ground",
        flight_status("on_ground").alias("flight_status"),
        flight_behavior("on_ground", "altitude_baro", "vertical_rate",
                        **{k: v for k, v in th.items() if k in ("cruise_altitude", "climb_rate", "descent_rate")}
                        ).alias("flight_behavior"),
        altitude_tier("on_ground", "altitude_baro").alias("altitude_tier"),
        speed_tier("on_ground", "speed_kmh").alias("speed_tier"),
        F.col("inserted_at").alias("ingestion_timestamp"),
        F.hour("position_timestamp").alias("hour_24"), *keep,
    )
