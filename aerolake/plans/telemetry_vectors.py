"""Positional 17-value state vectors derived from the telemetry rows, used to
drive the ingest path (files, envelopes, messages) from the registered tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.sources.sinks import STATE_VECTOR_NAMES

SV_SQL_COLS = ("icao24, callsign, origin_country, time_position, time_position AS last_contact, longitude, "
               "latitude, baro_altitude, on_ground, velocity, CAST(NULL AS DOUBLE) AS heading, vertical_rate, "
               "CAST(NULL AS VARCHAR) AS sensors, CAST(NULL AS DOUBLE) AS geo_altitude, "
               "CAST(NULL AS VARCHAR) AS squawk, false AS spi, CAST(0 AS BIGINT) AS position_source")


def state_vectors(tel: DataFrame, keep=()) -> DataFrame:
    return tel.select(
        *keep,
        "icao24", "callsign", "origin_country", "time_position",
        F.col("time_position").alias("last_contact"), "longitude", "latitude", "baro_altitude",
        "on_ground", "velocity", F.lit(None).cast("double").alias("heading"), "vertical_rate",
        F.lit(None).cast("string").alias("sensors"), F.lit(None).cast("double").alias("geo_altitude"),
        F.lit(None).cast("string").alias("squawk"), F.lit(False).alias("spi"),
        F.lit(0).cast("bigint").alias("position_source"),
    ).select(*keep, *STATE_VECTOR_NAMES)
