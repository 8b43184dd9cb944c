"""Flight-shaped bronze rows derived from the ``events`` table.

The registered tables hold no flights, so every telemetry query reads this
pure per-row projection of ``events`` (no shuffle, no state: it scales with
``events`` and keeps its partitioning).  Three consecutive events share one
(aircraft, second) key so deduplication matters; ids differ in case and
padding; metrics carry NULLs; ranges reach every CASE branch.

``TELEMETRY_SQL`` is the same projection spelled for the SQL oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.sources.tables import read_table

# FIXED VALUES: the per-row projection, one SQL expression per column (the
# Spark side runs them with ``selectExpr``, the oracle inside TELEMETRY_SQL).
TELEMETRY_K = "cast((event_id - event_id % 3) / 3 AS BIGINT) AS k"
TELEMETRY_EXPRS = [
    "event_id",
    "CASE WHEN event_id % 2 = 0 THEN concat('e4', lpad(cast(k % 400 AS STRING), 4, '0')) "
    "ELSE concat(' E4', lpad(cast(k % 400 AS STRING), 4, '0')) END AS icao24",
    "concat(' tam-', cast(event_id % 1000 AS STRING), '  ') AS callsign",
    "CASE WHEN event_id % 10 = 0 THEN NULL ELSE CASE k % 8 WHEN 0 THEN 'Argentina' WHEN 1 THEN 'United States' "
    "WHEN 2 THEN 'Spain' WHEN 3 THEN 'Japan' ELSE 'Brazil' END END AS origin_country",
    "1704067200 + k * 777 AS time_position",
    "-46.2 - cast((event_id * 53) % 1100 AS DOUBLE) / 1000 AS longitude",
    "-22.9 - cast((event_id * 37) % 900 AS DOUBLE) / 1000 AS latitude",
    "CASE WHEN event_id % 7 = 0 THEN NULL ELSE cast((event_id * 91) % 40000 AS DOUBLE) END AS baro_altitude",
    "CASE WHEN event_id % 5 = 0 THEN true ELSE false END AS on_ground",
    "CASE WHEN event_id % 11 = 0 THEN NULL ELSE cast((event_id * 17) % 1000 AS DOUBLE) END AS velocity",
    "CASE WHEN event_id % 13 = 0 THEN NULL ELSE cast((event_id * 29) % 3001 AS DOUBLE) - 1500 END AS vertical_rate",
    "ts AS inserted_at",
]
TELEMETRY_SQL = ("SELECT " + ",\n  ".join(TELEMETRY_EXPRS)
                 + f"\nFROM (SELECT *, {TELEMETRY_K} FROM events)")


def telemetry_from_events(events: DataFrame) -> DataFrame:
    """Per-row projection of ``events`` (one ``selectExpr``; the expressions
    are the ones the oracle runs, so both sides derive the same rows)."""
    return events.selectExpr("event_id", "ts", TELEMETRY_K).selectExpr(*TELEMETRY_EXPRS)


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_from_events(read_table(spark, sf_dir, "events"))


def bronze_from_telemetry(tel: DataFrame) -> DataFrame:
    """Give telemetry the bronze columns the silver model reads: the event id
    stands in for the store's surrogate id, the load date is the insert date."""
    return tel.select("*", F.col("event_id").alias("id_surrogate"),
                      F.to_date("inserted_at").alias("processing_date"))


BRONZE_SQL_COLUMNS = "*, event_id AS id_surrogate, cast(inserted_at AS DATE) AS processing_date"


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze_from_telemetry(telemetry(spark, sf_dir))
