"""Dimensions: airports (constant), aircraft (one row per id), calendar."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake import constants as K
from aerolake.functions.calendar import calendar_parts
from aerolake.functions.categorise import aircraft_category, continent
from aerolake.operators.dedup import dedup_latest

AIRPORT_DDL = ("region string, state string, city string, airport_code string, airport_name string, "
               "lat_min double, lat_max double, lon_min double, lon_max double")
N_AIRPORTS = len(K.AIRPORT_ROWS)


def _sql_text(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return f"CAST({v!r} AS DOUBLE)"


def dim_airports(spark: SparkSession) -> DataFrame:
    """The inline airport dimension: one inline table (a LocalRelation, no
    unions, no Python rows); bounds are DOUBLE so that edges compare equal in
    every engine."""
    names = ", ".join(f.split()[0] for f in AIRPORT_DDL.split(", "))
    rows = ", ".join("(" + ", ".join(_sql_text(v) for v in r) + ")" for r in K.AIRPORT_ROWS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS airports({names})")


def dim_aircrafts(stg: DataFrame, order: str = "name_desc") -> DataFrame:
    """One row per aircraft with its country, category and continent.

    ``order="name_desc"`` keeps the greatest country name after NULL ->
    'Desconhecido' (so 'Desconhecido' beats 'Brazil', as published);
    ``order="known_first"`` prefers any known country, then the greatest.
    Only one attribute is kept, so this is an aggregate, not a window.
    """
    country = F.coalesce(F.col("origin_country"), F.lit(K.UNKNOWN_COUNTRY))
    # max_by(c, c) is max(c); written so because Catalyst drops a distinct
    # below a plain max/min (duplicate-agnostic) and the hash pre-aggregation
    # would be lost.
    if order == "name_desc":
        picked = F.max_by("origin_country", "origin_country")
    elif order == "known_first":
        known = F.when(F.col("origin_country") != K.UNKNOWN_COUNTRY, F.col("origin_country"))
        picked = F.coalesce(F.max_by(known, known), F.lit(K.UNKNOWN_COUNTRY))
    else:
        raise ValueError(order)
    # distinct (aircraft, country) pairs first: a hash aggregate with map-side
    # partial results reduces the signals to a few pairs per aircraft, so the
    # string max (a sort-based aggregate in Spark) only sees that small set.
    pairs = stg.select("aircraft_id", country.alias("origin_country")).distinct()
    agg = pairs.groupBy("aircraft_id").agg(picked.alias("origin_country"))
    return agg.select(
        "aircraft_id", "origin_country",
        aircraft_category("origin_country").alias("aircraft_category"),
        continent("origin_country").alias("continent"),
    )


def dim_aircrafts_ranked(stg: DataFrame) -> DataFrame:
    """Same result as ``dim_aircrafts`` written as the rank-1 window (kept for
    parity tests of the two formulations)."""
    base = stg.select("aircraft_id", F.coalesce("origin_country", F.lit(K.UNKNOWN_COUNTRY)).alias("origin_country"))
    one = dedup_latest(base, "aircraft_id", order_by="origin_country")
    return one.select("aircraft_id", "origin_country",
                      aircraft_category("origin_country").alias("aircraft_category"),
                      continent("origin_country").alias("continent"))


def dim_calendar(df: DataFrame, ts_col: str = "position_timestamp") -> DataFrame:
    """Distinct calendar rows of the timestamps in ``df`` (one per date).

    ``distinct`` aggregates partially on the map side, so the shuffle carries
    at most (dates x map partitions) rows however many signals there are.
    """
    return df.select(*calendar_parts(F.col(ts_col))).distinct()


def merge_aircrafts(stored: DataFrame | None, fresh: DataFrame) -> DataFrame:
    """``dim_aircrafts`` over stored rows and new signals: the greatest name of
    both is the greatest of all signals."""
    rows = fresh.select("aircraft_id", "origin_country")
    return dim_aircrafts(rows if stored is None else rows.unionByName(stored.select("aircraft_id", "origin_country")))


def merge_calendar(stored: DataFrame | None, fresh: DataFrame) -> DataFrame:
    days = dim_calendar(fresh)
    return days if stored is None else days.unionByName(stored).distinct()
