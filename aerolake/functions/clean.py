"""Cleaning and typing of state-vector columns (Column -> Column, JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.constants import UNKNOWN_COUNTRY

MAX_ID_CHARS = 50
EPOCH_NTZ_TEXT = "1970-01-01 00:00:00"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def normalise_id(col) -> Column:
    """upper(trim(id)) cut to 50 characters (the varchar(50) cast)."""
    return F.left(F.upper(F.trim(_c(col))), F.lit(MAX_ID_CHARS))


def normalise_callsign(col) -> Column:
    """Callsign without '-', trimmed, upper-cased, at most 50 characters."""
    return F.left(F.upper(F.trim(F.replace(_c(col), F.lit("-"), F.lit("")))), F.lit(MAX_ID_CHARS))


def trim_text(col) -> Column:
    return F.trim(_c(col))


def epoch_to_ts(col) -> Column:
    """Epoch seconds -> TIMESTAMP_NTZ (UTC wall clock), independent of the
    session time zone: seconds added to the NTZ epoch."""
    return F.timestamp_add("SECOND", _c(col).cast("bigint"), F.lit(EPOCH_NTZ_TEXT).cast("timestamp_ntz"))


def ts_text(ts_col) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a TIMESTAMP_NTZ without any time-zone
    conversion (``date_format`` would pass through the session zone and
    shift wall-clock times that fall in a DST gap)."""
    return F.substring_index(_c(ts_col).cast("timestamp_ntz").cast("string"), ".", 1)


def signal_key(id_col, ts_col) -> Column:
    """``<id>-yyyy-MM-dd HH:mm:ss``; NULL when either part is NULL (concat,
    not concat_ws, which would skip the NULL)."""
    return F.concat(_c(id_col), F.lit("-"), ts_text(ts_col))


def silver_key(id_col, ts_col) -> Column:
    """Like ``signal_key`` but never NULL: equal keys mean equal ids and equal
    seconds, a missing part being equal to a missing part only."""
    return F.to_json(F.array(_c(id_col), ts_text(ts_col)))


def ntz_to_instant(col) -> Column:
    """TIMESTAMP_NTZ read as UTC wall clock -> TIMESTAMP instant, with no
    dependence on the session time zone: the wall-clock fields are rebuilt
    with an explicit UTC zone (``timestamp_diff`` on NTZ would pass through
    the session zone and fold a DST-gap hour into the next one)."""
    c = _c(col)
    return F.make_timestamp(F.year(c), F.month(c), F.dayofmonth(c), F.hour(c), F.minute(c),
                            F.date_part(F.lit("SECOND"), c), F.lit("UTC"))


def instant_to_ntz(col) -> Column:
    """Inverse of ``ntz_to_instant``."""
    epoch = F.lit(EPOCH_NTZ_TEXT).cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(col)), epoch)


def to_date_col(ts_col) -> Column:
    return F.to_date(_c(ts_col))


def hour_of(ts_col) -> Column:
    return F.hour(_c(ts_col))


def drop_null_coords(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    return df.dropna(subset=[lat, lon])


def default_nulls(df: DataFrame, defaults: dict) -> DataFrame:
    """Replace NULLs per column: ``{"speed_kmh": 0.0, ...}`` via coalesce,
    keeping the column's position and type."""
    cols = []
    for name in df.columns:
        if name in defaults:
            cols.append(F.coalesce(F.col(name), F.lit(defaults[name]).cast(df.schema[name].dataType)).alias(name))
        else:
            cols.append(F.col(name))
    return df.select(*cols)


METRIC_DEFAULTS = {"speed_kmh": 0.0, "altitude_baro": 0.0, "vertical_rate": 0.0}
COUNTRY_DEFAULT = {"origin_country": UNKNOWN_COUNTRY}


def typed_telemetry(df: DataFrame) -> DataFrame:
    """Cleaned and typed silver columns from bronze rows (no dedup).

    Casts use ``try_cast`` so a malformed value becomes NULL instead of
    failing the batch under ANSI mode.  No unit conversion: ``speed_kmh``
    keeps the delivered value (see ``functions.units`` for the opt-in).
    """
    return df.select(
        normalise_id("icao24").alias("aircraft_id"),
        normalise_callsign("callsign").alias("flight_number"),
        F.col("id_surrogate").try_cast("bigint").alias("id_surrogate"),
        trim_text("origin_country").alias("origin_country"),
        epoch_to_ts("time_position").alias("position_timestamp"),
        F.col("longitude").try_cast("double").alias("longitude"),
        F.col("latitude").try_cast("double").alias("latitude"),
        F.col("baro_altitude").try_cast("double").alias("altitude_baro"),
        F.col("velocity").try_cast("double").alias("speed_kmh"),
        F.col("vertical_rate").try_cast("double").alias("vertical_rate"),
        F.col("on_ground").try_cast("boolean").alias("on_ground"),
        F.col("processing_date").try_cast("timestamp_ntz").alias("processing_date"),
        F.col("inserted_at"),
    )
