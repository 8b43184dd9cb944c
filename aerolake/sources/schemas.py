"""Contracts: the ordered state-vector schema and the other declared shapes."""

from __future__ import annotations

from pyspark.sql import types as T

# FIXED VALUES: positional state-vector contract, position i -> (name, type).
STATE_VECTOR_FIELDS = [
    ("icao24", T.StringType()),
    ("callsign", T.StringType()),
    ("origin_country", T.StringType()),
    ("time_position", T.LongType()),
    ("last_contact", T.LongType()),
    ("longitude", T.DoubleType()),
    ("latitude", T.DoubleType()),
    ("baro_altitude", T.DoubleType()),
    ("on_ground", T.BooleanType()),
    ("velocity", T.DoubleType()),
    ("heading", T.DoubleType()),
    ("vertical_rate", T.DoubleType()),
    ("sensors", T.StringType()),
    ("geo_altitude", T.DoubleType()),
    ("squawk", T.StringType()),
    ("spi", T.BooleanType()),
    ("position_source", T.LongType()),
]

STATE_VECTOR_SCHEMA = T.StructType(
    [T.StructField(name, dtype, True) for name, dtype in STATE_VECTOR_FIELDS])

STATE_VECTOR_WIDTH = len(STATE_VECTOR_FIELDS)

# Bronze adds the partition date, a surrogate id and the load timestamp.
BRONZE_EXTRA_FIELDS = [
    ("processing_date", T.DateType()),
    ("id_surrogate", T.LongType()),
    ("inserted_at", T.TimestampNTZType()),
]

# Poll envelope: {"time": epoch, "states": [[...17 values...], ...]}
POLL_ENVELOPE_SCHEMA = T.StructType([
    T.StructField("time", T.LongType(), True),
    T.StructField("states", T.ArrayType(T.ArrayType(T.StringType())), True),
])

# Arrivals/departures endpoint shape (declared, not used by the marts).
FLIGHT_LEG_SCHEMA = T.StructType([
    T.StructField("icao24", T.StringType(), True),
    T.StructField("firstSeen", T.IntegerType(), True),
    T.StructField("lastSeen", T.IntegerType(), True),
    T.StructField("estDepartureAirport", T.StringType(), True),
    T.StructField("estArrivalAirport", T.StringType(), True),
    T.StructField("callsign", T.StringType(), True),
    T.StructField("estDepartureAirportHorizDistance", T.IntegerType(), True),
    T.StructField("estDepartureAirportVertDistance", T.IntegerType(), True),
    T.StructField("estArrivalAirportHorizDistance", T.IntegerType(), True),
    T.StructField("estArrivalAirportVertDistance", T.IntegerType(), True),
    T.StructField("departureAirportCandidatesCount", T.IntegerType(), True),
    T.StructField("arrivalAirportCandidatesCount", T.IntegerType(), True),
])


def ordered_schema(fields) -> T.StructType:
    """Accept a StructType or a list of (name, DataType|ddl-string) pairs."""
    if isinstance(fields, T.StructType):
        return fields
    out = []
    for name, dtype in fields:
        if isinstance(dtype, str):
            dtype = T._parse_datatype_string(dtype)
        out.append(T.StructField(name, dtype, True))
    return T.StructType(out)
