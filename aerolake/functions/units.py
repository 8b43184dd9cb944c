"""Opt-in conversion of delivered SI units to the aviation units the tier
thresholds are written in (the marts keep the delivered values by default)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.constants import FEET_PER_METRE, FPM_PER_MS, KMH_PER_MS


def to_aviation_units(df: DataFrame, altitude: str = "altitude_baro", speed: str = "speed_kmh",
                      vrate: str = "vertical_rate") -> DataFrame:
    """metres -> feet, m/s -> km/h, m/s -> ft/min, in place (same names)."""
    return (df.withColumn(altitude, F.col(altitude) * F.lit(FEET_PER_METRE))
              .withColumn(speed, F.col(speed) * F.lit(KMH_PER_MS))
              .withColumn(vrate, F.col(vrate) * F.lit(FPM_PER_MS)))
