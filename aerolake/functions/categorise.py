"""Categorisation of signals and aircraft (chained CASE, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from aerolake import constants as K


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _is_ground(on_ground) -> Column:
    # `on_ground = 1` is true only for TRUE; NULL falls through.
    return _c(on_ground) == F.lit(True)


def flight_status(on_ground="on_ground") -> Column:
    return F.when(_is_ground(on_ground), K.STATUS_GROUND).otherwise(K.STATUS_AIR)


def flight_behavior(on_ground="on_ground", altitude="altitude_baro", vrate="vertical_rate",
                    cruise_altitude=K.CRUISE_ALTITUDE, climb_rate=K.CLIMB_RATE,
                    descent_rate=K.DESCENT_RATE) -> Column:
    """First match wins: ground, cruise altitude, climb, descent, level.
    Pass the *un-defaulted* metric columns (NULL compares as unknown)."""
    return (F.when(_is_ground(on_ground), K.BEHAVIOR_GROUND)
            .when(_c(altitude) > cruise_altitude, K.BEHAVIOR_CRUISE)
            .when(_c(vrate) > climb_rate, K.BEHAVIOR_CLIMB)
            .when(_c(vrate) < descent_rate, K.BEHAVIOR_DESCENT)
            .otherwise(K.BEHAVIOR_LEVEL))


def altitude_tier(on_ground="on_ground", altitude="altitude_baro",
                  low_below=K.ALT_LOW_BELOW, mid_max=K.ALT_MID_MAX) -> Column:
    """NULL altitude in the air falls to the top tier."""
    alt = _c(altitude)
    return (F.when(_is_ground(on_ground), K.TIER_GROUND)
            .when(alt < low_below, K.ALT_LOW)
            .when(alt.between(low_below, mid_max), K.ALT_MID)
            .otherwise(K.ALT_HIGH))


def speed_tier(on_ground="on_ground", speed="speed_kmh",
               low_below=K.SPEED_LOW_BELOW, mid_max=K.SPEED_MID_MAX) -> Column:
    spd = _c(speed)
    return (F.when(_is_ground(on_ground), K.TIER_GROUND)
            .when(spd < low_below, K.SPEED_LOW)
            .when(spd.between(low_below, mid_max), K.SPEED_MID)
            .otherwise(K.SPEED_HIGH))


def aircraft_category(country="origin_country") -> Column:
    c = _c(country)
    return (F.when(c == K.HOME_COUNTRY, K.CATEGORY_NATIONAL)
            .when(c == K.UNKNOWN_COUNTRY, K.CATEGORY_UNKNOWN)
            .otherwise(K.CATEGORY_FOREIGN))


def continent(country="origin_country", mapping: dict | None = None,
              other: str = K.OTHER_CONTINENT) -> Column:
    """Country -> continent from a small fixed mapping, as one CASE over
    ``isin`` groups (no join, stays inside whole-stage codegen)."""
    mapping = mapping or K.CONTINENT_OF_COUNTRY
    groups: dict[str, list[str]] = {}
    for ctry, cont in mapping.items():
        groups.setdefault(cont, []).append(ctry)
    c = _c(country)
    expr = None
    for cont, countries in groups.items():
        cond = c.isin(countries)
        expr = F.when(cond, cont) if expr is None else expr.when(cond, cont)
    return expr.otherwise(other)


def day_period(hour_col="hour_24", periods=None, other: str = K.DAY_PERIOD_OTHER) -> Column:
    """Hour -> period of day; ``periods`` = [(label, first_hour, last_hour)]."""
    h = _c(hour_col)
    expr = None
    for label, lo, hi in periods or K.DAY_PERIODS:
        cond = h.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(other)
