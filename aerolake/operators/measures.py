"""Measures of the semantic layer and hierarchy roll-ups.

All are single aggregations with map-side partial aggregation: a hot group
(one airport or hour holding a third of the signals) is pre-reduced on every
map task before the shuffle, so no task receives the raw rows of a group.
Distinct counts are exact by default (Spark plans them as a two-level
aggregate on (group, id), also partially aggregated); ``approx=True``
switches to HyperLogLog++ sketches for very large groupings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _distinct(col: str, approx: bool, rsd: float = 0.01) -> Column:
    return F.approx_count_distinct(col, rsd) if approx else F.count_distinct(F.col(col))


def total_signals_col() -> Column:
    return F.count("flight_pk").alias("total_signals")


def active_aircraft_col(approx: bool = False) -> Column:
    return _distinct("aircraft_id", approx).alias("active_aircraft")


def avg_speed_col(digits: int | None = 4) -> Column:
    a = F.avg("speed_kmh")
    return (F.round(a, digits) if digits is not None else a).alias("avg_speed")


def _grouped(fact: DataFrame, by):
    by = [by] if isinstance(by, str) else list(by or [])
    return fact.groupBy(*by) if by else fact.groupBy()


def total_signals(fact: DataFrame, by=None) -> DataFrame:
    return _grouped(fact, by).agg(total_signals_col())


def active_aircraft(fact: DataFrame, by=None, approx: bool = False) -> DataFrame:
    return _grouped(fact, by).agg(active_aircraft_col(approx))


def avg_speed(fact: DataFrame, by=None, digits: int | None = 4) -> DataFrame:
    return _grouped(fact, by).agg(avg_speed_col(digits))


def traffic_peak(fact: DataFrame, hour_keys=("flight_date", "hour_24"), approx: bool = False) -> DataFrame:
    """MAX over hours of the unique aircraft in that hour (two-level aggregate)."""
    per_hour = fact.groupBy(*hour_keys).agg(active_aircraft_col(approx))
    return per_hour.agg(F.max("active_aircraft").alias("traffic_peak"))


def high_water(df: DataFrame, col: str = "ingestion_timestamp") -> DataFrame:
    return df.agg(F.max(col).alias("high_water_mark"))


DEFAULT_MEASURES = ("total_signals", "active_aircraft", "avg_speed")


def _reduced(df: DataFrame, levels) -> DataFrame:
    """One row per finest level and aircraft: what the measures need of the
    signals, so that the Expand of a roll-up multiplies these rows only."""
    keys = list(dict.fromkeys([*levels, "aircraft_id"]))
    return df.groupBy(*keys).agg(F.count("flight_pk").alias("__n"), F.sum("speed_kmh").alias("__speed"),
                                 F.count("speed_kmh").alias("__n_speed"))


def _measure_cols(measures, approx: bool) -> list[Column]:
    """The measures over ``_reduced`` rows."""
    table = {"total_signals": F.sum("__n").alias("total_signals"), "active_aircraft": active_aircraft_col(approx),
             "avg_speed": F.round(F.sum("__speed") / F.sum("__n_speed"), 4).alias("avg_speed")}
    return [table[m] for m in measures]


def rollup_hierarchy(df: DataFrame, levels, measures=DEFAULT_MEASURES, approx: bool = False) -> DataFrame:
    """Drill path totals: one row per prefix of ``levels`` (ROLLUP) with
    ``grouping_level`` = grouping_id() (bit set = level rolled up)."""
    levels = list(levels)
    return _reduced(df, levels).rollup(*levels).agg(*_measure_cols(measures, approx),
                                                    F.grouping_id().alias("grouping_level"))


def grouping_sets_hierarchy(df: DataFrame, sets, columns, measures=DEFAULT_MEASURES,
                            approx: bool = False) -> DataFrame:
    """Branching drill paths (e.g. behaviour -> altitude tier | speed tier)."""
    sets = [[F.col(c) for c in s] for s in sets]
    return _reduced(df, columns).groupingSets(sets, *columns).agg(*_measure_cols(measures, approx),
                                                                  F.grouping_id().alias("grouping_level"))
