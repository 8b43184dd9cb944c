"""The documented business questions over the gold fact / star.

Every question is an aggregate of the fact (partial aggregation before the
shuffle) followed, where a share or rank is asked, by a window over the
*aggregated* rows only: those are bounded by hours x airports x categories,
never by the number of signals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolake import constants as K
from aerolake.functions.categorise import day_period
from aerolake.operators.measures import active_aircraft_col, total_signals_col
from aerolake.operators.quantiles import exact_percentiles
from aerolake.session import fresh_path


def _r(col, digits=4):
    return F.round(col, digits)


def aircraft_per_hour(fact: DataFrame) -> DataFrame:                          # B1
    return (fact.groupBy("flight_date", "hour_24")
            .agg(active_aircraft_col(), total_signals_col())
            .withColumn("day_period", day_period("hour_24")))


def traffic_by_airport(fact: DataFrame) -> DataFrame:                         # B2
    return fact.groupBy("airport_code").agg(total_signals_col(), active_aircraft_col())


def approach_speed(fact: DataFrame) -> DataFrame:                             # B3
    return (fact.filter(F.col("flight_behavior") == K.BEHAVIOR_DESCENT)
            .groupBy("airport_code")
            .agg(_r(F.avg("speed_kmh")).alias("avg_speed"), F.count(F.lit(1)).alias("n_signals")))


def altitude_profile(star: DataFrame) -> DataFrame:                           # B4
    """Percentiles are exact and found by refinement over the stored columns, so a
    category's altitudes never meet in one task."""
    path = fresh_path(star.sparkSession, "altitudes")
    star.filter(F.col("flight_status") == K.STATUS_AIR).select("aircraft_category", "altitude_baro").write.parquet(path)
    air = star.sparkSession.read.parquet(path)
    by = ["aircraft_category"]
    spread = air.groupBy(*by).agg(
        F.min("altitude_baro").alias("min_altitude"),
        _r(F.avg("altitude_baro")).alias("avg_altitude"),
        F.max("altitude_baro").alias("max_altitude"),
        _r(F.stddev_samp("altitude_baro")).alias("std_altitude"),
        F.count(F.lit(1)).alias("n_signals"))
    ranked = exact_percentiles(air, by, "altitude_baro", [0.25, 0.5, 0.75])
    ranked = ranked.select(F.col("aircraft_category").alias("_category"), *[_r(f"p{q}").alias(f"p{q}_altitude") for q in (25, 50, 75)])
    return spread.join(ranked, F.col("aircraft_category").eqNullSafe(F.col("_category")), "left").drop("_category")


def peak_landing_takeoff(fact: DataFrame) -> DataFrame:                       # B5
    """Busiest hour per weekday for landings (descent) and take-offs (climb);
    the weekday follows from the date, no dimension is joined."""
    star = fact.withColumn("day_of_week_num", F.dayofweek("flight_date"))
    movement = (F.when(F.col("flight_behavior") == K.BEHAVIOR_DESCENT, "landing")
                .when(F.col("flight_behavior") == K.BEHAVIOR_CLIMB, "takeoff"))
    counts = (star.filter(F.col("flight_behavior").isin(K.BEHAVIOR_DESCENT, K.BEHAVIOR_CLIMB))
              .groupBy("day_of_week_num", movement.alias("movement"), "hour_24")
              .agg(F.count(F.lit(1)).alias("n_signals")))
    w = Window.partitionBy("day_of_week_num", "movement").orderBy(F.desc("n_signals"), F.asc("hour_24"))
    return counts.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")


def ground_share(fact: DataFrame) -> DataFrame:                               # B6
    ground = F.sum(F.when(F.col("on_ground") == F.lit(True), 1).otherwise(0))
    n = F.count(F.lit(1))
    return (fact.groupBy("hour_24")
            .agg(ground.alias("n_ground"), n.alias("n_signals"))
            .withColumn("ground_share", _r(F.col("n_ground") / F.col("n_signals")))
            .withColumn("air_share", _r(1 - F.col("n_ground") / F.col("n_signals"))))


def crossing_altitude(fact: DataFrame) -> DataFrame:                          # B7
    cross = fact.filter((F.col("airport_code") == K.UNKNOWN_AIRPORT) & (F.col("flight_status") == K.STATUS_AIR))
    return cross.groupBy("hour_24").agg(_r(F.avg("altitude_baro")).alias("avg_altitude"),
                                        F.count(F.lit(1)).alias("n_signals"))


def airport_share(fact: DataFrame) -> DataFrame:                              # B8
    per = fact.groupBy("airport_code").agg(active_aircraft_col())
    total = F.sum("active_aircraft").over(Window.partitionBy())
    return per.withColumn("share_pct", _r(F.col("active_aircraft") * 100.0 / total))


def fleet_share(aircrafts: DataFrame) -> DataFrame:                           # B9 (category)
    per = aircrafts.groupBy("aircraft_category").agg(F.count(F.lit(1)).alias("n_aircraft"))
    total = F.sum("n_aircraft").over(Window.partitionBy())
    return per.withColumn("share_pct", _r(F.col("n_aircraft") * 100.0 / total))


def fleet_countries(aircrafts: DataFrame) -> DataFrame:                       # B9 (long tail)
    per = aircrafts.groupBy("aircraft_category", "origin_country").agg(F.count(F.lit(1)).alias("n_aircraft"))
    total = F.sum("n_aircraft").over(Window.partitionBy())
    rank = F.row_number().over(Window.orderBy(F.desc("n_aircraft"), F.asc("origin_country")))
    return (per.withColumn("share_pct", _r(F.col("n_aircraft") * 100.0 / total))
               .withColumn("country_rank", rank))


def speed_altitude_corr(fact: DataFrame) -> DataFrame:                        # B10
    air = fact.filter(F.col("flight_status") == K.STATUS_AIR)
    return air.agg(_r(F.corr("speed_kmh", "altitude_baro")).alias("corr_speed_altitude"),
                   F.count(F.lit(1)).alias("n_signals"))


FAST_MIN_SPEED = 150.0      # delivered units (m/s); parameters, no published limits
LOW_MAX_ALTITUDE = 1500.0   # metres


def fast_low(fact: DataFrame, min_speed: float = FAST_MIN_SPEED,
             max_altitude: float = LOW_MAX_ALTITUDE) -> DataFrame:            # B11
    return (fact.filter((F.col("flight_status") == K.STATUS_AIR) & (F.col("speed_kmh") >= min_speed)
                        & (F.col("altitude_baro") < max_altitude))
            .select("flight_pk", "aircraft_id", "airport_code", "hour_24", "speed_kmh", "altitude_baro"))


def speed_by_airport(fact: DataFrame) -> DataFrame:                           # B12
    return fact.groupBy("airport_code").agg(_r(F.avg("speed_kmh")).alias("avg_speed"),
                                            F.count(F.lit(1)).alias("n_signals"))


def _hourly_active(fact: DataFrame) -> DataFrame:
    return fact.groupBy("hour_24").agg(active_aircraft_col())


def peak_hours(fact: DataFrame, k: int = 3) -> DataFrame:                     # B13
    """Top-k hours by unique aircraft (the limit is the feature; Spark plans
    TakeOrderedAndProject: a per-partition top-k, then a k-row merge)."""
    return _hourly_active(fact).orderBy(F.desc("active_aircraft"), F.asc("hour_24")).limit(k)


def idle_hours(fact: DataFrame, k: int = 3) -> DataFrame:                     # B13
    return _hourly_active(fact).orderBy(F.asc("active_aircraft"), F.asc("hour_24")).limit(k)
