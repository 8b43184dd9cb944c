"""Model dependency order: bronze -> silver -> dimensions -> fact -> star.

Plain functions over DataFrames; the lazy plan carries the order.  Silver
feeds three models (fact, aircraft, calendar) whose plans differ after
pruning, so Spark cannot reuse the dedup shuffle between them.
``build_star`` therefore writes silver once as Parquet in the shared folder:
the lineage is cut, and each model reads only the columns it needs with its
filters pushed down.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from aerolake.operators.star import star
from aerolake.plans import dims, fact, staging, telemetry
from aerolake.session import fresh_path
from aerolake.storage import replace_table


@dataclass
class StarBuild:
    stg: DataFrame
    airports: DataFrame
    aircrafts: DataFrame
    calendar: DataFrame
    fct: DataFrame

    def star(self, *dimensions: str) -> DataFrame:
        """The fact joined to the named dimensions (aircrafts, airports,
        calendar; all without names)."""
        names = dimensions or ("aircrafts", "airports", "calendar")
        return star(self.fct, **{n: getattr(self, n) for n in names})


def build_star(spark: SparkSession, raw: DataFrame, since=None, materialize: bool = True) -> StarBuild:
    stg = staging.stg_flights(raw)
    if materialize:
        stg = replace_table(stg, f"{fresh_path(spark, 'silver')}/stg_flights")
    airports = dims.dim_airports(spark)
    return StarBuild(
        stg=stg,
        airports=airports,
        aircrafts=dims.dim_aircrafts(stg),
        calendar=dims.dim_calendar(stg),
        fct=fact.fct_flights(stg, airports, since=since, n_airports=dims.N_AIRPORTS),
    )


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_flights(telemetry.bronze(spark, sf_dir))


def gold_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact.fct_flights(silver(spark, sf_dir), dims.dim_airports(spark), n_airports=dims.N_AIRPORTS)


def gold_star(spark: SparkSession, sf_dir: str, *dimensions: str) -> DataFrame:
    return build_star(spark, telemetry.bronze(spark, sf_dir)).star(*dimensions)
