"""Star lookups and slicing.

Dimension joins are many-to-one LEFT joins without hints: adaptive execution
measures a dimension's bytes at run time, broadcasts it only below its
threshold, and otherwise keeps a sort-merge join whose skewed partitions (an
aircraft or airport with a third of the rows) it splits.  The airports are an
inline constant, whose size the planner knows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup_join(fact: DataFrame, dim: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Many-to-one join of ``fact`` to ``dim`` on ``key`` (same name on both)."""
    return fact.join(dim, key, how)


def star(fact: DataFrame, aircrafts: DataFrame | None = None, airports: DataFrame | None = None,
         calendar: DataFrame | None = None) -> DataFrame:
    """Fact joined to the given dimensions; dimension attributes appended."""
    out = fact
    if aircrafts is not None:
        out = lookup_join(out, aircrafts, "aircraft_id")
    if airports is not None:
        out = lookup_join(out, airports.select("airport_code", "region", "state", "city", "airport_name"), "airport_code")
    if calendar is not None:
        out = lookup_join(out, calendar.select("flight_date", "year_num", "quarter_name", "month_num", "week_of_year",
                                               "day_num", "day_of_week_num"), "flight_date")
    return out


def slice_df(df: DataFrame, **predicates) -> DataFrame:
    """BI-style slicer: ``column=value`` or ``column=[values]`` filters, ANDed."""
    conds: list[Column] = []
    for col, val in predicates.items():
        if isinstance(val, (list, tuple, set)):
            conds.append(F.col(col).isin(list(val)))
        else:
            conds.append(F.col(col) == F.lit(val))
    return df.filter(reduce(lambda a, b: a & b, conds)) if conds else df
