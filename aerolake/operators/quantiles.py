"""Exact percentiles of all groups at once by histogram refinement.

A percentile is one or two order statistics.  The rows between the least and the
greatest value of a group fall in ``BINS`` bins; counts of the bins, combined
map-side, tell in which bin a wanted rank lies, and only the rows of such bins go on,
into bins of their own, until a bin holds one value.  So no task ever holds a group's
values, however many there are and however skewed the groups; the state of a pass is
one row a bin and wanted rank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aerolake.session import fresh_path

BINS = 4096


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def exact_percentiles(df: DataFrame, by: list[str], value: str, percentages: list[float], bins: int = BINS) -> DataFrame:
    """``by`` and, for each percentage p (0 to 1), column ``p<100p>``: the percentile
    with linear interpolation between the two nearest ranks.  NULL values don't count;
    a group without values has no row.  Every pass reads ``df``, so pass a stored one."""
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("__v"))
    same = lambda names: [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in names]     # noqa: E731
    named = lambda d: d.select(*[F.col(c).alias(f"__{c}") for c in by], *[c for c in d.columns if c not in by])     # noqa: E731
    span = _stored(rows.groupBy(*by).agg(F.count(F.lit(1)).alias("__n"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi")), "quantile-span")
    place = lambda p: F.lit(float(p)) * (F.col("__n") - 1)     # noqa: E731
    ranks = F.array_distinct(F.flatten(F.array(*[F.array(F.floor(place(p)), F.ceil(place(p))) for p in percentages])))
    open_ = _stored(span.select(*by, F.explode(ranks).alias("__rank"), "__lo", "__hi", F.lit(0).cast("bigint").alias("__before")), "quantile-ranks")
    found = None
    while True:
        ends = open_.where("__lo = __hi").select(*by, "__rank", F.col("__lo").alias("__value"))
        found = ends if found is None else found.unionByName(ends)
        open_ = open_.where("__lo < __hi")
        if open_.isEmpty():
            break
        ranges = named(open_.select(*by, "__lo", "__hi").distinct())
        inside = rows.join(ranges, [*same(by), F.col("__v").between(F.col("__lo"), F.col("__hi"))])
        share = (F.col("__v") - F.col("__lo")) / (F.col("__hi") - F.col("__lo"))
        cells = inside.groupBy(*by, "__lo", F.least(F.floor(share * bins), F.lit(bins - 1)).alias("__bin")).agg(
            F.count(F.lit(1)).alias("__c"), F.min("__v").alias("__min"), F.max("__v").alias("__max"))
        # at most ``bins`` rows a range
        upto = F.sum("__c").over(Window.partitionBy(*by, "__lo").orderBy("__bin"))
        cells = named(cells.select(*by, F.col("__lo").alias("__from"), "__c", "__min", "__max", upto.alias("__upto")))
        holds = (F.col("__lo") == F.col("__from")) & (F.col("__rank") - F.col("__before") < F.col("__upto")) & (
            F.col("__rank") - F.col("__before") >= F.col("__upto") - F.col("__c"))
        open_ = _stored(open_.join(cells, [*same(by), holds]).select(
            *by, "__rank", F.col("__min").alias("__lo"), F.col("__max").alias("__hi"),
            (F.col("__before") + F.col("__upto") - F.col("__c")).alias("__before")), "quantile-ranks")
    values = named(found.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("__rank", "__value"))).alias("__values")))
    out = span.join(values, same(by))
    columns = []
    for p in percentages:
        low, high = F.floor(place(p)), F.ceil(place(p))
        at = lambda rank: F.col("__values")[rank]     # noqa: E731
        columns.append(F.when(low == high, at(low)).otherwise(
            (high - place(p)) * at(low) + (place(p) - low) * at(high)).alias(f"p{round(100 * p)}"))
    return out.select(*by, *columns)
