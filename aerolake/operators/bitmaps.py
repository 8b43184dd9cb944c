"""Exact distinct counts that merge: bitmaps over a dense dictionary of ids.

Each id gets a number from 1 on (``dictionary``); a group's ids are one bitmap of
4 KB for each 32,768 numbers.  Bitmaps of hours unite to days, of leaves to roll-ups,
of stream batches to totals, without the ids: a count of the united bits is exact,
where counts can't be added and sketches estimate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake import storage
from aerolake.session import fresh_path
from aerolake.sources.sinks import with_dense_ids

BUCKET, BITS = "bucket", "bits"


def dictionary(ids: DataFrame, id_col: str, path: str | None = None, known: DataFrame | None = None) -> DataFrame:
    """(id_col, number) of the different ids of ``ids`` that ``known`` lacks, numbered
    after those; NULL is no id.

    The new ids are written first and numbered by their place in the files, so that
    no window runs over them; the result is written to ``path``."""
    spark = ids.sparkSession
    fresh = ids.select(id_col).where(F.col(id_col).isNotNull()).distinct()
    last = 0
    if known is not None:
        other = known.select(F.col(id_col).alias("__known"))
        fresh = fresh.join(other, F.col(id_col) == F.col("__known"), "left_anti")
        last = known.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]
    staged = fresh_path(spark, "new-ids")
    fresh.write.parquet(staged)
    path = path or fresh_path(spark, "dictionary")
    numbered = with_dense_ids(spark.read.schema(fresh.schema).parquet(staged), int(last) + 1, "number")
    numbered.write.mode("overwrite").parquet(path)
    storage.delete(spark, staged)
    return spark.read.schema(numbered.schema).parquet(path)


def group_bitmaps(df: DataFrame, by: list[str], id_col: str, numbers: DataFrame) -> DataFrame:
    """(by, bucket, bits): the ids of each group.  (group, id) pairs are made distinct
    map-side before they meet their numbers; a group of NULL ids alone has no bits."""
    pairs = df.select(*by, id_col).distinct()
    names = numbers.select(F.col(id_col).alias("__id"), "number")
    numbered = pairs.join(names, F.col(id_col) == F.col("__id"), "left")
    return numbered.groupBy(*by, F.bitmap_bucket_number("number").alias(BUCKET)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias(BITS))


def united(bitmaps: DataFrame, by: list[str]) -> DataFrame:
    """The bitmaps of coarser groups (or of several batches)."""
    return bitmaps.groupBy(*by, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def distinct_counts(bitmaps: DataFrame, by: list[str], name: str) -> DataFrame:
    """(by, name): the number of different ids of each group."""
    return united(bitmaps, by).groupBy(*by).agg(F.sum(F.bitmap_count(BITS)).cast("bigint").alias(name))


def batch_dictionary(spark: SparkSession, folder: str, ids: DataFrame, id_col: str, batch_id: int) -> DataFrame:
    """The dictionary kept below ``folder`` with the ids of one more batch: what this
    batch adds lies under its id, so a retried batch replaces its own addition.  One
    batch at a time (as a streaming query runs them)."""
    # a retry numbers what this batch added again; what other batches added stays as it is
    names = [n for n in storage.subfolders(spark, folder) if n != f"batch_id={batch_id}"]
    schema = ids.select(id_col).schema.add("number", T.LongType())
    known = spark.read.schema(schema).parquet(*[f"{folder}/{n}" for n in names]) if names else spark.createDataFrame([], schema)
    added = dictionary(ids, id_col, f"{folder}/batch_id={batch_id}", known)
    return known.unionByName(added.select(*known.columns))
