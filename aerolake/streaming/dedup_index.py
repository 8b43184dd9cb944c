"""Streamed deduplication behind a membership index.

Every key hashes to a bucket of its day and to a bit in that bucket's bitmap, of which
the words of 64 bits that are not zero are stored, each with the batches that set bits
of it: a day of few keys has few words.  A batch probes the words of its days first: a
key whose bit is not set has not been seen, and only for buckets of which some key may
have been are stored keys read, those of the batches that set their words.  New keys
are appended under the batch's id, in order of day and bucket, in files cut by size
alone, and their bits united with the stored words; no stored key is rewritten.  Late
rows are never dropped, and no state is held between batches.

A retried batch replaces its own keys: those are left out when it looks for stored
ones, so bits that its first try had set already send it to the stored keys of other
batches at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake import snapshots, storage

BUCKETS = 4             # of a day
WORDS = 8_192           # words of 64 bits of a bucket's bitmap
INDEX = "bucket int, word int, bits bigint, batches array<bigint>, key_date date"


def _keys_path(path: str) -> str:
    return f"{path.rstrip('/')}/keys"


def _index_path(path: str) -> str:
    return f"{path.rstrip('/')}/index"


def bit_of(bits: str, position: str) -> Column:
    """Whether a bit of a binary bitmap (``bitmap_construct_agg``) is set (NULL bitmap: no)."""
    byte = F.conv(F.hex(F.substring(F.col(bits), F.floor(F.col(position) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(byte.bitwiseAND(F.pow(F.lit(2), F.col(position) % 8).cast("int")) != 0, F.lit(False))


def keyed(df: DataFrame, keys: list[str], ts_col: str) -> DataFrame:
    """Distinct keys of ``df`` with their day, bucket, word and bit."""
    h = F.xxhash64(*[F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys])
    slot = F.pmod(F.shiftrightunsigned("__h", 8), F.lit(WORDS * 64))
    return (df.select(*keys, F.to_date(ts_col).alias("key_date")).distinct().withColumn("__h", h)
            .withColumn("bucket", F.pmod("__h", F.lit(BUCKETS)).cast("int"))
            .withColumn("word", F.floor(slot / 64).cast("int")).withColumn("bit", (slot % 64).cast("int")).drop("__h"))


def _stored_keys(spark: SparkSession, path: str, schema: T.StructType, places: DataFrame, batches: list[int], days) -> DataFrame:
    """The keys of the named batches in ``places`` (key_date, bucket); ``days``: their
    first and last day and whether one is NULL, for which row groups are read."""
    folders = [f"{_keys_path(path)}/batch_id={n}" for n in batches]
    folders = [f for f in folders if storage.path_exists(spark, f)]
    if not folders:
        return spark.createDataFrame([], schema)
    first, last, untimed = days
    within = F.col("key_date").between(F.lit(first), F.lit(last))
    rows = spark.read.schema(T.StructType(schema.fields).add("bucket", T.IntegerType())).parquet(*folders).where(
        within | F.col("key_date").isNull() if untimed else within)
    places = places.select(F.col("key_date").alias("__day"), F.col("bucket").alias("__bucket"))
    return rows.join(F.broadcast(places), F.col("key_date").eqNullSafe(F.col("__day")) & (F.col("bucket") == F.col("__bucket")),
                     "left_semi").select(*schema.names)


def add_keys(spark: SparkSession, path: str, df: DataFrame, keys: list[str], ts_col: str, batch_id: int) -> dict:
    """Append the keys of ``df`` that are not stored; returns how many were new, how
    many may have been seen by the index, and how many buckets were read for them."""
    held = []

    def hold(frame: DataFrame) -> DataFrame:
        held.append(frame.persist())
        return held[-1]

    try:
        names, place = [*keys, "key_date"], ["key_date", "bucket", "word"]
        rows = hold(keyed(df, keys, ts_col))
        days = snapshots.partition_names(spark, rows, ["key_date"])
        if not days:
            return {"new": 0, "maybe": 0, "buckets_read": 0}
        known = snapshots.exists(spark, _index_path(path))
        index = (snapshots.read(spark, _index_path(path), partitions=days) if known else spark.createDataFrame([], INDEX)).select(
            *place, "bits", "batches")
        other = index.toDF(*[f"__{c}" for c in place], "bits", "batches")
        is_set = F.coalesce(F.expr("shiftrightunsigned(bits, bit) & 1") == 1, F.lit(False))
        probed = hold(rows.join(other, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in place], "left").select(
            *rows.columns, is_set.alias("maybe"), "batches"))
        suspects = probed.where("maybe")
        places = suspects.groupBy("key_date", "bucket").agg(F.count(F.lit(1)).alias("n"))
        read = places.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.min("key_date"), F.max("key_date"),
                          F.count_if(F.col("key_date").isNull())).first()
        others = [r[0] for r in suspects.select(F.explode("batches").alias("b")).distinct().where(F.col("b") != batch_id).collect()]
        stored = _stored_keys(spark, path, rows.select(*names).schema, places, sorted(others), read[2:])
        stored = stored.select(*[F.col(c).alias(f"__{c}") for c in names])
        seen = suspects.join(stored, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in names], "left_anti")
        new = hold(probed.where("not maybe").unionByName(seen).drop("maybe", "batches"))
        (new.drop("word", "bit").hint("rebalance", "key_date", "bucket").sortWithinPartitions("key_date", "bucket")
         .write.mode("overwrite").parquet(f"{_keys_path(path)}/batch_id={batch_id}"))
        n_new = new.count()
        if n_new:
            fresh = new.groupBy(*place).agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).withColumn(
                "batches", F.array(F.lit(batch_id).cast("bigint")))
            merged = index.unionByName(fresh).groupBy(*place).agg(
                F.bit_or("bits").alias("bits"), F.array_distinct(F.flatten(F.collect_list("batches"))).alias("batches"))
            snapshots.replace_partitions(spark, _index_path(path), merged.select("bucket", "word", "bits", "batches", "key_date"),
                                         "key_date")
        return {"new": n_new, "maybe": read[0], "buckets_read": read[1]}
    finally:
        for frame in held:
            frame.unpersist()


def indexed_dedup_writer(path: str, keys, ts_col: str, stats: list | None = None) -> Callable:
    """foreachBatch body: the distinct ``keys`` seen so far, appended below ``path``."""
    keys = [keys] if isinstance(keys, str) else list(keys)

    def fn(df: DataFrame, batch_id: int):
        done = add_keys(df.sparkSession, path, df, keys, ts_col, batch_id)
        if stats is not None:
            stats.append(done)
    return fn


def read_keys(spark: SparkSession, path: str) -> DataFrame:
    """The distinct keys (with their ``key_date``)."""
    return spark.read.parquet(_keys_path(path)).drop("bucket", "batch_id")
