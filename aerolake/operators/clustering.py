"""A fact laid out by place: files of near positions, and a map of their bounds.

Rows are range-partitioned and sorted by the interleaved bits of their coordinates
(a Z-order curve), so that a file covers a small area.  The bounds of every file are
kept beside the table; a box reads only the files whose bounds meet it, without
opening the others' footers.  Rows without a position lie together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS = 16               # of each coordinate: cells of 180 / 65,536 degrees of latitude


def _spread(cell: Column) -> Column:
    """The bits of a 16-bit number moved to the even places of a 32-bit one."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        cell = cell.bitwiseOR(F.shiftleft(cell, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
    return cell


def z_order(lat: str = "latitude", lon: str = "longitude") -> Column:
    """The place of a position on the curve (NULL without one)."""
    top = (1 << BITS) - 1
    cell = lambda c, low, span: F.greatest(F.lit(0), F.least(F.lit(top), F.floor((F.col(c) - low) / span * (top + 1)))).cast("bigint")     # noqa: E731
    known = F.col(lat).isNotNull() & F.col(lon).isNotNull()
    return F.when(known, F.shiftleft(_spread(cell(lat, -90.0, 180.0)), 1).bitwiseOR(_spread(cell(lon, -180.0, 360.0))))


def _rows_path(path: str) -> str:
    return f"{path.rstrip('/')}/rows"


def _bounds_path(path: str) -> str:
    return f"{path.rstrip('/')}/bounds"


def write_clustered(df: DataFrame, path: str, files: int, lat: str = "latitude", lon: str = "longitude") -> None:
    """Write ``df`` in about ``files`` files along the curve, and their bounds.  Equal
    positions are told apart by a hash of the row, so that a crowded place spreads over
    several files."""
    columns = df.columns
    ordered = df.withColumn("__z", z_order(lat, lon)).withColumn("__tie", F.xxhash64(*columns))
    ordered.repartitionByRange(files, "__z", "__tie").sortWithinPartitions("__z").select(*columns).write.parquet(_rows_path(path))
    rows = df.sparkSession.read.schema(df.schema).parquet(_rows_path(path))
    side = lambda f, c, name: f(c).cast("double").alias(name)      # noqa: E731
    rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        side(F.min, lat, "lat_min"), side(F.max, lat, "lat_max"), side(F.min, lon, "lon_min"), side(F.max, lon, "lon_max"),
        F.count(F.lit(1)).alias("n_rows")).write.parquet(_bounds_path(path))


def files_of_box(spark: SparkSession, path: str, lat_min: float, lat_max: float, lon_min: float, lon_max: float) -> list[str]:
    """The files whose bounds meet the box (names only pass through the driver)."""
    bounds = spark.read.parquet(_bounds_path(path))
    met = bounds.where((F.col("lat_min") <= lat_max) & (F.col("lat_max") >= lat_min)
                       & (F.col("lon_min") <= lon_max) & (F.col("lon_max") >= lon_min))
    return sorted(r["file"] for r in met.select("file").collect())


def read_box(spark: SparkSession, path: str, schema, lat_min: float, lat_max: float, lon_min: float, lon_max: float,
             lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """The rows in the closed box."""
    files = files_of_box(spark, path, lat_min, lat_max, lon_min, lon_max)
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*files).where(
        F.col(lat).between(lat_min, lat_max) & F.col(lon).between(lon_min, lon_max))
