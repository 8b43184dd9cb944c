"""Folders on shared storage: listing, renaming, and tables replaced as a whole.

Only names and partition folders pass through the driver, as in the commit of
any partitioned write.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder; its new parent is created."""
    fs, p = _fs(spark, source)
    _, q = _fs(spark, target)
    fs.mkdirs(q.getParent())
    if not fs.rename(p, q):
        raise OSError(f"cannot move {source} to {target}")


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the visible folders directly below ``path``."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p)
                  if s.isDirectory() and not s.getPath().getName().startswith(("_", ".")))


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly below ``path``."""
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isFile()] if fs.exists(p) else []


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    fs, p = _fs(spark, path)
    out = fs.create(p, False)
    try:
        out.write(data)
    finally:
        out.close()


def read_bytes(spark: SparkSession, path: str) -> bytes:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def stamp(spark: SparkSession, path: str) -> tuple[int, int]:
    """When a file last changed, and its length."""
    fs, p = _fs(spark, path)
    status = fs.getFileStatus(p)
    return status.getModificationTime(), status.getLen()


def age_seconds(spark: SparkSession, path: str) -> float:
    """Seconds since the folder or file last changed."""
    fs, p = _fs(spark, path)
    return (spark.sparkContext._jvm.System.currentTimeMillis() - fs.getFileStatus(p).getModificationTime()) / 1000


def partition_folders(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Relative names of the partition folders ``depth`` levels below ``path``."""
    found = [""]
    for _ in range(depth):
        found = [f"{a}/{b}".lstrip("/") for a in found for b in subfolders(spark, f"{path}/{a}")]
    return found


def replace_table(df: DataFrame, path: str, partition_by=()) -> DataFrame:
    """Write ``df`` as the whole table at ``path`` and read it back.

    The new table is complete before the old one goes, so ``df`` may read the
    old one, and a run that fails on the way is finished or undone by the next
    ``recover_table``.
    """
    spark = df.sparkSession
    recover_table(spark, path)
    new, old = _aside(path, "new"), _aside(path, "old")
    delete(spark, new)
    w = df.hint("rebalance", *partition_by) if partition_by else df
    w = w.write.partitionBy(*partition_by) if partition_by else w.write
    w.parquet(new)
    if path_exists(spark, path):
        rename(spark, path, old)
    rename(spark, new, path)
    delete(spark, old)
    return read_schema(spark, df, path)


def read_schema(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def _aside(path: str, what: str) -> str:
    head, _, name = path.rstrip("/").rpartition("/")
    return f"{head}/_{name}.{what}"


def recover_table(spark: SparkSession, path: str) -> None:
    """Finish a replacement that stopped between the two moves."""
    new, old = _aside(path, "new"), _aside(path, "old")
    if not path_exists(spark, path):
        if path_exists(spark, f"{new}/_SUCCESS"):
            rename(spark, new, path)
        elif path_exists(spark, old):
            rename(spark, old, path)
    if path_exists(spark, path):
        delete(spark, old)
