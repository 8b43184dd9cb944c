"""Archiving of a drained file source by a ledger of its own.

The source's own cleaning leaves the files of the last batch where they are and can
miss some without a word.  Here every batch notes the files that its rows came from,
and files are moved when the batch that read them has been committed, each under the
id of that batch.  A move that stops half way is finished by the next call.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake import storage
from aerolake.streaming.drain import stage_batch

MOVES_AT_ONCE = 32


def with_source_file(stream: DataFrame) -> DataFrame:
    """A file stream with the file of each row, for ``noting_files``."""
    return stream.select("*", F.col("_metadata.file_path").alias("source_file"))


def noting_files(ledger: str, body: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch body that runs ``body`` and then notes the batch's files under
    its id in ``ledger`` (a retried batch replaces its own note)."""
    def fn(df: DataFrame, batch_id: int):
        body(df.drop("source_file"), batch_id)
        stage_batch(df.select("source_file").distinct(), batch_id, ledger)
    return fn


def committed_batches(spark: SparkSession, checkpoint: str) -> set[int]:
    """The batches that the query's checkpoint tells are done."""
    return {int(n) for n in storage.file_names(spark, f"{checkpoint}/commits") if n.isdigit()}


def archive_committed(spark: SparkSession, ledger: str, checkpoint: str, archive: str) -> int:
    """Move the noted files of committed batches to ``<archive>/batch_id=<id>/``;
    returns how many were moved.  Only names pass through the driver, and a batch's
    note goes when all its files have moved."""
    moved = 0
    done = committed_batches(spark, checkpoint)
    for name in storage.subfolders(spark, ledger):
        batch = int(name.removeprefix("batch_id="))
        if batch not in done:
            continue
        files = [unquote(r[0]) for r in spark.read.parquet(f"{ledger}/{name}").select("source_file").collect()]

        def move(path: str, batch: int = batch) -> int:
            if not storage.path_exists(spark, path):        # moved by a call that stopped after it
                return 0
            storage.rename(spark, path, f"{archive}/batch_id={batch}/{path.rsplit('/', 1)[1]}")
            return 1

        with ThreadPoolExecutor(MOVES_AT_ONCE) as pool:
            moved += sum(pool.map(move, files))
        storage.delete(spark, f"{ledger}/{name}")
    return moved
