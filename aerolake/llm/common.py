"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Hashable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.session import fresh_path

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# Rows per Arrow batch.  Documents run to 100 KB and more, so the default of
# 10,000 rows a batch could hold a gigabyte in one Python worker.
BATCH_ROWS = 512
# and bytes: a batch ends when it holds so many, after one whole text at least.
BATCH_BYTES = 32 << 20


def prepare(spark: SparkSession) -> None:
    """Make this package importable in Python workers and bound Arrow batches.

    A cluster ships the package with ``--py-files``; where workers see the same
    path (local runs) the path itself is enough.
    """
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
    if PACKAGE_ROOT not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (PACKAGE_ROOT, known) if x)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to a fresh folder of the shared storage and read
    back: cuts the lineage, survives lost executors, is computed once."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sha256_hex(col) -> F.Column:
    return F.sha2(col, 256)


# ------------------------------------------------------------------ in Python workers
_HELD: dict[Hashable, Any] = {}


def worker_state(owner: Hashable, make: Callable[[], Any]) -> Any:
    """What an operator keeps between the tasks of a Python worker (tables, caches).
    A worker serves many operators in turn and holds the state of one of them."""
    if owner not in _HELD:
        _HELD.clear()
        give_back()
        _HELD[owner] = make()
    return _HELD[owner]


def give_back() -> None:
    """Hand freed memory back to the system, which the allocators would keep."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):       # another C library
        pass


def released(run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``, with its freed memory handed back when a task ends."""
    def bounded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()
    return bounded
