"""The ledger of bronze loads, and which of them a build still has to take.

``load`` commits each load (or its repetition, a new *attempt*) to the ledger beside
bronze when its rows are written.  A build takes every load whose present attempt
it has not built, whatever the load's time: one that is stamped earlier but committed
later is not lost, as it would be behind a single high-water mark.  Only the folders
of these loads are listed and read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from aerolake import commitlog
from aerolake.snapshots import TRIES, CommitConflict

ENTRY = "load string, attempt string, inserted_at string, n_rows bigint, first_id bigint, digest string"


def ledger_path(raw_path: str) -> str:
    return f"{raw_path.rstrip('/')}_ledger"


def ledger(spark: SparkSession, raw_path: str) -> DataFrame:
    """The committed loads (``ENTRY``); ``load`` is the folder below ``raw_path``."""
    return commitlog.table(spark, ledger_path(raw_path), ENTRY)


def has_ledger(spark: SparkSession, raw_path: str) -> bool:
    return commitlog.latest(spark, ledger_path(raw_path)) > 0


def entries(spark: SparkSession, raw_path: str) -> tuple[int, dict[str, dict]]:
    """The ledger's number and its entries by load."""
    number = commitlog.latest(spark, ledger_path(raw_path))
    rows = commitlog.read(spark, ledger_path(raw_path), number) if number else []
    return number, {r["load"]: r for r in rows}


def next_id(known: dict[str, dict], load: str, n_rows: int, first: int = 1) -> int:
    """The first surrogate id of a load: that of its former attempt if that had as
    many rows (a repetition keeps its ids), else the one after all others."""
    if load in known and known[load]["n_rows"] == n_rows:
        return known[load]["first_id"]
    return max((e["first_id"] + e["n_rows"] for e in known.values()), default=first)


def record(spark: SparkSession, raw_path: str, load: str, n_rows: int, inserted_at: str,
           write: Callable[[int], str | None]) -> dict:
    """Commit a load of ``n_rows`` rows.  ``write(first_id)`` writes them with ids from
    ``first_id`` and returns their digest; it is called again only if another load was
    committed meanwhile that took these ids."""
    written, digest = None, None
    for _ in range(TRIES):
        number, known = entries(spark, raw_path)
        first_id = next_id(known, load, n_rows)
        if first_id != written:
            digest = write(first_id)
            written = first_id
        entry = {"load": load, "attempt": uuid.uuid4().hex, "inserted_at": inserted_at, "n_rows": n_rows,
                 "first_id": first_id, "digest": digest}
        if commitlog.commit(spark, ledger_path(raw_path), number + 1, [*(known | {load: entry}).values()]):
            return entry
    raise CommitConflict(raw_path)


def pending(spark: SparkSession, raw_path: str, built_path: str) -> list[dict]:
    """The committed loads whose present attempt is not among those built: an anti
    join of the two ledgers."""
    built = commitlog.table(spark, built_path, "load string, attempt string")
    left = ledger(spark, raw_path).join(built, ["load", "attempt"], "left_anti")
    return [r.asDict() for r in left.orderBy("load").collect()]


def mark_built(spark: SparkSession, built_path: str, taken: list[dict]) -> None:
    for _ in range(TRIES):
        number = commitlog.latest(spark, built_path)
        rows = commitlog.read(spark, built_path, number) if number else []
        done = {r["load"]: r["attempt"] for r in rows} | {e["load"]: e["attempt"] for e in taken}
        if commitlog.commit(spark, built_path, number + 1, [{"load": k, "attempt": v} for k, v in sorted(done.items())]):
            return
    raise CommitConflict(built_path)


def read_loads(spark: SparkSession, raw_path: str, loads) -> DataFrame:
    """The rows of the named loads; the folders of others are not listed."""
    root = raw_path.rstrip("/")
    return spark.read.option("basePath", root).parquet(*[f"{root}/{name}" for name in loads])
