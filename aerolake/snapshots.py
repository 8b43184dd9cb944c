"""Partitioned Parquet tables whose readers see one commit.

``<path>/data/snapshot_write=<id>/<files>``    what one write made
``<path>/commits/<number>.json``               write id and files -> the partitions they hold

A write brings the rows of a partition together and puts them, in order of the
partitions, into files cut by size alone: small partitions share a file and a large
one has several, so the number of files follows the bytes and not the number of
partitions.  It then commits a manifest that names, for each partition of the table,
the write and the files that hold it (``commitlog``); rows that a file has of other
partitions than these are passed over by readers.  Nothing that a reader may be reading is moved or deleted: a
``Snapshot`` keeps its manifest's files until ``sweep`` retires it.  Writers that
touched different partitions both get in; where they touched the same, the second
merges again onto what the first committed.  A write that stops half way leaves
files that no manifest names.
"""

from __future__ import annotations

import json
import re
import threading
import uuid
from collections import Counter, OrderedDict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from aerolake import commitlog, storage
from aerolake.session import local_rows

WRITE = "snapshot_write"
TRIES = 20
KEPT = 16               # manifests that a driver keeps parsed
SMALL_ROWS, SMALL_FILES = 1_000_000, 4      # of a batch's and a table's partition that one task may merge
FEW = 1000              # values of a partition column that a scan is filtered by
NULL_NAME = "__HIVE_DEFAULT_PARTITION__"
_SPECIAL = re.compile(r"""[\x01-\x1f\x7f"#%'*/:=?\\{\[\]^]""")        # escaped in the names of folders


class CommitConflict(Exception):
    """Other writers were first ``TRIES`` times."""


@dataclass(frozen=True)
class Snapshot:
    path: str
    version: int
    schema: StructType
    partition_by: tuple[str, ...]
    folders: dict[str, str]                 # partition -> id of the write that holds it
    files: dict[str, tuple[str, ...]]       # partition -> names of the files of that write with its rows
    sizes: dict[tuple[str, str], int]       # (write, file) -> number of partitions that the file was written with


def _commits(path: str) -> str:
    return f"{path.rstrip('/')}/commits"


def _data(path: str, write: str = "") -> str:
    return f"{path.rstrip('/')}/data" + (f"/{WRITE}={write}" if write else "")


_parsed: OrderedDict[tuple, Snapshot] = OrderedDict()
_parsing = threading.Lock()


def _remember(spark: SparkSession, snap: Snapshot) -> Snapshot:
    stamp = storage.stamp(spark, commitlog.file_of(_commits(snap.path), snap.version))
    with _parsing:
        _parsed[snap.path, snap.version, stamp] = snap
        while len(_parsed) > KEPT:
            _parsed.popitem(last=False)
    return snap


def snapshot(spark: SparkSession, path: str, version: int | None = None) -> Snapshot | None:
    """The table as of a commit (default: the newest); None before the first.  A commit
    never changes, so its manifest is parsed once while the file is the same."""
    number = version or commitlog.latest(spark, _commits(path))
    if not number:
        return None
    known = (path, number, storage.stamp(spark, commitlog.file_of(_commits(path), number)))
    with _parsing:
        if known in _parsed:
            _parsed.move_to_end(known)
            return _parsed[known]
    head, *rows = commitlog.read(spark, _commits(path), number)
    files = [(f["write"], f["file"]) for f in head["files"]]
    folders, held = {}, {}
    for r in rows:
        names = tuple(files[k][1] for k in r["files"])
        for p in r["partitions"] if "partitions" in r else [r["partition"]]:      # formerly one row each
            folders[p], held[p] = r["write"], names
    return _remember(spark, Snapshot(path, number, StructType.fromJson(json.loads(head["schema"])), tuple(head["partition_by"]),
                                     folders, held, {key: f["partitions"] for key, f in zip(files, head["files"])}))


def read_snapshot(spark: SparkSession, snap: Snapshot, partitions=None) -> DataFrame:
    """The rows of ``snap``; ``partitions``: of these partitions alone (files without
    rows of them are neither listed nor read)."""
    names = list(snap.folders) if partitions is None else [p for p in partitions if p in snap.folders]
    wanted = Counter((snap.folders[p], f) for p in names for f in snap.files[p])
    if not wanted:
        return local_rows(spark, [], snap.schema)
    rows = (spark.read.schema(StructType([*snap.schema.fields, StructField(WRITE, StringType())])).option("basePath", _data(snap.path))
            .parquet(*[f"{_data(snap.path, w)}/{f}" for w, f in sorted(wanted)]))
    if any(snap.sizes[key] != n for key, n in wanted.items()):
        rows = _of_partitions(spark, snap, rows, names)
    return rows.select(*snap.schema.names)


def _of_partitions(spark: SparkSession, snap: Snapshot, rows: DataFrame, names: list[str]) -> DataFrame:
    """Those of ``rows`` (with their write) that lie in the named partitions as of ``snap``."""
    by = snap.partition_by
    values = [partition_values(p) for p in names]
    first = {v[0] for v in values}
    kind = snap.schema[by[0]].dataType
    if len(first) <= FEW and None not in first and kind.typeName() in ("date", "string", "integer", "long"):
        rows = rows.where(F.col(by[0]).isin([F.lit(v).cast(kind) for v in first]))      # skips row groups
    fields = ", ".join(f"__p{k} string" for k in range(len(by)))
    live = local_rows(spark, [(*v, snap.folders[p]) for p, v in zip(names, values)], f"{fields}, __write string")
    same = [F.nullif(F.col(c).cast("string"), F.lit("")).eqNullSafe(F.col(f"__p{k}")) for k, c in enumerate(by)]
    return rows.join(F.broadcast(live), [*same, F.col(WRITE) == F.col("__write")], "left_semi")


def read(spark: SparkSession, path: str, version: int | None = None, partitions=None) -> DataFrame:
    """The table at ``path`` as of its newest commit, or of ``version``."""
    snap = snapshot(spark, path, version)
    if snap is None:
        raise FileNotFoundError(f"no table at {path}")
    return read_snapshot(spark, snap, partitions)


def exists(spark: SparkSession, path: str) -> bool:
    return commitlog.latest(spark, _commits(path)) > 0


def _partition_name(columns, values) -> str:
    """As a partitioned write names the folder; '' and NULL share one."""
    return "/".join(f"{_escaped(c)}={_escaped(v) if v else NULL_NAME}" for c, v in zip(columns, values))


def _escaped(text: str) -> str:
    return _SPECIAL.sub(lambda m: f"%{ord(m[0]):02X}", text)


def partition_values(name: str) -> list[str | None]:
    """The values (as text, None for '' and NULL) in a partition's name."""
    texts = [part.partition("=")[2] for part in name.split("/")]
    return [None if t == NULL_NAME else re.sub("%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), t) for t in texts]


def partition_names(spark: SparkSession, df: DataFrame, partition_by) -> list[str]:
    """The partitions that rows of ``df`` belong to, by the names of their folders in a
    partitioned write."""
    values = df.select(*partition_by).distinct().select(*_texts(partition_by)).collect()
    return sorted({_partition_name(partition_by, row) for row in values})


def _texts(columns) -> list[Column]:
    return [F.col(c).cast("string").alias(c) for c in columns]


def _write(spark: SparkSession, path: str, df: DataFrame, partition_by, together: bool = False) -> tuple[str, dict[str, set[str]]]:
    """Write ``df`` (``together``: the rows of a partition have met already); returns the
    write's id and the files with rows of each partition."""
    write = uuid.uuid4().hex
    met = df if together else df.hint("rebalance", *partition_by)
    met.sortWithinPartitions(*partition_by).write.parquet(_data(path, write))
    rows = spark.read.schema(df.schema).parquet(_data(path, write))
    held: dict[str, set[str]] = {}
    places = rows.select(*partition_by, F.col("_metadata.file_name").alias("__file")).distinct()
    for *value, file in places.select(*_texts(partition_by), "__file").collect():
        held.setdefault(_partition_name(partition_by, value), set()).add(file)
    return write, held


def _commit(spark: SparkSession, path: str, base: Snapshot | None, schema: StructType, partition_by,
            write: str, held: dict[str, set[str]], drop=()) -> Snapshot | None:
    """Commit the partitions that ``write`` holds (partition -> files) and the removal
    of those in ``drop`` onto ``base``; None if a newer commit is there."""
    gone = set(drop)
    folders = {p: w for p, w in base.folders.items() if p not in gone} if base else {}
    folders |= dict.fromkeys(held, write)
    files = {p: tuple(sorted(held[p])) if p in held else base.files[p] for p in folders}
    sizes = (base.sizes if base else {}) | {(write, f): n for f, n in Counter(f for fs in held.values() for f in fs).items()}
    used = sorted({(w, f) for p, w in folders.items() for f in files[p]})
    sizes = {key: sizes[key] for key in used}
    place = {key: k for k, key in enumerate(used)}
    number = (base.version if base else 0) + 1
    head = {"schema": schema.json(), "partition_by": list(partition_by),
            "files": [{"write": w, "file": f, "partitions": sizes[w, f]} for w, f in used]}
    alike: dict[tuple, list[str]] = {}          # partitions that share their files
    for p, w in sorted(folders.items()):
        alike.setdefault((w, files[p]), []).append(p)
    rows = [head, *({"write": w, "files": [place[w, f] for f in fs], "partitions": ps} for (w, fs), ps in alike.items())]
    if not commitlog.commit(spark, _commits(path), number, rows):
        return None
    return _remember(spark, Snapshot(path, number, schema, tuple(partition_by), folders, files, sizes))


def replace_partitions(spark: SparkSession, path: str, df: DataFrame, partition_by, drop=()) -> Snapshot:
    """Replace the partitions that ``df`` has rows of, and remove those named in
    ``drop``, in one commit; the last writer of a partition wins."""
    parts = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    write, held = _write(spark, path, df, parts)
    for _ in range(TRIES):
        if done := _commit(spark, path, snapshot(spark, path), df.schema, parts, write, held, drop):
            return done
    raise CommitConflict(path)


def merge_frames(target: DataFrame | None, batch: DataFrame, key: str, order_by=(), one_version: bool = False, within=()) -> DataFrame:
    """The newest version of every key from both sides.

    A version is all rows of a key with equal ``order_by`` values from one side
    (overlapping airport boxes give a signal several rows).  The greatest
    ``order_by`` wins, NULLs last; on a tie, and without ``order_by``, the batch
    does.  The same rule holds within the batch alone, so a first load and later
    loads agree (``one_version``: the batch has only one of any key).  ``within``:
    columns that are functions of the key, by which the rows meet, whole groups in a
    task."""
    if target is None and (one_version or not order_by):
        return batch
    rows = batch.withColumn("__side", F.lit(1))
    if target is not None:
        rows = rows.unionByName(target.withColumn("__side", F.lit(0)))
    order = [F.col(c).desc_nulls_last() for c in order_by] + [F.col("__side").desc()]
    # rank() = 1 is limited per map task before the shuffle, as row_number() is; keys
    # share long beginnings, so they are sorted by a hash before they are compared
    if within:
        rows = rows.repartition(*within)
    w = Window.partitionBy(*within, F.xxhash64(key), key).orderBy(*order)
    return rows.withColumn("__rank", F.rank().over(w)).where("__rank = 1").drop("__rank", "__side")


def upsert(spark: SparkSession, path: str, batch: DataFrame, key: str, partition_col,
           order_by=(), on_null_key: str = "fail", run_id: str | None = None, stored: bool = False,
           one_version: bool = False) -> dict:
    """Upsert ``batch`` into the table at ``path`` partitioned by ``partition_col``
    (one name or a list).  Every partition column must be a function of ``key``;
    NULL is a partition like any other.

    ``order_by``: columns that tell a key's newest version (``merge_frames``).
    ``on_null_key``: ``fail``, or ``quarantine``: rows without a key go to
    ``<path>_rejected/run_id=<run_id>`` (replaced when the run is repeated).
    A batch whose columns differ from the table's is refused.
    ``stored``: ``batch`` reads files that stay as they are during the call; they are
    not copied.  ``one_version``: the batch has only one version of any key, so no hot
    key has to be thinned out before rows move: where the partitions are small, they
    are merged and written after one shuffle.

    The batch is computed once, into a staged copy whose partition values name what
    is touched; only those partitions are read, and what they become is written once
    and committed.  A stop on the way leaves the table as it was.  Returns batch
    rows, rejected rows, the touched partition folders and the table's version.
    """
    parts = [partition_col] if isinstance(partition_col, str) else list(partition_col)
    order_by = [order_by] if isinstance(order_by, str) else list(order_by)
    base = snapshot(spark, path)
    if base is not None and set(base.schema.names) != set(batch.columns):
        raise ValueError(f"columns differ from the table's: {sorted(set(base.schema.names) ^ set(batch.columns))}")
    if on_null_key == "fail":
        batch = batch.withColumn(key, F.when(F.col(key).isNull(), F.raise_error(F.lit(f"NULL {key} in upsert batch")))
                                 .otherwise(F.col(key)))
    elif on_null_key != "quarantine":
        raise ValueError(on_null_key)
    staged_path = f"{path.rstrip('/')}/staged/{uuid.uuid4().hex}"
    staged = batch
    if not stored:
        batch.write.parquet(staged_path)
        staged = spark.read.schema(batch.schema).parquet(staged_path)
    good = staged.where(F.col(key).isNotNull())
    counts = staged.groupBy(*parts).agg(F.count(F.lit(1)).alias("__all"), F.count(key).alias("__good"))
    counts = counts.select(*_texts(parts), "__all", "__good").collect()
    n_all, n_good = (sum(r[name] for r in counts) for name in ("__all", "__good"))
    if on_null_key == "quarantine":
        _set_aside(spark, path, staged.where(F.col(key).isNull()), n_all - n_good, run_id)
    touched: Counter[str] = Counter()           # with the batch's rows
    for r in counts:
        if r["__good"]:
            touched[_partition_name(parts, r[:len(parts)])] += r["__good"]
    result = {"batch_rows": n_good, "rejected_rows": n_all - n_good, "touched": sorted(touched),
              "version": base.version if base else 0}
    if touched:
        result["version"] = _merge(spark, path, base, good, batch.schema, key, parts, order_by, touched, one_version).version
    if not stored:
        storage.delete(spark, staged_path)
    return result


def _set_aside(spark: SparkSession, path: str, bad: DataFrame, n_bad: int, run_id: str | None) -> None:
    rejected = f"{path.rstrip('/')}_rejected"
    if n_bad:
        (bad.withColumn("run_id", F.lit(run_id or uuid.uuid4().hex)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(rejected))
    elif run_id:
        storage.delete(spark, f"{rejected}/run_id={run_id}")       # of the run's first try


def _merge(spark, path, base, good, schema, key, parts, order_by, touched, one_version) -> Snapshot:
    write, held, merged_on = None, {}, None
    for _ in range(TRIES):
        stored = {p: base.folders[p] for p in touched if p in base.folders} if base else {}
        if write is None or stored != merged_on:        # nothing merged yet, or another writer changed it since
            current = read_snapshot(spark, base, stored) if stored else None
            small = one_version and current is not None and max(touched.values()) <= SMALL_ROWS and all(
                len(base.files[p]) <= SMALL_FILES for p in stored)
            merged = merge_frames(current, good, key, order_by, one_version, parts if small else ())
            write, held = _write(spark, path, merged, parts, together=small)
            merged_on = stored
        if done := _commit(spark, path, base, schema, parts, write, held):
            return done
        base = snapshot(spark, path)
    raise CommitConflict(path)


def sweep(spark: SparkSession, path: str, keep: int = 3, orphan_seconds: float = 86_400) -> int:
    """Delete the commits before the last ``keep`` and the data that no kept one
    names; what no commit ever named only when older than ``orphan_seconds`` (it may
    be of a writer at work).  Returns the number of folders and files deleted."""
    numbers = commitlog.numbers(spark, _commits(path))
    kept, retired = numbers[-keep:], numbers[:-keep]
    named = {key for n in kept for key in snapshot(spark, path, n).sizes}
    writes = {w for w, _ in named}
    old = {key for n in retired for key in snapshot(spark, path, n).sizes}
    gone = 0
    for w in {w for w, _ in old} - writes:                  # whole writes first: one call each
        storage.delete(spark, _data(path, w))
        gone += 1
    for w, f in old - named:
        if w in writes:
            storage.delete(spark, f"{_data(path, w)}/{f}")
            gone += 1
    for folder in (_data(path), f"{path.rstrip('/')}/staged"):
        for name in storage.subfolders(spark, folder):
            if name.removeprefix(f"{WRITE}=") not in writes and storage.age_seconds(spark, f"{folder}/{name}") > orphan_seconds:
                storage.delete(spark, f"{folder}/{name}")
                gone += 1
    for n in retired:
        storage.delete(spark, commitlog.file_of(_commits(path), n))
    return gone
