"""Sinks: partitioned Parquet, raw JSON landing, message topics, JDBC, and
the bronze defaults and count reconciliation that go with a load."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from aerolake.sources.schemas import STATE_VECTOR_FIELDS


# ------------------------------------------------------------------ S6
def cluster_for_partitioned_write(df: DataFrame, by) -> DataFrame:
    """Rows brought together for a partitioned write by the rebalance hint.

    At run time AQE merges small partition values into one task and splits a
    large one over several by its bytes: about one file for a small date, more
    for a hot one, whatever the number of tasks and dates.  No sampling pass, so
    counts taken upstream with ``observe`` stay exact."""
    by = [by] if isinstance(by, str) else list(by)
    return df.hint("rebalance", *by)


def write_partitions(df: DataFrame, path: str, by, fmt: str = "parquet", dynamic: bool = True, clustered: bool = True) -> None:
    """Overwrite only the partitions present in ``df`` (dynamic partition
    overwrite, set on this write only); the other partitions survive.
    ``clustered=False``: rows of one partition, written by the tasks that have them."""
    by = [by] if isinstance(by, str) else list(by)
    w = (cluster_for_partitioned_write(df, by) if clustered else df).write.mode("overwrite").partitionBy(*by).format(fmt)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    w.save(path)


# ------------------------------------------------------------------ S9
def with_bronze_columns(df: DataFrame, batch_ts, id_offset: int = 0,
                        id_col: str = "id_surrogate", ts_col: str = "inserted_at") -> DataFrame:
    """What the store fills on insert: a surrogate id (unique, not dense:
    ``monotonically_increasing_id`` + the previous load's high id) and one
    insert timestamp for the whole load (so a load is all-or-nothing for the
    incremental filter)."""
    return (df.withColumn(id_col, F.monotonically_increasing_id() + F.lit(id_offset))
              .withColumn(ts_col, F.lit(batch_ts).cast("timestamp_ntz")))


def with_dense_ids(stored: DataFrame, id_offset: int = 1, id_col: str = "id_surrogate") -> DataFrame:
    """Rows of Parquet files numbered from ``id_offset`` without gaps, by file name
    and place in the file.

    Distributed prefix sums: rows are counted by file (from the footers), the counts
    become running offsets, and a row's number is its file's offset plus its place.
    No row is sorted or moved for it, and the same files give the same numbers.
    ``stored`` is a plain scan: the numbers count what lies in the files."""
    file, row = F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row")
    counts = stored.select(file).groupBy("__file").agg(F.count(F.lit(1)).alias("n"))
    # one row a file: the only window without partitions is over these
    before = F.coalesce(F.sum("n").over(Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("__file", before.alias("__before"))
    return stored.select("*", file, row).join(offsets, "__file").withColumn(
        id_col, F.col("__before") + F.col("__row") + F.lit(id_offset)).drop("__file", "__row", "__before")


# ------------------------------------------------------------------ S10
def content_digest(columns) -> list[Column]:
    """Aggregates that tell two multisets of rows apart whatever their order: the
    number of rows, and sum and exclusive-or of the rows' hashes.  Values count with
    their type, NULLs with their place."""
    null_map = F.concat(*[F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in columns])
    row = F.xxhash64(null_map, *[F.col(c) for c in columns])
    return [F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row.cast("decimal(20,0)")), F.lit(0)).cast("string").alias("total"),
            F.coalesce(F.bit_xor(row), F.lit(0)).alias("parity")]


class ContentReconciliation:
    """``content_digest`` at two points, of rows that pass by (``observe``, no job of
    their own) or of a table that is read."""

    def __init__(self, columns, name: str = "content"):
        self.columns = list(columns)
        self.observations = {side: Observation(f"{name}_{side}_{uuid.uuid4().hex[:8]}") for side in ("in", "out")}

    def tap(self, df: DataFrame, side: str) -> DataFrame:
        return df.observe(self.observations[side], *content_digest(self.columns))

    def digest(self, side: str) -> tuple:
        """What passed; a plan that was found empty before it ran counts as no rows."""
        seen = self.observations[side].get
        return int(seen.get("n") or 0), str(seen.get("total") or "0"), int(seen.get("parity") or 0)

    def of(self, df: DataFrame) -> tuple:
        """The digest of a table (one aggregate)."""
        return tuple(df.agg(*content_digest(self.columns)).first())

    def agrees(self) -> bool:
        return self.digest("in") == self.digest("out")


class Reconciliation:
    """Counts rows at two points of one plan with ``observe`` (no extra
    ``count()`` jobs); read the numbers after the action that writes.  Counts alone
    don't see changed contents: ``ContentReconciliation`` does."""

    def __init__(self, name: str = "reconcile"):
        tag = uuid.uuid4().hex[:8]          # observation names must be unique within a plan
        self.obs_in = Observation(f"{name}_in_{tag}")
        self.obs_out = Observation(f"{name}_out_{tag}")

    def tap_in(self, df: DataFrame) -> DataFrame:
        return df.observe(self.obs_in, F.count(F.lit(1)).alias("n"))

    def tap_out(self, df: DataFrame) -> DataFrame:
        return df.observe(self.obs_out, F.count(F.lit(1)).alias("n"))

    def result(self) -> tuple[int, int]:
        """Rows in and out; a plan that was found empty before it ran counts as 0."""
        return int(self.obs_in.get.get("n", 0)), int(self.obs_out.get.get("n", 0))


# ------------------------------------------------------------------ S11
def land_raw(df: DataFrame, path: str, date, date_col: str = "dt") -> None:
    """Land raw rows as JSON under ``dt=<date>``, replacing those days only.

    ``date`` is a literal day (one run) or a Column (each row's day, so a
    backfill lands many days in one job).  Timestamps keep microseconds."""
    d = F.lit(date).cast("date") if isinstance(date, str) else date.cast("date")
    (cluster_for_partitioned_write(df.withColumn(date_col, d), date_col)
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .options(**JSON_TS_OPTIONS).partitionBy(date_col).json(path))


def read_landed(spark, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).options(**JSON_TS_OPTIONS).json(path)


JSON_TS_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                   "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


# ------------------------------------------------------------------ S12
def json_scalar(col) -> Column:
    """A column as one JSON scalar text (strings quoted/escaped, numbers and
    booleans bare, NULL as ``null``), via ``to_json`` of a 1-element array."""
    c = F.col(col) if isinstance(col, str) else col
    j = F.to_json(F.array(c))
    return F.substr(j, F.lit(2), F.length(j) - 2)


def json_array_text(cols) -> Column:
    """The positional message: ``[v0, v1, ...]`` with each value typed."""
    return F.concat(F.lit("["), F.concat_ws(",", *[json_scalar(c) for c in cols]), F.lit("]"))


STATE_VECTOR_NAMES = [n for n, _ in STATE_VECTOR_FIELDS]


def to_messages(df: DataFrame, cols=None, key: str | None = None) -> DataFrame:
    """``value`` (and optional ``key``) columns ready for a message sink."""
    cols = cols or STATE_VECTOR_NAMES
    out = [json_array_text(cols).alias("value")]
    if key:
        out.insert(0, F.col(key).cast("string").alias("key"))
    return df.select(*out)


def publish(df: DataFrame, fmt: str = "kafka", options: dict | None = None, path: str | None = None,
            cols=None, key: str | None = None) -> None:
    """Publish each row as one JSON-array message.  ``fmt="kafka"`` needs the
    connector on the classpath and ``topic``/``kafka.bootstrap.servers``
    options; ``fmt="text"`` writes one message per line (tests, replay)."""
    msgs = to_messages(df, cols, key)
    if fmt == "text":
        msgs = msgs.select("value")
    w = msgs.write.format(fmt).options(**(options or {}))
    if fmt != "kafka":
        w = w.mode("append")
    w.save(path) if path else w.save()


def write_state_vector_documents(df: DataFrame, path: str, rows_per_file: int = 10_000,
                                 n_rows: int | None = None, cols=None, batch_col: str = "batch") -> None:
    """Write rows as document-layout batch files (``[[...],[...]]`` per file).

    Rows are dealt to ``ceil(n / rows_per_file)`` batches by a hash of their
    values and their place in the input, so equal rows spread as well and a batch
    holds about ``rows_per_file`` rows; each becomes one file under
    ``batch=<k>/``.
    """
    cols = cols or STATE_VECTOR_NAMES
    n_rows = df.count() if n_rows is None else n_rows
    n_batches = max(1, -(-n_rows // rows_per_file))
    keyed = df.select(F.pmod(F.xxhash64(F.monotonically_increasing_id(), *[F.col(c) for c in cols]), F.lit(n_batches)).alias(batch_col),
                      json_array_text(cols).alias("msg"))
    docs = keyed.groupBy(batch_col).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list("msg"), ","), F.lit("]")).alias("value"))
    docs.repartition(batch_col).write.mode("overwrite").partitionBy(batch_col).text(path)


# ------------------------------------------------------------------ S8
def jdbc_append(df: DataFrame, url: str, table: str, properties: dict, skip_empty: bool = True) -> bool:
    """Append to a relational table over JDBC; an empty batch is skipped
    (``isEmpty`` reads at most one row).  Returns whether a write happened."""
    if skip_empty and df.isEmpty():
        return False
    df.write.jdbc(url=url, table=table, mode="append", properties=properties)
    return True
