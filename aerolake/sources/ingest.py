"""Reading positional state-vector batches and applying the contract.

A batch file is one JSON document ``[[v0, ..., v16], [...], ...]`` (the
"document" layout) or one inner array per line (the "lines" layout, the one
to prefer for new data: it splits across tasks).  Values arrive as JSON
scalars of mixed types; they are parsed as strings and cast by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.sources.schemas import (FLIGHT_LEG_SCHEMA, POLL_ENVELOPE_SCHEMA, STATE_VECTOR_SCHEMA,
                                      ordered_schema)
from aerolake.storage import path_exists

ROWS_TYPE = T.ArrayType(T.ArrayType(T.StringType()))
ROW_TYPE = T.ArrayType(T.StringType())


# ------------------------------------------------------------------ S1
MALFORMED, BAD_WIDTH = "malformed", "width"


def parse_inputs(spark: SparkSession, path: str, layout: str = "document") -> DataFrame:
    """(source_file, value, rows) of every non-blank file (``document``) or line
    (``lines``); ``rows`` is NULL where it is not an array of arrays."""
    if layout == "document":
        raw, rows = spark.read.text(path, wholetext=True), F.from_json("value", ROWS_TYPE)
    elif layout == "lines":
        raw, rows = spark.read.text(path), F.from_json("value", ROW_TYPE)
        rows = F.when(rows.isNotNull(), F.array(rows))
    else:
        raise ValueError(layout)
    return raw.where(F.trim("value") != "").select(F.input_file_name().alias("source_file"), "value", rows.alias("rows"))


def read_state_vectors(spark: SparkSession, path: str, layout: str = "document", partitions: int | None = None,
                       with_source: bool = False, on_malformed: str = "fail") -> DataFrame:
    """One row ``row array<string>`` per inner array.

    ``document``: each file is read whole (``wholetext``; a pretty-printed
    file would yield NULL rows in line mode) and exploded.  A whole file is
    one task, so for large files pass ``partitions`` to spread the exploded
    rows before the typed projection.  ``lines``: one array per line, split
    like any text file.

    ``on_malformed``: an input that does not parse aborts the read (``fail``,
    fused into the plan), or is left out (``skip``; ``malformed_inputs`` has it).
    """
    parsed = parse_inputs(spark, path, layout)
    rows = F.col("rows")
    if on_malformed == "fail":
        rows = F.when(rows.isNull(), F.raise_error(F.concat(F.lit("MALFORMED INPUT in "), "source_file"))).otherwise(rows)
    elif on_malformed != "skip":
        raise ValueError(on_malformed)
    out = parsed.select("source_file", F.explode(rows).alias("row"))
    if partitions:
        out = out.repartition(partitions)
    return out if with_source else out.select("row")


def malformed_inputs(spark: SparkSession, path: str, layout: str = "document") -> DataFrame:
    """Files (document layout) or lines that are not an array of arrays."""
    return parse_inputs(spark, path, layout).where("rows is null").select("source_file", "value")


def classified_inputs(spark: SparkSession, path: str, layout: str = "document") -> DataFrame:
    """(source_file, value, row, problem): one row per inner array, and one per
    malformed input; ``problem`` is NULL for a good row, else names what is wrong
    (``value`` has the text of a malformed input)."""
    parsed = parse_inputs(spark, path, layout)
    out = parsed.select("source_file", F.when(F.col("rows").isNull(), F.col("value")).alias("value"),
                        F.explode_outer("rows").alias("row"), F.col("rows").isNull().alias("_bad"),
                        (F.size("rows") == 0).alias("_empty")).where("_bad or not _empty")
    return out.select("source_file", "value", "row", F.when(F.col("_bad"), MALFORMED).when(
        width_violation("row"), BAD_WIDTH).alias("problem"))


# ------------------------------------------------------------------ S2
def unwrap_states(df: DataFrame, col: str = "value") -> DataFrame:
    """Poll envelope ``{"time": t, "states": [[...], ...]}`` -> one row per
    state; a missing, null or empty ``states`` gives no rows, text that is no
    JSON object aborts."""
    env = F.from_json(F.col(col), POLL_ENVELOPE_SCHEMA, {"mode": "FAILFAST"})
    env = df.where(F.trim(F.col(col)) != "").select(env.alias("env"))
    return env.select(F.col("env.time").alias("poll_time"), F.explode("env.states").alias("row"))


# ------------------------------------------------------------------ S3 / D8
def width_violation(row_col: str = "row", width: int = len(STATE_VECTOR_SCHEMA)) -> Column:
    return F.coalesce(F.size(F.col(row_col)) != width, F.lit(True))


def check_width(df: DataFrame, width=len(STATE_VECTOR_SCHEMA), row_col: str = "row",
                on_violation: str = "fail"):
    """Contract on every row (not just the first): each row has ``width``
    values (an int, or the contract schema: its number of fields).

    ``fail``: the check is fused into the projection with ``raise_error``, so
    no extra pass is made and a write of the result aborts (its output is
    never committed) when any row breaks the contract.
    ``quarantine``: returns ``(good, bad)`` DataFrames.
    """
    if not isinstance(width, int):
        width = len(ordered_schema(width).fields)
    bad = width_violation(row_col, width)
    if on_violation == "fail":
        msg = F.concat(F.lit(f"CONTRACT BROKEN: expected {width} values, got "),
                       F.coalesce(F.size(F.col(row_col)).cast("string"), F.lit("NULL")))
        return df.withColumn(row_col, F.when(bad, F.raise_error(msg)).otherwise(F.col(row_col)))
    if on_violation == "quarantine":
        return df.filter(~bad), df.filter(bad)
    raise ValueError(on_violation)


def contract_report(df: DataFrame, width: int = len(STATE_VECTOR_SCHEMA), row_col: str = "row") -> DataFrame:
    """One aggregate row: rows, rows of the wrong width, min/max width."""
    size = F.size(F.col(row_col))
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.sum(F.when(width_violation(row_col, width), 1).otherwise(0)).cast("bigint").alias("n_bad_width"),
                  F.min(size).alias("min_width"), F.max(size).alias("max_width"))


# ------------------------------------------------------------------ S4
def typed_projection(df: DataFrame, schema=STATE_VECTOR_SCHEMA, row_col: str = "row",
                     keep=()) -> DataFrame:
    """i-th value cast to the i-th field.  ``get`` and ``try_cast`` give NULL
    for a missing position or a malformed value (no ANSI failure)."""
    schema = ordered_schema(schema)
    cols = [F.get(F.col(row_col), i).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)]
    return df.select(*keep, *cols)


def failed_casts(schema=STATE_VECTOR_SCHEMA, row_col: str = "row") -> Column:
    """How many of a row's values are present but not castable."""
    fields = ordered_schema(schema).fields
    values = [F.get(F.col(row_col), i) for i in range(len(fields))]
    return sum((F.when(v.isNotNull() & v.try_cast(f.dataType).isNull(), 1).otherwise(0)
                for v, f in zip(values, fields)), F.lit(0))


def cast_failures(df: DataFrame, schema=STATE_VECTOR_SCHEMA, row_col: str = "row") -> DataFrame:
    """Per field: values present but not castable (counted in one pass)."""
    schema = ordered_schema(schema)
    aggs = []
    for i, f in enumerate(schema.fields):
        v = F.get(F.col(row_col), i)
        aggs.append(F.sum(F.when(v.isNotNull() & v.try_cast(f.dataType).isNull(), 1).otherwise(0))
                    .cast("bigint").alias(f.name))
    return df.agg(*aggs)


# ------------------------------------------------------------------ S5
def with_processing_date(df: DataFrame, date: str, col: str = "processing_date") -> DataFrame:
    """Stamp the batch's processing date (an explicit argument, not "now")."""
    return df.withColumn(col, F.lit(date).cast("date"))


# ------------------------------------------------------------------ S7
def scan_partition(spark: SparkSession, path: str, column: str, value, schema=None) -> DataFrame:
    """Read one partition of a partitioned table *keeping* the partition column.

    Only that partition's folder is listed (``basePath`` keeps the column); a
    value that was never written gives no rows."""
    folder = f"{path.rstrip('/')}/{column}={value}"
    if not path_exists(spark, folder):
        if schema is None:
            schema = spark.read.parquet(path).schema
        return spark.createDataFrame([], schema)
    reader = spark.read.option("basePath", path)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(folder)


# ------------------------------------------------------------------ S14
def read_flight_legs(spark: SparkSession, path: str) -> DataFrame:
    """Arrivals/departures records with the declared 12-field schema;
    ``firstSeen``/``lastSeen`` also exposed as timestamps."""
    df = spark.read.schema(FLIGHT_LEG_SCHEMA).json(path)
    return (df.withColumn("first_seen_ts", F.timestamp_seconds("firstSeen"))
              .withColumn("last_seen_ts", F.timestamp_seconds("lastSeen")))
