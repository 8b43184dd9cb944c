"""Documents of arrays, ``[[...], [...], ...]``, read in byte ranges.

A whole-file read makes each file one task.  Here files are read as text whose lines
end at ``]``, which Spark cuts at any byte range, and what a piece can't know by
itself comes from prefix sums over the pieces before it: whether it begins within a
string (parity of the quotes so far) and how deep in brackets it lies.  Sums run
within a byte range and over the totals of the ranges of a file, so no task holds a
file.  A piece that is a whole row stays where it is; fragments (a row with ``]`` in
a string or a nested array, or one cut by a range's end) are joined again by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from aerolake.session import fresh_path
from aerolake.sources.ingest import ROW_TYPE

PLACE = ["file", "block"]


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, at, size, value): the text before each ``]``, in order of (file,
    block, at); ``block`` is the byte range's start."""
    return spark.read.option("lineSep", "]").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("_metadata.file_size").alias("size"), "value")


def _before(df: DataFrame, value: Column, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` over all earlier pieces of the file."""
    valued = df.withColumn("__x", value)
    totals = valued.groupBy(*PLACE).agg(F.sum("__x").alias("__total"))
    # a row for each byte range of a file
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*PLACE, F.coalesce(F.sum("__total").over(earlier), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(*PLACE).orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    summed = valued.withColumn("__inside", F.coalesce(F.sum("__x").over(inside), F.lit(0)))
    return summed.join(starts, PLACE).withColumn(name, F.col("__start") + F.col("__inside")).drop("__x", "__start", "__inside")


def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def _described(pieces: DataFrame) -> DataFrame:
    """The pieces with ``depth`` before and after each, ``in_string`` at both ends, and
    whether it ``closes`` a bracket."""
    plain = F.regexp_replace("value", r"(?s)\\.", "")                       # without escaped characters
    quoted = _before(pieces.withColumn("plain", plain), _count(F.col("plain"), '"'), "quotes")
    odd = F.col("quotes") % 2 == 1
    odd_after = (F.col("quotes") + _count(F.col("plain"), '"')) % 2 == 1
    quote = lambda cond: F.when(cond, F.lit('"')).otherwise(F.lit(""))      # noqa: E731
    outside = F.regexp_replace(F.concat(quote(odd), "plain", quote(odd_after)), '"[^"]*"', "")
    known = quoted.select(*pieces.columns, odd.alias("in_string"), odd_after.alias("in_string_after"),
                          _count(outside, "[").alias("opens"), F.when(odd_after | ~F.col("ended"), 0).otherwise(1).alias("closes"))
    deep = _before(known, F.col("opens") - F.col("closes"), "depth")
    return deep.withColumn("depth_after", F.col("depth") + F.col("opens") - F.col("closes"))


def _with_end(pieces: DataFrame) -> DataFrame:
    """Which pieces a ``]`` ended: all but a file's last one, unless the bytes of the
    pieces and of a ``]`` for each are those of the file."""
    sizes = pieces.groupBy("file").agg((F.sum(F.octet_length("value") + 1)).alias("__bytes"),
                                       F.max(F.struct("block", "at")).alias("__last"))
    ended = (F.col("__bytes") == F.col("size")) | (F.struct("block", "at") != F.col("__last"))
    return pieces.join(sizes, "file").withColumn("ended", ended).drop("__bytes", "__last")


def malformed_files(described: DataFrame) -> DataFrame:
    """Files that are not one array of arrays, as far as brackets and quotes tell."""
    outer = F.sum(F.when((F.col("closes") == 1) & (F.col("depth_after") == 0), 1).otherwise(0))
    last = F.max_by(F.struct("depth_after", "in_string_after"), F.struct("block", "at"))
    return described.where("trim(value) <> '' or ended").groupBy("file").agg(
        outer.alias("n"), last.alias("last"), F.min("depth_after").alias("low")).where(
        (F.col("n") != 1) | (F.col("last.depth_after") != 0) | F.col("last.in_string_after") | (F.col("low") < 0)).select("file")


def read_documents_split(spark: SparkSession, path: str) -> DataFrame:
    """``row array<string>`` of every inner array below ``path``, as
    ``read_state_vectors(layout="document")`` gives them; text that is no array of
    arrays aborts."""
    # stored once: a piece's place must be the same in every pass
    described = _stored(_described(_with_end(_stored(_pieces(spark, path), "document-pieces"))), "document-places")
    bad = [r["file"] for r in malformed_files(described).limit(20).collect()]
    if bad:
        raise ValueError(f"MALFORMED INPUT in {bad}")
    ends_row = (F.col("closes") == 1) & (F.col("depth_after") == 1)
    begins_row = (F.col("depth") <= 1) & ~F.col("in_string")
    whole = described.where(ends_row & begins_row).select("file", F.concat("value", F.lit("]")).alias("text"),
                                                          (F.col("depth") == 0).alias("first"))
    numbered = _before(described, ends_row.cast("int"), "row_no").where(~(ends_row & begins_row))
    fragment = F.concat("value", F.when(F.col("ended"), F.lit("]")).otherwise(F.lit("")))
    joined = numbered.groupBy("file", "row_no").agg(
        F.array_sort(F.collect_list(F.struct("block", "at", fragment.alias("value")))).alias("parts"),
        F.min("depth").alias("depth"), F.max(ends_row).alias("row")).select(
        "file", F.array_join(F.transform("parts", lambda p: p["value"]), "").alias("text"), (F.col("depth") == 0).alias("first"), "row")
    # what is no row is the rest of a file after its last one: the closing bracket
    rest = F.regexp_replace("text", r"\s+", "")
    rest_ok = rest.isin("", "]") | (F.col("first") & rest.isin("[]"))
    rows = whole.withColumn("row", F.lit(True)).unionByName(joined).where("row or trim(text) <> ''")
    lead = F.when(F.col("first"), F.regexp_replace("text", r"^\s*\[\s*", "")).otherwise(F.regexp_replace("text", r"^\s*,\s*", ""))
    comma = F.col("first") | F.col("text").rlike(r"^\s*,")
    parsed = F.when(comma, F.from_json(lead, ROW_TYPE))
    fail = F.raise_error(F.concat(F.lit("MALFORMED INPUT in "), "file"))
    checked = rows.select(F.when(F.col("row"), F.coalesce(parsed, fail)).when(rest_ok, F.lit(None)).otherwise(fail).alias("parsed"), "row")
    return checked.where("row or parsed is not null").select(F.col("parsed").alias("row"))
