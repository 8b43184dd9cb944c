"""Filter interaction audit by an existential self-join (operator 12).

Which filter removes what depends on the order in which filters are applied.  The
audit finds, for each document, the set of filters that it fails, counts the
combinations, and derives every order of the filters from those counts.

A to D look at one text (``row_failures``).  E, an exact copy of the text of a
smaller doc_id, is a left-semi self-join on hash, exact text and smaller doc_id.
That some smaller id exists is the same as that the least one is smaller, so the
right side is reduced first: one row for each text that occurs twice and more, with
its least doc_id (combined map-side, so a hot text is one row a task).  The left
side keeps all its rows; a hot hash is split by adaptive execution, since the right
side of it is one row.  The ids that E marks are united with the ids that fail
A to D, and the union's bits are combined for each id.

No order is applied to documents: 32 combinations a part, with their counts, tell
all 120 orders.  These rows stay in Spark, since parts may be many.

Defined results: null text is the empty text, null source the part ''.  A row
without doc_id is no copy of anything and no label belongs to it; it counts like
any other.  Rows that repeat a doc_id count each by their own text; among
themselves they are no copies, since no id is smaller.  Several labels of one
doc_id: one with the value 1 is enough.  Other columns are ignored.  An empty table
has no parts and no rows.
"""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import stored

FILTERS = "ABCDE"
BIT = {f: 1 << i for i, f in enumerate(FILTERS)}

MIN_WORDS = 50              # A: fewer words
MIN_DISTINCT_PERCENT = 65   # B: fewer distinct words among them
MAX_CAPITAL_PERCENT = 5     # C: more capitals among the code points
SYMBOLS = "[#$%&*|]"        # D: any of these

BLANKS = "[\\x20\\x09-\\x0D]+"


def row_failures(words: str, text: str) -> Column:
    """The bits of A to D from a column of words and the text."""
    n = F.size(words)
    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    failing = {
        "A": n < MIN_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < MIN_DISTINCT_PERCENT * n,
        "C": 100 * capitals > MAX_CAPITAL_PERCENT * F.char_length(text),
        "D": F.col(text).rlike(SYMBOLS),
    }
    bits = [F.when(cond, F.lit(BIT[f])).otherwise(F.lit(0)) for f, cond in failing.items()]
    return bits[0] + bits[1] + bits[2] + bits[3]


def prepared(docs: DataFrame) -> DataFrame:
    """(doc_id, part, text, hash) of ``docs`` (doc_id, source, text)."""
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       text.alias("text"), F.xxhash64(text).alias("hash"))


def text_copies(rows: DataFrame) -> DataFrame:
    """The rows (doc_id, part, text, hash) whose text a smaller doc_id has too."""
    firsts = rows.where("doc_id is not null").groupBy("hash", "text").agg(
        F.min("doc_id").alias("least"), F.max("doc_id").alias("_most")).where("least < _most").drop("_most")
    least = stored(firsts, "audit-firsts").toDF("_hash", "_text", "least")
    return rows.join(least, (F.col("hash") == F.col("_hash")) & (F.col("text") == F.col("_text")) & (
        F.col("least") < F.col("doc_id")), "left_semi")


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, bits, n, n_good, n_toxic): documents by the filters that they fail, of
    ``docs`` (doc_id, source, text) and ``labels`` (doc_id, quality, toxic)."""
    rows = prepared(docs)
    words = F.array_remove(F.split("text", BLANKS), "")
    slim = stored(rows.withColumn("words", words).select(
        "doc_id", "part", "hash", row_failures("words", "text").alias("bits")), "audit-rows")
    copies = text_copies(rows).select("doc_id", "part", "hash", F.lit(BIT["E"]).alias("bits"))

    # a row is told by doc_id, part and hash; rows equal in these fail the same filters
    # and are in the same sides of the union, so the larger count is their number
    union = slim.where("bits <> 0").withColumn("e", F.lit(0)).unionByName(copies.withColumn("e", F.lit(1)))
    failing = union.groupBy("doc_id", "part", "hash").agg(
        F.bit_or("bits").alias("bits"), F.greatest(F.sum("e"), F.sum(1 - F.col("e"))).alias("n"))
    one = lambda c: F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias(c)      # noqa: E731
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(one("quality"), one("toxic"))
    counted = failing.join(known, F.col("doc_id") == F.col("_id"), "left").groupBy("part", "bits").agg(
        F.sum("n").alias("n"), F.coalesce(F.sum(F.col("n") * F.col("quality")), F.lit(0)).alias("n_good"),
        F.coalesce(F.sum(F.col("n") * F.col("toxic")), F.lit(0)).alias("n_toxic"))
    # documents that fail nothing: all of the part less those that fail
    all_rows = slim.groupBy("part").agg(F.count("*").alias("n")).select(
        "part", F.lit(0).alias("bits"), "n", F.lit(0).alias("n_good"), F.lit(0).alias("n_toxic"))
    less = counted.select("part", F.lit(0).alias("bits"), (-F.col("n")).alias("n"), F.lit(0).alias("n_good"),
                          F.lit(0).alias("n_toxic"))
    return all_rows.unionByName(less).unionByName(counted).groupBy("part", "bits").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("n", "n_good", "n_toxic")])


def orders() -> Column:
    """All orders of the filters, step by step: filter_order, step, the step's
    filter (``own``) and those before it (``earlier``)."""
    steps = []
    for order in itertools.permutations(FILTERS):
        earlier = 0
        for step, f in enumerate(order, 1):
            steps.append(f"struct('{''.join(order)}' as filter_order, {step} as step, {BIT[f]} as own, {earlier} as earlier)")
            earlier |= BIT[f]
    return F.expr(f"array({', '.join(steps)})")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order and step: (part, filter_order, step, kept,
    removed, redundant, unique_fails, good_lost, toxic_lost, shapley)."""
    counts = stored(combinations(docs, labels), "audit-combinations")
    own, earlier, bits, n = F.col("own"), F.col("earlier"), F.col("bits"), F.col("n")
    fails, survived = bits.bitwiseAND(own) != 0, bits.bitwiseAND(earlier) == 0
    total = lambda cond, of=n: F.sum(F.when(cond, of).otherwise(0)).cast("bigint")     # noqa: E731
    # a filter removes a document in the orders that put it first of those that the
    # document fails: 1 in k of all orders
    share = F.expr(f"{math.factorial(len(FILTERS))} div bit_count(bits)")
    spread = counts.select("*", F.inline(orders()))
    return spread.groupBy("part", "filter_order", "step").agg(
        total(survived & ~fails).alias("kept"),
        total(survived & fails).alias("removed"),
        total(~survived & fails).alias("redundant"),
        total(bits == own).alias("unique_fails"),
        total(survived & fails, F.col("n_good")).alias("good_lost"),
        total(survived & fails, F.col("n_toxic")).alias("toxic_lost"),
        total(fails, n * share).alias("shapley"))
