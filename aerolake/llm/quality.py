"""Quality rules with robust multivariate outliers (operator 4).

Every text gets plain counts (``text_statistics``) and fails the base rules by
them alone.  The others are described by a vector of transformed statistics, and
for each language and source the centre and covariance of the vectors are found
by minimum covariance determinant: start from medians and median deviations,
then repeatedly take the ``SHARE`` of rows nearest by Mahalanobis distance and
estimate from these (concentration steps), in each group until the determinant
falls no more.  Half of the rows is the share with the highest breakdown point:
junk that makes up less than half of a group can't hide itself.  Scaled to the
median distance, re-estimated once from the rows within the 97.5 % quantile, and
a row is rejected when its squared distance exceeds the chi-squared quantile
``CUTOFF``.

A group's rows are never brought together: quantiles come from histograms of
fixed bins and moments from sums, both combined map-side, so a source with a
third of all rows is no burden; only per-group estimates are computed in one
place, one row a group.  Groups below ``MIN_GROUP`` rows are pooled, first
within their language, then all together; without enough rows there is no
verdict and every row that passes the base rules is kept.

Defined results: a null or empty text has zero counts and fails the base rules;
null languages and sources are groups of their own.  Repeated rows are judged
each.  Variances have a floor (``FLOORS``), so that a statistic that is
constant in a group rejects only what is clearly off.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.llm.common import stored

SHARE = 0.5             # of a group's rows that an estimate rests on
STEPS = 50              # concentration steps at most; a group stops when its determinant does
FALL = 1e-9             # of a log determinant, to count as falling
MIN_GROUP = 100
CUTOFF = 1 - 1e-6
VALUE_BINS = 64         # bins per unit of a transformed statistic
DISTANCE_BINS = 32      # bins per doubling of a squared distance

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def count_statistics(text: str | None) -> tuple[int, int, int, int, int]:
    """``COUNTS`` of one text; words are runs of anything but blanks and 0x09-0x0D."""
    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()         # splits bytes at exactly those six characters
    chars = len(text) - sum(map(text.count, BLANKS))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(words), chars, symbols, len(lines) - len(set(lines)), _repeated(words)


def _repeated(words: list[bytes]) -> int:
    """Words that lie in a 5-word window found twice or more."""
    windows = list(zip(words, words[1:], words[2:], words[3:], words[4:]))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    covered, end = 0, 0
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered += i + 5 - max(i, end)
            end = i + 5
    return covered


def text_statistics(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` plus ``COUNTS`` and ``base_failed``; the text itself is dropped.  Columns
    of ``df`` with these names are replaced."""
    df = df.select(*[c for c in df.columns if c.lower() not in (*COUNTS, "base_failed")])
    at = df.columns.index(text_col)
    fields = [f for f in df.schema.fields if f.name != text_col]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [count_statistics(t) for t in batch.column(at).to_pylist()]
            columns = [c for i, c in enumerate(batch.columns) if i != at]
            columns += [pa.array([c[k] for c in counts], pa.int64()) for k in range(len(COUNTS))]
            yield pa.RecordBatch.from_arrays(columns, [*(f.name for f in fields), *COUNTS])

    out = df.mapInArrow(run, T.StructType([*fields, *(T.StructField(c, T.LongType()) for c in COUNTS)]))
    return out.withColumn("base_failed", (F.col("n_words") < 10) | (
        100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


# name, transformed statistic, floor of its standard deviation
VECTOR = (
    ("length", F.log1p, "n_words", None, 0.5),
    ("word_length", None, "word_chars", "n_words", 1.0),
    ("symbols", F.log1p, "1000.0 * n_symbols", "word_chars", 0.6),
    ("dup_lines", F.log1p, "1000.0 * n_dup_lines", "n_words", 0.6),
    ("repeats", F.log1p, "100.0 * n_repeat_words", "n_words", 0.6),
)
NAMES = [v[0] for v in VECTOR]
FLOORS = np.array([v[4] for v in VECTOR])
P = len(NAMES)
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]


def _vector() -> list[F.Column]:
    out = []
    for name, transform, top, below, _ in VECTOR:
        value = F.expr(f"({top}) / {below}" if below else top).cast("double")
        out.append((transform(value) if transform else value).alias(name))
    return out


def chi2_quantile(q: float, p: int) -> float:
    """Wilson-Hilferty approximation."""
    z = NormalDist().inv_cdf(q)
    return p * (1 - 2 / (9 * p) + z * math.sqrt(2 / (9 * p))) ** 3


def _quantile_bins(binned: DataFrame, keys: list[str], share: float) -> DataFrame:
    """Per ``keys``: the least ``bin`` with at least ``share`` of the rows up to it."""
    hist = binned.groupBy(*keys, "bin").agg(F.count("*").alias("n"))
    w = Window.partitionBy(*keys)
    upto = F.sum("n").over(w.orderBy("bin"))
    return hist.select(*keys, "bin", upto.alias("upto"), F.sum("n").over(w).alias("all")).where(
        F.col("upto") >= F.col("all") * share).groupBy(*keys).agg(F.min("bin").alias("bin"))


def _long(rows: DataFrame, values: list[F.Column]) -> DataFrame:
    """One row (group, k, x) per statistic."""
    return rows.select("group", F.posexplode(F.array(*values)).alias("k", "x"))


def _start(rows: DataFrame) -> DataFrame:
    """``ESTIMATES`` from medians and median absolute deviations, any step falls from it."""
    to_bin = lambda x: F.round(x * VALUE_BINS).cast("int")
    middle = _quantile_bins(_long(rows, [F.col(n) for n in NAMES]).select(
        "group", "k", to_bin(F.col("x")).alias("bin")), ["group", "k"], 0.5)
    middle = stored(middle.withColumnRenamed("bin", "mid"), "quality-medians")
    centre = middle.groupBy("group").agg(F.array_sort(F.collect_list(F.struct("k", "mid"))).alias("m"))
    centred = rows.join(centre, "group").select("group", *(
        F.abs(F.col(n) - F.col("m")[i]["mid"] / VALUE_BINS).alias(n) for i, n in enumerate(NAMES)))
    spread = _quantile_bins(_long(centred, [F.col(n) for n in NAMES]).select(
        "group", "k", to_bin(F.col("x")).alias("bin")), ["group", "k"], 0.5)
    both = middle.join(spread, ["group", "k"]).groupBy("group").agg(
        F.array_sort(F.collect_list(F.struct("k", "mid", "bin"))).alias("v"))
    deviation = lambda i: F.col("v")[i]["bin"] * (1.4826 / VALUE_BINS)
    return both.select("group", F.array(*(F.col("v")[i]["mid"] / VALUE_BINS for i in range(P))).alias("centre"), F.array(*(
        (1 / (deviation(i) * deviation(i) + float(FLOORS[i] ** 2)) if i == j else F.lit(0.0)) for i, j in PAIRS)).alias("precision"),
        F.lit(math.inf).alias("spread"))


def _distance() -> F.Column:
    """Squared Mahalanobis distance to ``centre`` by ``precision`` (upper triangle)."""
    y = [F.col(n) - F.col("centre")[i] for i, n in enumerate(NAMES)]
    total = F.lit(0.0)
    for k, (i, j) in enumerate(PAIRS):
        total = total + F.col("precision")[k] * y[i] * y[j] * (1.0 if i == j else 2.0)
    return total


def _distance_bin(d2: F.Column) -> F.Column:
    return F.floor(F.log2(F.greatest(d2, F.lit(0.0)) + 2.0 ** -20) * DISTANCE_BINS).cast("int")


def _invert(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (group, n, old centre, sums, products) -> ``ESTIMATES``."""
    for batch in batches:
        groups, centres, precisions, spreads = [], [], [], []
        for g, n, old, sums, products in zip(*(c.to_pylist() for c in batch.columns)):
            mean = np.array(sums) / n
            cov = np.zeros((P, P))
            for (i, j), s in zip(PAIRS, products):
                cov[i, j] = cov[j, i] = s / n - mean[i] * mean[j]
            cov += np.diag(FLOORS ** 2)
            precision = np.linalg.inv(cov)
            groups.append(g)
            centres.append((np.array(old) + mean).tolist())
            precisions.append([float(precision[i, j]) for i, j in PAIRS])
            spreads.append(float(np.linalg.slogdet(cov)[1]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(groups, pa.string()), pa.array(centres, pa.list_(pa.float64())),
             pa.array(precisions, pa.list_(pa.float64())), pa.array(spreads, pa.float64())],
            ["group", "centre", "precision", "spread"])


# spread: the logarithm of the covariance's determinant
ESTIMATES = "group string, centre array<double>, precision array<double>, spread double"


def _from_rows(near: DataFrame) -> DataFrame:
    """Estimates from the rows of ``near``, taken about the ``centre`` they have."""
    y = [F.col(n) - F.col("centre")[i] for i, n in enumerate(NAMES)]
    sums = near.groupBy("group").agg(
        F.count("*").alias("n"), F.first("centre").alias("centre"), *(F.sum(v).alias(f"s{i}") for i, v in enumerate(y)),
        *(F.sum(y[i] * y[j]).alias(f"p{i}_{j}") for i, j in PAIRS))
    return sums.select("group", "n", "centre", F.array(*(f"s{i}" for i in range(P))).alias("sums"),
                       F.array(*(f"p{i}_{j}" for i, j in PAIRS)).alias("products")).mapInArrow(_invert, ESTIMATES)


def _with_scale(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """``estimates`` with the precision such that the median distance is that of a normal sample."""
    middle = _quantile_bins(rows.join(estimates, "group").select(
        "group", _distance_bin(_distance()).alias("bin")), ["group"], 0.5)
    # a group may be tighter than the floors allow: never shrink below them
    factor = F.least(F.lit(1.0), F.lit(chi2_quantile(0.5, P)) / F.pow(F.lit(2.0), (F.col("bin") + 1) / DISTANCE_BINS))
    return estimates.join(middle, "group").select("group", "centre", F.transform(
        "precision", lambda v: v * factor).alias("precision"))


def estimate(rows: DataFrame, share: float = SHARE, steps: int = STEPS) -> DataFrame:
    """(group, centre, precision) by minimum covariance determinant of ``rows``
    (group and the columns ``NAMES``)."""
    found = stored(_start(rows).withColumn("falling", F.lit(True)), "quality-estimates")
    for _ in range(steps):
        measured = rows.join(found.where("falling"), "group").withColumn("bin", _distance_bin(_distance()))
        limit = stored(_quantile_bins(measured, ["group"], share).withColumnRenamed("bin", "limit"), "quality-limits")
        moved = _from_rows(measured.join(limit, "group").where("bin <= limit"))
        # a step that doesn't lower the determinant is not taken, and the last of its group
        falls = F.coalesce(F.col("m.spread") < F.col("f.spread") - FALL, F.lit(False))
        found = stored(found.alias("f").join(moved.alias("m"), "group", "left").select("group", *(
            F.when(falls, F.col(f"m.{c}")).otherwise(F.col(f"f.{c}")).alias(c) for c in ("centre", "precision", "spread")),
            falls.alias("falling")), "quality-estimates")
        if found.where("falling").isEmpty():
            break
    found = stored(_with_scale(rows, found), "quality-estimates")
    inside = rows.join(found, "group").where(_distance() <= chi2_quantile(0.975, P))
    return stored(_with_scale(rows, _from_rows(inside)), "quality-estimates")


def _groups(rows: DataFrame, min_group: int) -> DataFrame:
    """(lang, source, group): groups too small are pooled per language, then together."""
    sizes = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    by_source = F.to_json(F.struct("lang", "source"))
    by_lang = F.concat(F.lit("pooled "), F.coalesce(F.to_json(F.struct("lang")), F.lit("")))
    w_lang = Window.partitionBy("lang", "_small")
    pooled = sizes.withColumn("_small", F.col("n") < min_group).withColumn("_lang_n", F.sum("n").over(w_lang))
    return pooled.select("lang", "source", F.when(~F.col("_small"), by_source).when(
        F.col("_lang_n") >= min_group, by_lang).otherwise(F.lit("pooled")).alias("group"))


def judge(statistics: DataFrame, share: float = SHARE, cutoff: float = CUTOFF, min_group: int = MIN_GROUP) -> DataFrame:
    """``statistics`` (of ``text_statistics``, with lang and source) plus group,
    distance (squared, null without a verdict) and kept.  Columns with these names are
    replaced, all others are carried along whatever they are called."""
    carried = [c for c in statistics.columns if c.lower() not in ("group", "distance", "kept")]
    rows = stored(statistics.select(F.struct(*carried).alias("_row")), "quality-statistics")
    passed = rows.where(~F.col("_row.base_failed")).select("_row", *[F.col(f"_row.{c}").alias(c) for c in ("lang", "source", *COUNTS)])
    groups = stored(_groups(passed, min_group), "quality-groups")
    same = F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source"))
    grouped = stored(passed.join(groups.toDF("_lang", "_source", "group"), same).drop("_lang", "_source").select(
        "*", *_vector()), "quality-vectors")
    large = grouped.groupBy("group").agg(F.count("*").alias("n")).where(F.col("n") >= min_group).select("group")
    found = estimate(grouped.join(large, "group", "left_semi").select("group", *NAMES), share)
    judged = grouped.join(found, "group", "left").withColumn("distance", _distance())
    out = judged.select("_row.*", "group", "distance",
                        F.coalesce(F.col("distance") <= chi2_quantile(cutoff, P), F.lit(True)).alias("kept"))
    failed = rows.where("_row.base_failed").select("_row.*", F.lit(None).cast("string").alias("group"),
                                              F.lit(None).cast("double").alias("distance"), F.lit(False).alias("kept"))
    return out.unionByName(failed)
