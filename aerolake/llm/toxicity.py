"""Toxicity by maximum-scoring segment search (operator 3).

Fit.  Every token has a log-odds ratio between toxic and clean training text
under an informative Dirichlet prior whose pseudo-counts follow the token
frequencies of *all* documents; the ratio is shrunk towards 0 by a multiple of
its standard error, so rare tokens say nothing.  A word is counted as itself and
as its prefixes (inflected and compound forms share a stem) and takes the ratio
of the form that says most; it counts once a document, so that repetition within
one text is no evidence.  Forms are counted under 64-bit keys in a table that
grows with the corpus and stays distributed.  Only forms with a ratio other than
0 leave it: these need labelled evidence or a good part of the prior, so the
labelled sample and ``PRIOR_TOKENS`` bound the model.

Scan.  Token scores minus a drift have a negative mean in clean text.  A
linear-time scan finds all maximal scoring segments of a document.  Under the
clean token distribution the best segment of n tokens follows an extreme-value
law, P(S >= s) = 1 - exp(-K n exp(-lambda s)): lambda solves
E[exp(lambda x)] = 1 and K is the moment estimate from clean training documents.
A segment with K n exp(-lambda s) < 1 is significant.

Aggregate.  The evidence of a document is the sum over significant segments of
-log E-value; a logistic curve over log(1 + evidence), fitted to the training
documents' histogram, turns it into a score in (0, 1).

Cost: one pass over all documents for the counts (rows to the shuffle: the
different words of a task; forms are made of the aggregated words), one over the
training documents, whose word scores are kept, one for the scores.  The documents
are never shuffled: the training labels are a bounded sample (``MAX_TRAINING_ROWS``)
and broadcast.

Defined results: null or empty text has no tokens and evidence 0, and is scored
like any document without a significant segment.  Without training rows of both
classes every score is the share of toxic rows (0 without rows).  A document
labelled more than once counts as toxic if one of its labels says so.
"""

from __future__ import annotations

import collections
import dataclasses
import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.llm.common import released, stored

MAX_TRAINING_ROWS = 100_000     # bound of the labelled sample (a hash sample beyond it)
PRIOR_TOKENS = 5_000.0          # weight of the prior, in tokens
SHRINK_SD = 3.0                 # standard errors taken off every log-odds ratio
DRIFT = 0.1                     # per-token cost of extending a segment, over the clean mean
STEPS = 64                      # per unit of word score, for its distribution in clean text
BINS_PER_UNIT = 16              # of log(1 + evidence), for the calibration histogram

PREFIXES = range(3, 8)          # lengths of the prefixes that a word counts for
LONGEST_WHOLE = 12              # longer words count by their prefixes only
WORDS_HELD = 150_000            # distinct words a counting task holds
SCORES_HELD = 250_000           # words whose score a task remembers, in each of two generations

TOKEN = re.compile(r"[^\W\d_]+")
PASSAGE = "array<struct<start:int,end:int,score:double,evalue:double>>"


@dataclasses.dataclass(frozen=True)
class ToxicityModel:
    ratios: dict[int, float] | None     # shrunk log-odds other than 0, by the key of a form; None: no model
    drift: float = 0.0
    lam: float = 1.0
    k: float = 1.0
    slope: float = 0.0
    intercept: float = -50.0


def words_of(text: str | None) -> list[str]:
    return TOKEN.findall(text.lower()) if text else []


def forms(word: str) -> list[int]:
    """Keys (64-bit hashes) of the word itself and of its prefixes."""
    names = [word[:n] + "-" for n in PREFIXES if n < len(word)]
    if len(word) <= LONGEST_WHOLE:
        names.append(word)
    return [xxhash.xxh3_64_intdigest(name.encode("utf-8", "surrogatepass")) for name in names]


class WordScores(dict):
    """word -> the score of its most telling form, remembering a bounded number."""

    def __init__(self, ratios: dict[int, float], drift: float):
        super().__init__()
        self.ratios, self.drift = ratios, drift
        self.older: dict[str, float] = {}

    def __missing__(self, word: str) -> float:
        value = self.older.get(word)
        if value is None:
            value = max((self.ratios.get(k, 0.0) for k in forms(word)), key=abs, default=0.0) - self.drift
        if len(self) >= SCORES_HELD:
            self.older = dict(self)
            self.clear()
        self[word] = value
        return value

    def of(self, text: str | None) -> np.ndarray:
        return np.array(list(map(self.__getitem__, words_of(text))), dtype=np.float64)


def maximal_segments(x: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of ``x``, in order.

    Runs of positive values are joined first; the scan keeps a list of candidate
    segments with the cumulative sums before and after each, and every candidate
    enters and leaves the list once.
    """
    positive = np.flatnonzero(x > 0)
    if not len(positive):
        return []
    total = np.concatenate(([0.0], np.cumsum(x)))
    breaks = np.flatnonzero(np.diff(positive) > 1)
    firsts = positive[np.concatenate(([0], breaks + 1))]
    lasts = positive[np.concatenate((breaks, [len(positive) - 1]))] + 1
    stack: list[tuple[int, int, float, float, int]] = []    # start, end, sum before, sum after, link
    for start, end, before, after in zip(firsts.tolist(), lasts.tolist(),
                                         total[firsts].tolist(), total[lasts].tolist()):
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= before:      # the nearest with a smaller sum before it
                j = stack[j][4]
            if j < 0 or stack[j][3] >= after:
                stack.append((start, end, before, after, j))
                break
            start, before = stack[j][0], stack[j][2]
            del stack[j:]
    return [(s, e, a - b) for s, e, b, a, _ in stack]


def _map(df: DataFrame, run, schema) -> DataFrame:
    return df.mapInArrow(released(run), schema)


def _training_rows(labels: DataFrame, max_rows: int) -> DataFrame:
    """At most about ``max_rows`` (doc_id, y), chosen by a hash of the id."""
    rows = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(
        F.max(F.col("toxic").cast("int")).alias("_y"))
    share = max_rows / max(1, rows.count())
    if share < 1:
        rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(share * 1_000_000))
    return rows.withColumnRenamed("doc_id", "_id")


def _word_counts(docs: DataFrame, training: DataFrame) -> DataFrame:
    """(word, n_all, n_clean, n_toxic) over every document; a word counts once a document."""
    joined = docs.join(F.broadcast(training), F.col("doc_id") == F.col("_id"), "left").select("text", "_y")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_label = [collections.Counter() for _ in range(3)]    # clean, toxic, unlabelled

        def rows() -> Iterator[pa.RecordBatch]:
            for at, words in enumerate(by_label):
                n = pa.array(list(words.values()), pa.int64())
                none = pa.array(np.zeros(len(words), dtype=np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(words), pa.string()), n, n if at == 0 else none, n if at == 1 else none],
                    ["word", "n_all", "n_clean", "n_toxic"])
                words.clear()

        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_label[2 if y is None else int(y > 0)].update(set(words_of(text)))
            if sum(map(len, by_label)) > WORDS_HELD:
                yield from rows()
        yield from rows()

    return _map(joined, run, "word string, n_all bigint, n_clean bigint, n_toxic bigint").groupBy("word").agg(
        *(F.sum(c).alias(c) for c in ("n_all", "n_clean", "n_toxic")))


def _form_counts(words: DataFrame) -> DataFrame:
    """(form, n_all, n_clean, n_toxic) from the counts of words."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [forms(word) for word in batch.column(0).to_pylist()]
            keys, where = np.unique(np.array([k for f in found for k in f], dtype=np.uint64), return_inverse=True)
            times = [len(f) for f in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)),
                 *(pa.array(np.bincount(where, weights=np.repeat(batch.column(i).to_numpy(), times),
                                        minlength=len(keys)).astype(np.int64)) for i in (1, 2, 3))],
                ["form", "n_all", "n_clean", "n_toxic"])

    rows = _map(words.select("word", "n_all", "n_clean", "n_toxic"), run,
                "form bigint, n_all bigint, n_clean bigint, n_toxic bigint")
    return rows.groupBy("form").agg(*(F.sum(c).alias(c) for c in ("n_all", "n_clean", "n_toxic")))


def _form_ratios(counts: DataFrame, totals: tuple[float, float, float]) -> DataFrame:
    """(form, ratio) where the ratio is not 0."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ratios = log_odds(*(batch.column(i).to_numpy().astype(float) for i in (1, 2, 3)), totals=totals)
            at = np.flatnonzero(ratios)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(ratios[at])], ["form", "ratio"])

    return _map(counts.select("form", "n_all", "n_clean", "n_toxic"), run, "form bigint, ratio double")


def log_odds(n_all: np.ndarray, n_clean: np.ndarray, n_toxic: np.ndarray,
             prior_tokens: float = PRIOR_TOKENS, shrink_sd: float = SHRINK_SD,
             totals: tuple[float, float, float] | None = None) -> np.ndarray:
    """Shrunk log-odds ratios, toxic over clean, with Dirichlet pseudo-counts in
    proportion to ``n_all``; ``totals`` are the sums of n_all + 0.5, n_clean and
    n_toxic over all forms where the arrays are a part of them."""
    all_total, clean_total, toxic_total = totals or (n_all.sum() + 0.5 * len(n_all), n_clean.sum(), n_toxic.sum())
    alpha = prior_tokens * (n_all + 0.5) / all_total
    toxic, clean = n_toxic + alpha, n_clean + alpha
    delta = (np.log(toxic) - np.log(toxic_total + prior_tokens - toxic)
             - np.log(clean) + np.log(clean_total + prior_tokens - clean))
    error = np.sqrt(1 / toxic + 1 / clean)
    return np.sign(delta) * np.maximum(0.0, np.abs(delta) - shrink_sd * error)


def solve_lambda(x: np.ndarray, p: np.ndarray) -> float:
    """The positive root of sum(p * exp(lambda * x)) = 1 (mean of x below 0)."""
    if not (x[p > 0] > 0).any():
        return 1.0
    low, high = 1e-6, 1.0
    while high < 64 and float((p * np.exp(np.minimum(high * x, 500))).sum()) < 1:
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        if float((p * np.exp(np.minimum(mid * x, 500))).sum()) < 1:
            low = mid
        else:
            high = mid
    return (low + high) / 2


def fit_logistic(z: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, float]:
    """Weighted logistic regression of y on one variable, slope at least 0."""
    a, b = 1.0, -1.0
    for _ in range(100):
        q = 1 / (1 + np.exp(-np.clip(a * z + b, -40, 40)))
        g = np.array([(w * (y - q) * z).sum() - 1e-3 * a, (w * (y - q)).sum()])
        v = w * q * (1 - q) + 1e-9
        h = np.array([[(v * z * z).sum() + 1e-3, (v * z).sum()], [(v * z).sum(), v.sum()]])
        step = np.clip(np.linalg.solve(h, g), -2, 2)
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return max(float(a), 0.0), float(b)


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAINING_ROWS) -> ToxicityModel:
    """``docs`` (doc_id, text); ``labels`` (doc_id, toxic): the rows to learn from."""
    docs = docs.select("doc_id", "text")
    training = _training_rows(labels, max_rows)
    counts = stored(_form_counts(_word_counts(docs, training)), "toxicity-forms")
    n_forms, *sums = counts.agg(F.count("*"), *(F.coalesce(F.sum(c), F.lit(0)) for c in ("n_all", "n_clean", "n_toxic"))).first()
    if not sums[1] or not sums[2]:
        n, toxic = training.agg(F.count("*"), F.sum("_y")).first()
        share = (toxic or 0) / n if n else 0.0
        return ToxicityModel(None, drift=1.0, intercept=math.log(max(share, 1e-20) / max(1 - share, 1e-20)))
    found = _form_ratios(counts, (sums[0] + 0.5 * n_forms, sums[1], sums[2])).toArrow()     # bounded by the sample
    ratios = dict(zip(found["form"].to_numpy().view(np.uint64).tolist(), found["ratio"].to_pylist()))
    # the training texts are read and cut into words once: their word scores are kept
    sample = stored(_map(docs.join(F.broadcast(training), F.col("doc_id") == F.col("_id")).select("text", "_y"),
                         _sample_scores(ratios), "y int, scores binary"), "toxicity-sample")
    # how often clean text has which word score (in steps of 1 / STEPS)
    clean = _map(sample.where("y = 0").select("scores"), _score_histogram, "step int, n bigint").groupBy(
        "step").agg(F.sum("n").alias("n")).toArrow()
    x, p = clean["step"].to_numpy() / STEPS, clean["n"].to_numpy().astype(float)
    p /= max(1.0, p.sum())
    drift = max(0.0, float((p * x).sum())) + DRIFT
    lam = solve_lambda(x - drift, p)

    segments = stored(_map(sample, _segment_sums(drift), "y int, n int, sums array<double>"),
                      "toxicity-training")
    best = F.coalesce(F.array_max("sums"), F.lit(0.0))
    k_log = segments.where("y = 0 and n > 0").agg(
        F.avg(F.lit(lam) * best - F.log("n"))).first()[0]
    # the mean of a Gumbel variable is its location plus Euler's constant
    k = math.exp((k_log if k_log is not None else 0.0) - 0.5772156649015329)
    model = ToxicityModel(ratios, drift, lam, k)
    evidence = F.aggregate("sums", F.lit(0.0), lambda s, v: s + F.greatest(
        F.lit(0.0), F.lit(lam) * v - F.log(F.lit(k) * F.col("n"))))
    bins = segments.select("y", F.round(F.log1p(evidence) * BINS_PER_UNIT).cast("int").alias("bin")).groupBy(
        "bin").agg(F.count("*").alias("n"), F.sum("y").alias("toxic")).toArrow()    # a few hundred rows
    z = bins["bin"].to_numpy() / BINS_PER_UNIT
    n, toxic = bins["n"].to_numpy().astype(float), bins["toxic"].to_numpy().astype(float)
    slope, intercept = fit_logistic(np.concatenate((z, z)), np.repeat([1.0, 0.0], len(z)),
                                    np.concatenate((toxic, n - toxic)))
    return dataclasses.replace(model, slope=slope, intercept=intercept)


def _sample_scores(ratios: dict[int, float]):
    """Rows (text, label) as (label, the word scores as 64-bit floats)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = WordScores(ratios, 0.0)
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).cast(pa.int32()),
                 pa.array([scores.of(text).tobytes() for text in batch.column(0).to_pylist()], pa.binary())], ["y", "scores"])
    return run


def _score_histogram(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        all_scores = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype=np.float64)
        at, n = np.unique(np.rint(all_scores * STEPS).astype(np.int32), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n.astype(np.int64))], ["step", "n"])


def _segment_sums(drift: float):
    """Rows (label, word scores) as (label, number of words, sums of the segments)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ns, sums = [], []
            for scores in batch.column(1).to_pylist():
                x = np.frombuffer(scores, dtype=np.float64) - drift
                ns.append(len(x))
                sums.append([s for _, _, s in maximal_segments(x)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ns, pa.int32()), pa.array(sums, pa.list_(pa.float64()))],
                ["y", "n", "sums"])
    return run


def score_words(x: np.ndarray, model: ToxicityModel) -> tuple[float, list[dict]]:
    """Score and significant passages (word positions) of one text's word scores."""
    passages, evidence, n = [], 0.0, len(x)
    for start, end, s in maximal_segments(x) if n else ():
        log_e = math.log(model.k * n) - model.lam * s
        if log_e < 0:
            evidence -= log_e
            passages.append({"start": start, "end": end, "score": s, "evalue": math.exp(log_e)})
    logit = model.slope * math.log1p(evidence) + model.intercept
    return 1 / (1 + math.exp(-max(-40.0, min(40.0, logit)))), passages


def score(df: DataFrame, model: ToxicityModel, text_col: str = "text", score_col: str = "score",
          passages_col: str = "passages") -> DataFrame:
    """``df`` plus its score and its significant toxic passages."""
    for name in (score_col, passages_col):
        if name in df.columns:
            raise ValueError(f"column {name} exists already")
    at = df.columns.index(text_col)
    passage = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()),
                                  ("score", pa.float64()), ("evalue", pa.float64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = WordScores(model.ratios or {}, model.drift)
        for batch in batches:
            scored = [score_words(scores.of(t), model) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([s for s, _ in scored], pa.float64()),
                 pa.array([p for _, p in scored], passage)],
                [*batch.schema.names, score_col, passages_col])

    schema = T.StructType([*df.schema.fields, T.StructField(score_col, T.DoubleType()),
                           T.StructField(passages_col, T.DataType.fromDDL(PASSAGE))])
    return _map(df, run, schema)
