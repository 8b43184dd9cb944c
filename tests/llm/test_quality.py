"""Operator 4: counts by regular expressions, estimates against numpy on whole groups."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolake.llm import quality as q
from aerolake.llm.common import prepare

rng = random.Random(2)


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    covered = {p for i, w in enumerate(windows) if windows.count(w) > 1 for p in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered))


def test_counts():
    texts = [None, "", " \t\n", "a", "a b\x85c\x1cd", "é ü\x0bß\x0c🙂\r\n", "x x x x x x", "a b c d e f a b c d e",
             "l\nl\n \n l\nl ", "#*$%&|<> #a", "w " * 3000]
    texts += ["".join(rng.choice("ab \n\t#|é") for _ in range(rng.randint(0, 120))) for _ in range(300)]
    for t in texts:
        assert q.count_statistics(t) == brute_counts(t), t


def numpy_distances(x):
    """The same estimates from a group's rows as one matrix."""
    p = q.P

    def quantile(v, share):
        v = np.sort(v)
        return v[int(np.ceil(share * len(v) - 1e-9)) - 1]

    binned = lambda v: np.where(v >= 0, np.floor(v * q.VALUE_BINS + 0.5), np.ceil(v * q.VALUE_BINS - 0.5))
    centre = np.array([quantile(binned(x[:, k]), 0.5) for k in range(p)]) / q.VALUE_BINS
    mad = np.array([quantile(binned(np.abs(x[:, k] - centre[k])), 0.5) for k in range(p)]) * (1.4826 / q.VALUE_BINS)
    precision = np.diag(1 / (mad ** 2 + q.FLOORS ** 2))
    distance = lambda: np.einsum("ni,ij,nj->n", x - centre, precision, x - centre)
    dbin = lambda d: np.floor(np.log2(np.maximum(d, 0) + 2.0 ** -20) * q.DISTANCE_BINS)

    def scaled():
        d = quantile(dbin(distance()), 0.5)
        return precision * min(1.0, q.chi2_quantile(0.5, p) / 2 ** ((d + 1) / q.DISTANCE_BINS))

    for _ in range(q.STEPS):
        d = dbin(distance())
        near = x[d <= quantile(d, q.SHARE)]
        centre, precision = near.mean(axis=0), np.linalg.inv(np.cov(near.T, bias=True) + np.diag(q.FLOORS ** 2))
    precision = scaled()
    near = x[distance() <= q.chi2_quantile(0.975, p)]
    centre, precision = near.mean(axis=0), np.linalg.inv(np.cov(near.T, bias=True) + np.diag(q.FLOORS ** 2))
    precision = scaled()
    return distance()


@pytest.fixture(scope="module")
def corpus():
    def clean(n):
        return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))

    rows = []
    for lang, source, n in (("en", "a", 300), ("en", "b", 120), ("de", None, 130), (None, None, 110),
                            ("en", "c", 3), ("en", "d", 2), ("fr", "a", 4)):
        rows += [(len(rows) + i, clean(int(np.exp(rng.uniform(3, 6)))), lang, source) for i in range(n)]
    junk = []
    for i in range(30):
        text = " ".join(w + "***" for w in clean(60).split())
        junk.append(1000 + i)
        rows.append((1000 + i, text, "en", "a"))
    rows += [(2000, None, "en", "a"), (2001, "", None, None), (2002, "too few words", "en", "a"),
             (2003, "one two three four five six seven " * 9, "en", "a"), (0, rows[0][1], "en", "a"), (None, clean(50), "en", "a")]
    return rows, junk


def test_judge(spark, corpus):
    prepare(spark)
    rows, junk = corpus
    df = spark.createDataFrame([(*r, "z") for r in rows],
                               "doc_id long, text string, lang string, source string, bin string")
    out = q.judge(q.text_statistics(df)).collect()
    assert len(out) == len(rows)
    kept = {r.doc_id: r.kept for r in out}
    assert not any(kept[d] for d in [*junk, 2000, 2001, 2002, 2003])
    clean = [r for r in out if r.doc_id is None or r.doc_id < 1000]
    assert sum(r.kept for r in clean) >= 0.99 * len(clean)
    assert all(r.kept == (not r.base_failed and (r.distance is None or r.distance <= q.chi2_quantile(q.CUTOFF, q.P)))
               for r in out)
    # groups too small are pooled, and get no verdict when the pool is small too
    assert {r.group for r in out if r.source in ("c", "d") or r.lang == "fr"} == {"pooled"}
    assert all(r.distance is None for r in out if r.group == "pooled" or r.base_failed)
    vector = lambda r: [np.log1p(r.n_words), r.word_chars / r.n_words, np.log1p(1000 * r.n_symbols / r.word_chars),
                        np.log1p(1000 * r.n_dup_lines / r.n_words), np.log1p(100 * r.n_repeat_words / r.n_words)]
    for group in {r.group for r in out if r.distance is not None}:
        own = [r for r in out if r.group == group]
        expected = numpy_distances(np.array([vector(r) for r in own]))
        assert np.allclose([r.distance for r in own], expected, rtol=1e-6, atol=1e-9)


@pytest.mark.parametrize("share", [0.35, 0.45])
def test_copies_of_one_junk_text(spark, share):
    prepare(spark)
    r = random.Random(7)

    def prose():
        return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 8))) for _ in range(
            int(np.exp(r.uniform(3, 6)))))

    junk = " ".join(w + "*" for w in prose().split())
    n = round(share * 400)
    df = spark.createDataFrame([(i, junk if i < n else prose(), "en", "a") for i in range(400)],
                               "doc_id long, text string, lang string, source string")
    out = q.judge(q.text_statistics(df)).collect()
    assert not any(row.base_failed for row in out)
    assert not any(row.kept for row in out if row.doc_id < n)
    assert sum(row.kept for row in out if row.doc_id >= n) >= 0.99 * (400 - n)


def test_clashing_columns(spark, corpus):
    """Names of the operator's own columns on the input: results replace theirs, all
    others are carried along."""
    prepare(spark)
    rows, _ = corpus
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    names = ["n_words", "Group", "distance", "kept", "centre", "spread", "length", "falling", "n", "limit", "base_failed", "repeats"]
    clash = plain.select("*", *[F.lit("x").alias(c) for c in names])
    out = q.judge(q.text_statistics(clash))
    assert {"centre", "spread", "length", "falling", "n", "limit", "repeats"} <= set(out.columns) and out.where("centre = 'x'").count() == len(rows)
    columns = ["doc_id", *q.COUNTS, "base_failed", "kept", "distance", "group"]
    wanted = q.judge(q.text_statistics(plain)).select(*columns)
    assert sorted(map(repr, map(tuple, out.select(*columns).collect()))) == sorted(map(repr, map(tuple, wanted.collect())))


def test_empty(spark):
    prepare(spark)
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert q.judge(q.text_statistics(df)).count() == 0


def test_query(spark):
    from aerolake.llm import queries

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = queries.op4_quality(spark, sf).collect()
    assert {r.doc_id for r in out} == set(texts) and len(out) == len(texts)
    for r in out:
        counts = brute_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 10 or 100 * counts[4] > 20 * counts[0])
        assert not (r.base_failed and r.kept)
