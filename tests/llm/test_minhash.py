"""Operator 9 against brute force over all pairs of full shingle sets."""

import random
import re

import pytest

from aerolake.llm import minhash
from aerolake.llm.common import prepare

rng = random.Random(11)


def brute_sets(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    k = min(5, len(words))
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def brute(rows):
    """{doc_id: (n_shingles, component_id, kept)} by comparing all pairs."""
    sets = [(d, brute_sets(t)) for d, t in rows if d is not None]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    by_shingle = {}
    for i, (_, s) in enumerate(sets):
        for x in s:
            by_shingle.setdefault(x, []).append(i)
    seen = set()
    for ids in by_shingle.values():
        for a in range(len(ids)):
            for b in range(a):
                if (ids[b], ids[a]) in seen:
                    continue
                seen.add((ids[b], ids[a]))
                x, y = sets[ids[a]][1], sets[ids[b]][1]
                n = len(x & y)
                if 100 * n >= 75 * (len(x) + len(y) - n):
                    root[find(ids[a])] = find(ids[b])
    least = {}
    for i, (d, _) in enumerate(sets):
        least[find(i)] = min(d, least.get(find(i), d))
    return sorted((d, len(s), least[find(i)], d == least[find(i)]) for i, (d, s) in enumerate(sets))


def words(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(n)]


@pytest.fixture()
def corpus():
    rows = []
    base = words(60, 1)
    for i in range(60):                 # near copies: one changed word each
        w = list(base)
        w[rng.randrange(60)] = f"x{i}"
        rows.append(" ".join(w))
    for i in range(40):                 # a chain: each shifted by a few words
        long = words(400, 2)
        rows.append(" ".join(long[4 * i:4 * i + 60]))
    rows += [" ".join(words(30, 3)).upper(), " ".join(words(30, 3)), "\n".join(words(30, 3))]
    rows += [None, "", "  \t", "one", "One", "one two", "one\x0btwo", "one two three four", "É é", "é É"]
    rows += ["same line of words here " * 50] * 5 + ["same line of words here " * 40]
    for i in range(60):                 # a shared passage, linked with nothing
        rows.append(" ".join(words(12, 4) + words(50, 100 + i)))
    rows.append(" ".join(words(30_000, 5)))
    rows.append(" ".join(words(30_000, 5)[:29_000]))
    ids = list(range(1, len(rows) + 1))
    rng.shuffle(ids)
    return list(zip(ids, rows))


def got(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id, r.kept)
                  for r in minhash.near_duplicates(df).collect() if r.doc_id is not None)


def test_against_all_pairs(spark, corpus):
    prepare(spark)
    df = spark.createDataFrame([(i, t, "z") for i, t in corpus], "doc_id long, text string, node string").repartition(5)
    assert got(df) == brute(corpus)


def test_long_lists_are_cut_in_blocks(spark, corpus, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 7)
    prepare(spark)
    df = spark.createDataFrame(corpus, "doc_id long, text string")
    assert got(df) == brute(corpus)


def test_edges(spark):
    prepare(spark)
    schema = "doc_id long, text string, kept string"
    df = spark.createDataFrame([(1, "a b c", "x"), (1, "a b c", "y"), (1, "other", "z"), (2, "a b c", None),
                                (None, "a b c", "n"), (None, None, "n"), (3, None, "m")], schema)
    out = sorted(map(tuple, minhash.near_duplicates(df).collect()), key=str)
    assert out == sorted([(1, 1, 1, True), (1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (None, 1, None, True),
                          (None, 0, None, True), (3, 0, 3, True)], key=str)
    kept = minhash.deduplicate(df)
    assert kept.columns == df.columns and kept.count() == 6
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_query(spark):
    from aerolake.llm import queries

    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    out = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in queries.op9_minhash(spark, sf).collect())
    assert out == brute(rows)
