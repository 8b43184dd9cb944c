"""Operator 6 against a table of all windows."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from aerolake.llm import suffix_dedup as s
from aerolake.llm.common import prepare

rng = random.Random(8)


def test_longest_previous_factors():
    for _ in range(300):
        text = "".join(rng.choice("ab") for _ in range(rng.randint(1, 25)))
        n = len(text)
        order = sorted(range(n), key=lambda i: text[i:])

        def common(a, b):
            k = 0
            while max(a, b) + k < n and text[a + k] == text[b + k]:
                k += 1
            return k

        lcp = [0] + [common(a, b) for a, b in zip(order, order[1:])]
        got = s.longest_previous_factors(order, lcp)
        assert {i: g for i, g in zip(order, got)} == {
            i: max((common(i, j) for j in range(i)), default=0) for i in range(n)}


def scanned(position, lcp):
    """Longest previous factors by one scan with a stack of increasing positions."""
    out, stack = [0] * len(position), []
    for i in range(len(position)):
        common = lcp[i] if i else 0
        while stack and position[stack[-1][0]] > position[i]:
            entry, below = stack.pop()
            out[entry], common = max(below, common), min(common, below)
        stack.append((i, common if stack else 0))
    for entry, below in stack:
        out[entry] = below
    return out


@pytest.mark.parametrize("rounds", [0, 2, 64])
def test_factors_all_at_once_are_those_of_a_scan(rounds, monkeypatch):
    monkeypatch.setattr(s, "ROUNDS", rounds)
    for _ in range(200):
        n = rng.randint(0, 60)
        position = [rng.randint(0, rng.choice([5, 1000])) for _ in range(n)]
        if rng.random() < 0.4:
            position.sort(reverse=rng.random() < 0.5)
        lcp = [rng.choice([0, 200, 200, 200, rng.randint(0, 300)]) for _ in range(n)]
        assert s.longest_previous_factors(position, lcp).tolist() == scanned(position, lcp)


def test_ranks_of_wide_keys():
    for bits in (1, 40, 62):
        key = np.array([rng.randrange(1 << bits) for _ in range(300)] * 2, dtype=np.uint64)
        assert s._ranks(key, bits).tolist() == np.unique(key, return_inverse=True)[1].tolist()


def test_spans_of_a_batch_are_those_of_each_text():
    fields = [("first", pa.int32()), ("last", pa.int32()), ("earlier", pa.bool_()), ("in_first", pa.bool_()), ("g", pa.int64())]
    lists = [[{"first": a, "last": a + rng.randint(0, 90), "earlier": rng.random() < 0.5, "in_first": False, "g": 1}
              for a in (rng.randint(0, 3000) for _ in range(rng.randint(0, 12)))] for _ in range(80)] + [None, []]
    runs = pa.array(lists, pa.list_(pa.struct(fields)))
    for find, keep_first in ((s._covered, False), (s._kept_firsts, True)):
        for part in (runs, runs.slice(30, 25), runs.slice(80)):
            got = list(zip(*(c.tolist() for c in find(part, 200))))
            assert got == [(k, a, b) for k, r in enumerate(part.to_pylist()) for a, b in s.merged(r or [], 200, keep_first)]


def test_window_ranks():
    data = bytes(rng.choice(b"ab") for _ in range(3000))
    for length in (8, 13, 29, 64, 200):
        starts = np.array(sorted(rng.sample(range(3000 - length), 500)))
        rank = s.window_ranks(data, starts, length)
        order = sorted(range(500), key=lambda k: data[starts[k]:starts[k] + length])
        expected = {}
        for k in order:
            expected.setdefault(data[starts[k]:starts[k] + length], len(expected))
        assert rank.tolist() == [expected[data[a:a + length]] for a in starts.tolist()]


def test_contexts_partition_the_windows(monkeypatch):
    texts = [bytes(rng.choice(b"abcdefgh ") for _ in range(n)) for n in (0, 199, 200, 201, 5000, 900)] + [b"a" * 700, b"ab" * 500]
    for bits in (21, 11):
        monkeypatch.setattr(s, "BLOCK_BITS", bits)
        s._powers.cache_clear()
        seen, gram_of = [], {}
        for number, lo, hi, g, _ in s.contexts(texts):
            for k, a, b, x in zip(number.tolist(), lo.tolist(), hi.tolist(), g.tolist()):
                seen += [(k, w) for w in range(a, b + 1)]
                for w in range(a, b + 1):
                    assert gram_of.setdefault(texts[k][w:w + 200], x) == x
        assert sorted(seen) == [(k, w) for k, t in enumerate(texts) for w in range(len(t) - 199)]
    s._powers.cache_clear()


def spans(flags):
    out = []
    for i, f in enumerate(flags):
        if f:
            if out and out[-1][1] == i:
                out[-1][1] = i + 1
            else:
                out.append([i, i + 1])
    return [tuple(x) for x in out]


def brute(rows, keep_first):
    """Per row (doc_id, n_bytes, kept, spans); rows in order of (doc_id, place)."""
    places = {}
    for k, (doc, text) in enumerate(rows):
        raw = (text or "").encode()
        for w in range(len(raw) - 199):
            places.setdefault(raw[w:w + 200], []).append((-(1 << 63) if doc is None else doc, w))
    out = []
    for doc, text in rows:
        raw = (text or "").encode()
        gone = [False] * len(raw)
        for w in range(len(raw) - 199):
            p = places[raw[w:w + 200]]
            if len(p) > 1 and (not keep_first or min(p) < (-(1 << 63) if doc is None else doc, w)):
                gone[w:w + 200] = [True] * 200
        out.append((doc, len(raw), bytes(b for b, g in zip(raw, gone) if not g), spans(gone)))
    return out


def prose(n, seed):
    r = random.Random(seed)
    return "".join(r.choice("abcdefgh é\n") for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    passage, edge = prose(700, 1), prose(198, 2)
    texts = [prose(1500, 10 + i) for i in range(15)]
    texts += [prose(300, 40 + i) + passage + prose(100 * i, 60 + i) for i in range(12)]             # in full
    texts += [prose(50, 80 + i) + passage[40 * i:40 * i + 330] + prose(200, 99 + i) for i in range(9)]   # in parts
    texts += [prose(300, 120 + i) + edge + prose(300, 140 + i) for i in range(5)]                   # too short
    texts += [texts[3], texts[3], texts[4][:900] + "X" + texts[4][901:], prose(150, 3) * 4, "z" * 900, "ab" * 300 + texts[5][:400],
              prose(500, 7) + prose(400, 8) + prose(500, 7), None, "", "x", prose(199, 10), "é" * 300]
    texts += [prose(20, 300 + i) + prose(260, 9) + prose(20, 400 + i) for i in range(40)]          # many contexts of few grams
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    return list(zip(ids, texts)) + [(None, texts[16])]


def got(df, keep_first):
    return sorted(((r.doc_id, r.n_bytes, bytes(r.kept), [tuple(x) for x in r.spans])
                   for r in s.remove_repeats(df, keep_first).collect()), key=str)


@pytest.mark.parametrize("bucket, keep_first", [(256, False), (256, True), (8, False), (8, True)])
def test_against_all_windows(spark, rows, bucket, keep_first, monkeypatch):
    monkeypatch.setattr(s, "BUCKET", bucket)
    prepare(spark)
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, kept string").repartition(4)
    assert got(df, keep_first) == sorted(brute(rows, keep_first), key=str)


def test_repeated_rows_and_empty(spark):
    prepare(spark)
    a, b = prose(400, 21), prose(400, 22)
    df = spark.createDataFrame([(1, a), (1, a), (2, b), (2, a[:250]), (3, None)], "doc_id long, text string")
    assert got(df, False) == sorted([(1, len(a.encode()), b"", [(0, len(a.encode()))])] * 2 + [
        (2, len(b.encode()), b.encode(), []), (2, len(a[:250].encode()), b"", [(0, len(a[:250].encode()))]), (3, 0, b"", [])], key=str)
    assert s.remove_repeats(df.limit(0)).count() == 0


def test_query(spark):
    from aerolake.llm import queries

    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    expected = {d: (n, n - len(kept), len(x), hashlib.sha256(kept).hexdigest()) for d, n, kept, x in brute(rows, False)}
    out = queries.op6_suffix_dedup(spark, sf).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out} == expected and len(out) == len(rows)
