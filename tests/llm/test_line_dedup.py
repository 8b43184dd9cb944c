"""Operator 7 against plain edit distances over all pairs of lines."""

import random
from collections import Counter

import pytest

from aerolake.llm import line_dedup as d
from aerolake.llm.common import prepare

rng = random.Random(5)


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def close(a, b, k):
    if abs(len(a) - len(b)) > k or (Counter(a) - Counter(b)).total() > k:   # cannot be close
        return False
    return edit_distance(a, b) <= k


def edited(s, n, alphabet="abc é"):
    s = list(s)
    for _ in range(n):
        at = rng.randrange(len(s) + 1)
        what = rng.randrange(3)
        if what == 0:
            s.insert(at, rng.choice(alphabet))
        elif s and what == 1:
            del s[min(at, len(s) - 1)]
        elif s:
            s[min(at, len(s) - 1)] = rng.choice(alphabet)
    return "".join(s)


def test_banded_distance():
    for k in (0, 1, 2, 3):
        for _ in range(1500):
            a = "".join(rng.choice("ab") for _ in range(rng.randint(0, 12)))
            b = edited(a, rng.randint(0, 5), "ab")
            assert d.edit_distance_within(a, b, k) == (edit_distance(a, b) <= k), (a, b, k)


def test_linked_lines_share_a_key():
    for k in (1, 2, 3):
        for _ in range(150):
            a = "".join(rng.choice("abc é🙂") for _ in range(rng.randint(k + 1 + k, 40)))
            b = edited(a, rng.randint(0, k))
            posted = [{}, {}]
            for which, key, role in d.postings([a, b], k):
                for w, x in zip(which.tolist(), key.tolist()):
                    posted[w].setdefault(x, set()).add(role)
            assert any(d.INDEX in posted[0][x] | posted[1][x] for x in posted[0].keys() & posted[1].keys()), (a, b)


def brute(rows, min_chars, k):
    """{(doc_id, line_no): (n_copies, n_links, kept)}"""
    places = {}
    for doc, text in rows:
        if doc is not None:
            for n, line in enumerate((text or "").split("\n")):
                if line.strip(" \t\n\v\f\r"):
                    places.setdefault(line, []).append((doc, n))
    first = {x: min(p) for x, p in places.items()}
    near = {x: [] for x in places}
    lines = sorted((x for x in places if len(x) >= min_chars), key=len)
    for i, x in enumerate(lines):
        for y in lines[i + 1:]:
            if len(y) - len(x) > k:
                break
            if close(x, y, k):
                near[x].append(y), near[y].append(x)
    return {(p, x): (len(places[x]), len(near[x]), p == first[x] and all(first[x] < first[y] for y in near[x]))
            for x in places for p in places[x]}


def got(df, rows, **options):
    text = {}
    for doc, t in rows:
        text.setdefault(doc, []).append((t or "").split("\n"))
    out = {}
    for r in d.line_decisions(df, **options).collect():
        line = next(t[r.line_no] for t in text[r.doc_id] if r.line_no < len(t) and d.line_digest(t[r.line_no]) == r.line)
        out[((r.doc_id, r.line_no), line)] = (r.n_copies, r.n_links, r.kept)
    return out


@pytest.fixture()
def rows():
    def line(n):
        return "".join(rng.choice("abcdefg  é") for _ in range(n))

    base = [line(rng.randint(18, 60)) for _ in range(40)] + [line(3000)]
    out = []
    for doc in range(60):
        lines = [edited(rng.choice(base), rng.choice((0, 0, 1, 2, 3))) for _ in range(rng.randint(0, 6))]
        out.append((doc, "\n".join(lines + ["short"] * (doc % 2))))
    out += [(100, None), (101, ""), (102, "\n\n"), (None, base[0]), (7, base[1] + "\n" + base[2])]
    out += [(200 + i, base[0] + "\n" + "x" * 25 + f"{i:03d}" + "y" * 25) for i in range(30)]      # one hot group
    return out


@pytest.mark.parametrize("block", [1000, 4])
def test_against_all_pairs(spark, rows, block, monkeypatch):
    monkeypatch.setattr(d, "BLOCK", block)
    prepare(spark)
    df = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, line string").repartition(4)
    for k in (2,) if block > 4 else (1, 2):
        assert got(df, rows, threshold=k) == brute(rows, d.MIN_CHARS, k)


def test_removal(spark):
    prepare(spark)
    a, b, c = "the first line of some length", "another line that is quite long", "a third one which is only here"
    data = [(1, f"{a}\n{b}\nshort", 5), (2, f"{b[:-1]}\n{c}\nshort\n{a}!", 6), (3, None, 7), (4, "", 8),
            (None, f"{a}\n{a}", 9), (5, f"{a}\n\n{a}", 10), (6, f"{c}\n{c}", 11), (6, f"{c}\n{c}", 11)]
    df = spark.createDataFrame(data, "doc_id long, text string, line_no int")
    out = d.deduplicate_lines(df)
    assert out.schema == df.schema
    assert sorted(map(tuple, out.collect()), key=str) == sorted([
        (1, f"{a}\n{b}\nshort", 5), (2, c, 6), (3, None, 7), (4, "", 8), (None, f"{a}\n{a}", 9),
        (5, "", 10), (6, "", 11), (6, "", 11)], key=str)
    assert d.deduplicate_lines(df.limit(0)).count() == 0


def test_query(spark):
    from aerolake.llm import queries

    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    expected = {doc: [0, 0, []] for doc, _ in rows}
    for ((doc, n), _), (_, links, kept) in brute(rows, d.MIN_CHARS, d.THRESHOLD).items():
        expected[doc][0] += 1
        expected[doc][1] += links
        if not kept:
            expected[doc][2].append(n)
    out = queries.op7_line_dedup(spark, sf).collect()
    assert {r.doc_id: [r.n_lines, r.n_links, r.removed_lines] for r in out} == {
        doc: [a, b, sorted(c)] for doc, (a, b, c) in expected.items()}
    assert all(r.n_removed == len(r.removed_lines) for r in out)


def test_character_counts_bound_the_distance():
    for _ in range(2000):
        a = "".join(rng.choice("abc é漢😀") for _ in range(rng.randint(1, 30)))
        b = edited(a, 2)
        x = d.character_counts([a, b])
        assert x.sum() == len(a) + len(b) and abs(x[0] - x[1]).sum() <= 4


def test_many_lines_with_one_segment(spark):
    """6,000 different lines whose first third is one text, and two that are close."""
    prepare(spark)
    r = random.Random(9)
    head = "the same beginning, "
    lines = [head + "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(40)) for _ in range(6000)]
    lines.append(lines[17][:-1] + "!")
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").repartition(8)
    out = {x.doc_id: (x.n_links, x.kept) for x in d.line_decisions(df).where("n_links > 0").collect()}
    assert out == {17: (1, True), 6000: (1, False)}
