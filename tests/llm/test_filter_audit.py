"""Operator 12: every order of the filters applied to every document, by brute force."""

import itertools
import random
import re

from aerolake.llm import filter_audit as A

rng = random.Random(3)


def fails(rows):
    out = []
    for doc_id, _, text in rows:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = set()
        f |= {"A"} if len(w) < 50 else set()
        f |= {"B"} if 100 * len(set(w)) < 65 * len(w) else set()
        f |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t) else set()
        f |= {"D"} if re.search("[#$%&*|]", t) else set()
        if doc_id is not None and any(i is not None and i < doc_id and (x or "") == t for i, _, x in rows):
            f.add("E")
        out.append(f)
    return out


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    bad = {i for i, _, t in labels if t == 1 and i is not None}
    failing = fails(rows)
    out = []
    for part in {r[1] or "" for r in rows}:
        mine = [(r[0], f) for r, f in zip(rows, failing) if (r[1] or "") == part]
        steps, total = [], dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, x in enumerate(order, 1):
                gone = [(i, f) for i, f in left if x in f]
                left = [(i, f) for i, f in left if x not in f]
                total[x] += len(gone)
                steps.append((x, ["".join(order), step, len(left), len(gone), sum(x in f for _, f in mine) - len(gone),
                                  sum(f == {x} for _, f in mine), sum(i in good for i, _ in gone), sum(i in bad for i, _ in gone)]))
        out += [(part, *s, total[x]) for x, s in steps]
    return sorted(out)


COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def run(spark, rows, labels):
    docs = spark.createDataFrame([(*r, 1, "y") for r in rows], "doc_id bigint, source string, text string, n int, part string")
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    return sorted(map(tuple, A.audit(docs, known).select(*COLUMNS).collect()))


def test_equals_all_orders_applied(spark):
    texts = ["", None, "short", "a " * 60, "UP CASE " * 40, "many $ words " + " ".join(f"w{k}" for k in range(60)),
             " ".join(f"v{k}" for k in range(70)), "\x0b\x0c", "naïve word " * 30]
    texts += [" ".join(rng.choice(["a", "b", "C", "d#", f"x{k}"]) for k in range(rng.randrange(1, 90))) for _ in range(40)]
    rows = [(i, rng.choice(["s1", "s2", None, ""]), rng.choice(texts)) for i in range(300)]
    rows += [(None, "s1", texts[6]), (None, None, texts[6]), (17, "s2", "twice"), (17, "s2", "twice"), (17, "s1", "twice"),
             (900, "s3", "very long " + "word " * 200_000)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 300, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (9999, 1, 1)]
    assert run(spark, rows, labels) == brute(rows, labels)


def test_copies_of_any_smaller_id(spark):
    rows = [(5, "s", "same"), (3, "t", "same"), (9, "s", "same"), (3, "t", "other"), (4, "s", "Same")]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    got = A.text_copies(A.prepared(docs)).select("doc_id", "text").collect()
    assert sorted(map(tuple, got)) == [(5, "same"), (9, "same")]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, source string, text string")
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert A.audit(docs, none).count() == 0
    one = spark.createDataFrame([(1, "s", "x")], "doc_id bigint, source string, text string")
    got = A.audit(one, none)
    assert got.count() == 600 and got.columns == COLUMNS
