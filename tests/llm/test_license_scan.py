"""Operator 13 against brute force over all blocks and templates."""

import math
import random
import re

import pytest

from aerolake.llm import license_scan as L
from aerolake.llm.license_templates import BODY, NOTICE, TEMPLATES

rng = random.Random(8)


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def windows(w):
    n = max(math.ceil((len(w) - L.WINDOW) / (L.WINDOW // 2)), 0) + 1
    return [w[i * L.WINDOW // 2:i * L.WINDOW // 2 + L.WINDOW] for i in range(n)]


def matches(text, templates):
    found = []
    for kind, cut in ((NOTICE, "\n"), (BODY, r"\n[\x20\x09-\x0D]*\n")):
        sets = [(k, label, set(words(lower(t)))) for k, (label, of, t) in enumerate(templates) if of == kind]
        for block in re.split(cut, lower(text)):
            for w in windows(words(block)):
                here = [(k, label, s, len(s & set(w)) / len(s)) for k, label, s in sets
                        if len(s & set(w)) >= math.ceil(len(s) * L.PERCENT / 100)]
                found += [(label, c) for _, label, s, c in here if not any(s < o for _, _, o, _ in here)]
    return found


def brute(doc_id, text, templates=TEMPLATES):
    w = words(lower(text))
    places, base = [], set()
    for phrase, label in L.PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(w)) if w[i:i + len(p)] == p]
        places += at
        base |= {label} if at else set()
    found = matches(text, templates)
    score = 1.0 if base else max([c for _, c in found], default=0.0)
    return doc_id, len(w), sorted(places), sorted(base), sorted({x for x, _ in found}), sorted(base | {x for x, _ in found}), score


def run(spark, rows):
    df = spark.createDataFrame([(*r, 1, "w", 2.0) for r in rows], "doc_id bigint, text string, n_words int, row string, score double")
    return sorted((repr((r.doc_id, r.n_words, r.places, r.base_labels, r.template_labels, r.labels, r.score)) for r in L.scan(df).collect()))


def noisy(text, gone, added):
    w = text.split(" ")
    for _ in range(gone):
        w.pop(rng.randrange(len(w)))
    for _ in range(added):
        w.insert(rng.randrange(len(w) + 1), rng.choice(["foo", "bär", "the", "license"]))
    return " ".join(w)


def test_equals_brute_force(spark):
    rows = []
    for k, (_, kind, text) in enumerate(TEMPLATES * 3):
        cut = noisy(text, rng.randrange(0, 1 + len(text.split()) // 6), rng.randrange(0, 8))
        wrapped = cut.replace(" ", "\n", 3) if rng.random() < 0.4 else cut
        rows.append((k, rng.choice(["Intro line.\n", "", "Some words before.\n\n"]) + wrapped + rng.choice(["", "\nAfter it.", "\n \t\nNext."])))
    filler = " ".join(f"w{k % 97}" for k in range(700))
    rows += [(500, None), (501, ""), (502, "MIT\x00License mit-license mitlicense"), (503, "the GENERAL, public\nlicense"),
             (504, filler + " " + TEMPLATES[3][2] + " " + filler), (505, "É mit licenseé mit license"), (None, "MIT license"),
             (506, "Licensed under CC BY-NC 4.0."), (507, "apache license apache license"), (506, "Licensed under CC BY 4.0"),
             (506, "Licensed under CC BY 4.0"), (508, ("the of and to a in " * 100_000) + "mit license"), (509, "license"), (510, "mit")]
    got = run(spark, rows)
    assert got == sorted(repr(brute(*r)) for r in rows)
    labels = {label for r in rows for label in brute(*r)[4]}
    assert {"mit", "apache", "gpl", "cc-by-nc", "bsd", "isc"} <= labels


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    assert run(spark, [tuple(r) for r in docs.collect()]) == sorted(repr(brute(*r)) for r in docs.collect())


def test_empty_table_and_bound(spark, monkeypatch):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert L.scan(none).count() == 0
    monkeypatch.setattr(L, "MAX_TEMPLATE_WORDS", 10)
    with pytest.raises(ValueError):
        L.scan(none)


def test_no_python_or_rdd_in_the_plan(spark):
    df = spark.createDataFrame([(1, "MIT license")], "doc_id bigint, text string").repartition(1)
    plan = L.scan(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
