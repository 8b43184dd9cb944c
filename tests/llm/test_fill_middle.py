"""Operator 11: boundary sets against lists of offsets, forms and cuts against brute force."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from aerolake.llm import fill_middle as M
from aerolake.llm.common import prepare

rng = random.Random(5)


def offsets(text):
    """Byte offsets at which code points begin, and the end."""
    out = [0]
    for c in text:
        out.append(out[-1] + len(c.encode()))
    return out


CHUNKS = {
    "ascii": "plain words " * 30_000,
    "mixed": "".join(rng.choice("aé漢😀 ") for _ in range(60_000)),
    "wide": "😀" * 50_000,
    "sparse": ("漢" * 20_000) + "a" * 70_000 + "é" * 3,
    "edge": "a" * (M.CHUNK - 1) + "é" + "b" * M.CHUNK,
    "whole": "a" * M.CHUNK,
    "empty": "",
    "one": "é",
}


@pytest.mark.parametrize("name", CHUNKS)
def test_select_gives_every_boundary(name):
    text = CHUNKS[name]
    found, wanted = M.BoundarySet(text.encode()), offsets(text)
    assert found.cardinality == len(wanted)
    places = range(len(wanted)) if len(wanted) < 3000 else [0, len(wanted) - 1, *(rng.randrange(len(wanted)) for _ in range(2000))]
    assert all(found.select(k) == wanted[k] for k in places)
    with pytest.raises(IndexError):
        found.select(len(wanted))


def test_containers_are_the_smallest():
    kinds = {name: [c.kind for c in M.BoundarySet(text.encode()).containers] for name, text in CHUNKS.items()}
    assert set(kinds["ascii"]) == {M.RUN}
    assert M.BITMAP in kinds["mixed"]
    few = bytearray(b"\x80" * M.CHUNK)
    for k in range(0, 3000, 3):
        few[k] = 65
    assert M.BoundarySet(bytes(few)).containers[0].kind == M.ARRAY


def brute(doc_id, text):
    x = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[8 * i:8 * i + 8], 16) for i in range(4)]
    t = text or ""
    n = len(t)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not t or any(s in t for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, t, t
    p, m, s = t[:a], t[a:b], t[b:]
    if h[3] % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}", t
    return doc_id, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}", t


def test_rows_equal_brute_force(spark):
    prepare(spark)
    rows = [(i, "".join(rng.choice("ab é漢😀\n<PSM>") for _ in range(rng.randrange(0, 60)))) for i in range(400)]
    rows += [(400, None), (401, ""), (402, "has <M> inside"), (403, "almost <P"), (None, "no id"), (404, "<S"), (405, "S>x"),
             (7, "second text of one id"), (7, "second text of one id"), (406, CHUNKS["mixed"]), (407, CHUNKS["sparse"]),
             (408, "long " * 400_000)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, text string, output string, n int")
    got = M.fill_in_middle(df).withColumn("back", M.restored())
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(repr(brute(*r)) for r in rows)
    forms = {r["form"] for r in got.collect()}
    assert forms == {"plain", "psm", "spm"}


def test_empty_table(spark):
    prepare(spark)
    none = spark.createDataFrame([], "doc_id bigint, text string")
    got = M.fill_in_middle(none).withColumn("back", M.restored())
    assert got.count() == 0 and got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "back"]


def test_shares_of_forms(spark):
    prepare(spark)
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"))
    n = {r["form"]: r["count"] for r in M.fill_in_middle(df).groupBy("form").count().collect()}
    assert 300 < n["plain"] < 500 and 620 < n["spm"] < 820 and sum(n.values()) == 4000
