"""Operator 1: tiling against a brute-force version, planted passages, edge cases."""

import random

import numpy as np

from aerolake.llm import decontaminate as d
from aerolake.llm.common import prepare

rng = random.Random(3)


def brute_tiling(item, doc, min_match):
    """Textbook greedy string tiling: longest unmarked common run, again and again."""
    used_i, used_j, tiles = set(), set(), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while (i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n]
                       and i + n not in used_i and j + n not in used_j):
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < min_match:
            return sorted(tiles)
        used_i.update(range(i, i + n))
        used_j.update(range(j, j + n))
        tiles.append((i, j, n))


def test_tiling_equals_brute_force():
    for _ in range(300):
        item = np.array([rng.randint(1, 4) for _ in range(rng.randint(0, 30))])
        doc = np.array([rng.randint(1, 4) for _ in range(rng.randint(0, 60))])
        k = rng.randint(2, 5)
        got = d.tile(item, doc, k)
        # ties between equally long matches may be broken either way: the tiles are
        # valid, maximal, and the longest is as long as the brute-force one
        for i, j, n in got:
            assert n >= k and (item[i:i + n] == doc[j:j + n]).all()
        covered_i = [p for i, _, n in got for p in range(i, i + n)]
        covered_j = [p for _, j, n in got for p in range(j, j + n)]
        assert len(set(covered_i)) == len(covered_i) and len(set(covered_j)) == len(covered_j)
        brute = brute_tiling(item.tolist(), doc.tolist(), k)
        assert max((t[2] for t in got), default=0) == max((t[2] for t in brute), default=0)
        assert not brute_tiling([x if p not in covered_i else -1 for p, x in enumerate(item.tolist())],
                                [x if p not in covered_j else -2 for p, x in enumerate(doc.tolist())], k)


def test_unambiguous_tiling_is_exact():
    for _ in range(50):
        words = rng.sample(range(1, 1000), 60)
        item = np.array(words[:40])
        cuts = sorted(rng.sample(range(1, 40), 3))
        pieces = [words[a:b] for a, b in zip([0, *cuts], [*cuts, 40])]
        rng.shuffle(pieces)
        doc = []
        for k, piece in enumerate(pieces):
            doc += piece + words[40 + k:41 + k]
        got = d.tile(item, np.array(doc), 4)
        assert got == brute_tiling(item.tolist(), doc, 4)


def words(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice("abcdefgh") for _ in range(4)) for _ in range(n)]


def test_leaks(spark):
    prepare(spark)
    items = {i: " ".join(words(30, i)) for i in range(5)}
    benchmark = spark.createDataFrame(
        [(i, t) for i, t in items.items()] + [(10, None), (11, ""), (12, "two words"), (13, items[0])],
        "item_id long, text string")
    w = items[1].split()
    docs = {
        1: "before " + items[0] + " after",
        2: "Sentence. " + " ".join(w[15:]).upper() + "! and then, " + ", ".join(w[:15]),       # reordered
        3: " ".join(w[:10]) + " something else",                                            # a third of it
        4: " ".join(words(500, 99)),
        5: None, 6: "", 7: "two words",
        8: " ".join(words(20_000, 98)) + " " + items[2] + " " + items[3],
        9: " ".join(x + " pad" if k % 3 == 2 else x for k, x in enumerate(w)),               # too short pieces
    }
    df = spark.createDataFrame([(i, t, "x") for i, t in docs.items()] + [(1, docs[1], "again")],
                               "doc_id long, text string, item_id string")
    expected = {(1, 0), (1, 13), (2, 1), (8, 2), (8, 3)}
    for options in ({}, {"filter_bits": 1 << 15, "group_items": 1}):
        pairs = d.leaked_pairs(df, benchmark, **options).collect()
        assert {(r.doc_id, r.item_id) for r in pairs} == expected
        assert len(pairs) == 7
        assert all(r.coverage == r.n_matched / r.n_item_tokens >= 0.5 for r in pairs)
    one = next(r for r in pairs if (r.doc_id, r.item_id) == (2, 1))
    assert sum(t.length for t in one.tiles) == 30 and len(one.tiles) == 2
    marked = d.mark_leaks(df, benchmark, leaks_col="found")
    assert marked.columns == [*df.columns, "found"]
    assert sorted((r.doc_id, x.item_id) for r in marked.collect() for x in r.found) == sorted(
        [*expected, (1, 0), (1, 13)])
    kept = d.decontaminate(df, benchmark)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6, 7, 9]
    assert d.leaked_pairs(df.limit(0), benchmark).count() == 0
    assert d.decontaminate(df, benchmark.limit(0)).count() == df.count()


def test_rare_seeds_lose_no_leak():
    """Whatever seeds a text holds: if they cover enough of the item, one of them is rare."""
    for _ in range(2000):
        n, k = rng.randint(4, 30), rng.randint(2, 4)
        seeds = [rng.randint(1, 12) for _ in range(n - k + 1)]
        counts = {s: rng.choice([1, 1, 2, 50, 1000]) for s in set(seeds)}
        share = rng.choice([0.3, 0.5, 0.9, 1.0])
        rare = d.rare_seeds(list(range(len(seeds))), seeds, [counts[s] for s in seeds], n, k, share)
        held = {s for s in counts if rng.random() < 0.6}
        cover = {p for i, s in enumerate(seeds) if s in held for p in range(i, i + k)}
        assert len(cover) < share * n or held & set(rare)


def test_frequent_phrases(spark):
    """A phrase of all texts and items joins nothing; items made of it alone are found all the same."""
    prepare(spark)
    phrase = " ".join(words(6, 50))
    items = {i: " ".join(words(12, 100 + i)) + " " + phrase for i in range(30)} | {99: phrase}
    benchmark = spark.createDataFrame(list(items.items()), "item_id long, text string")
    docs = {i: f"{' '.join(words(40, 1000 + i))} {phrase}" for i in range(200)} | {500: items[7], 501: items[8] + " x"}
    df = spark.createDataFrame([(i, t) for i, t in docs.items()], "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in d.leaked_pairs(df, benchmark).collect()}
    assert got == {(i, 99) for i in docs} | {(500, 7), (501, 8)}


def test_query(spark):
    """Every document against every item, cut at shared seeds only by set operations."""
    from aerolake.llm import queries

    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: d.tokens(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = {r.item_id: d.tokens(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    grams = lambda t: {tuple(t[i:i + d.MIN_MATCH]) for i in range(len(t) - d.MIN_MATCH + 1)}      # noqa: E731
    of_item = {i: grams(t) for i, t in items.items()}
    expected, close = {}, set()
    for doc, t in docs.items():
        mine = grams(t)
        for item, w in items.items():
            shared = mine & of_item[item]
            if (d.MIN_MATCH * len(shared)) < d.MIN_COVERAGE * len(w):
                continue                        # fewer seeds than the coverage needs
            # only tokens in shared seeds can be tiled
            near = sorted({p for i in range(len(t) - 3) if tuple(t[i:i + 4]) in shared for p in range(i, i + 4)})
            part = [x for a, p in enumerate(near) for x in ([None] if a and near[a - 1] != p - 1 else []) + [t[p]]]
            matched = sum(n for _, _, n in brute_tiling(w, part, d.MIN_MATCH))
            share = matched / len(w)
            if abs(share - d.MIN_COVERAGE) < 0.05:
                close.add((doc, item))          # ties may be broken either way
            elif share >= d.MIN_COVERAGE:
                expected[(doc, item)] = (len(w), matched)
    out = {(r.doc_id, r.item_id): (r.n_item_tokens, r.n_matched) for r in queries.op1_decontamination(spark, sf).collect()}
    assert expected and out.keys() - close == expected.keys()
    for pair, (n, matched) in expected.items():
        assert out[pair][0] == n and abs(out[pair][1] - matched) <= 0.05 * n
