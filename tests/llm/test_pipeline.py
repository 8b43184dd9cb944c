"""The pipeline's stages, each against brute force on its own input."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from aerolake.llm import decontaminate, line_dedup, queries  # noqa: E402
from aerolake.llm.common import stored  # noqa: E402
from tests.llm.test_line_dedup import brute as brute_lines  # noqa: E402
from tests.llm.test_minhash import brute as brute_groups  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "test-stage")
        out.append((name, docs))
    return dict(out)


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_columns(steps):
    columns = steps["documents"].dtypes
    for name in ("toxicity", "line_dedup", "minhash", "decontamination"):
        assert steps[name].dtypes == columns


def test_toxicity(spark, steps):
    predicted = {r.doc_id: r.predicted for r in queries.op3_toxicity(spark, SF).collect()}
    assert set(texts(steps["toxicity"])) == {d for d, p in predicted.items() if not p}


def test_line_dedup(steps):
    before, after = texts(steps["toxicity"]), texts(steps["line_dedup"])
    decided = brute_lines(list(before.items()), line_dedup.MIN_CHARS, line_dedup.THRESHOLD)
    gone = {p for (p, _), (_, _, kept) in decided.items() if not kept}
    assert gone
    assert after == {d: "\n".join(x for k, x in enumerate(t.split("\n")) if (d, k) not in gone)
                     for d, t in before.items()}
    assert all(r.n_chars == len(r.text) for r in steps["line_dedup"].collect())


def test_minhash(steps):
    before, after = texts(steps["line_dedup"]), texts(steps["minhash"])
    kept = {d for d, _, _, k in brute_groups(list(before.items())) if k}
    assert after == {d: before[d] for d in kept}


def test_decontamination(spark, steps):
    before, after = texts(steps["minhash"]), texts(steps["decontamination"])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    words = {i: decontaminate.tokens(t) for i, t in items}

    def holds(text, wanted):
        have, k = decontaminate.tokens(text), decontaminate.MIN_MATCH
        grams = {tuple(have[j:j + k]) for j in range(len(have) - k + 1)}
        cover = {p for j in range(len(wanted) - k + 1) if tuple(wanted[j:j + k]) in grams for p in range(j, j + k)}
        return len(wanted) >= k and len(cover) >= 0.5 * len(wanted)

    # on these texts the cover by common 4-grams decides as the tiles do
    assert after == {d: t for d, t in before.items() if not any(holds(t, w) for w in words.values())}


def test_run(spark, steps):
    rows = sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()))
    assert rows == sorted(map(tuple, steps["bpe"].collect()))
    assert {r[0] for r in rows} == set(texts(steps["decontamination"]))


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_nulls_and_repeats(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, None, None, None, None), (10_001, None, None, None, None), (10_002, "", "en", None, 0),
                                 (None, "only a few words", None, "s", 16)], docs.schema)
    docs = docs.limit(20).union(odd).union(docs.limit(5))
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), "test-odd")
    assert {10_001, 10_002, None} <= {r.doc_id for r in docs.collect()}
