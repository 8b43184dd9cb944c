"""From raw documents to token ids: five stages over the ``documents`` table.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept
and returns a DataFrame, which is written as Parquet and read again for the next.
All but the last return the columns of ``documents``.

toxicity         documents scored as toxic go; learned from the labels outside
                 the held-out fold and the counts of the stage's own documents
line_dedup       repeated and nearly repeated lines are cut from the texts (the
                 first stays); documents stay, with n_chars of what is left
minhash          one document of each near-duplicate group stays
decontamination  documents that leak a benchmark item go
bpe              token count and digests of ids and decoded bytes per document

The learned model and the near-duplicate components are beyond SQL, so there is
no oracle; the stages are tested against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.llm import decontaminate, line_dedup, minhash, queries, toxicity
from aerolake.llm.common import prepare, stored, table


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    model = queries.fit_toxicity(spark, docs, sf_dir)
    scored = toxicity.score(docs, model, score_col="_score", passages_col="_passages")
    return scored.where("_score < 0.5").select(*docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    cut = line_dedup.deduplicate_lines(docs)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cut


def minhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return minhash.deduplicate(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return queries.bpe_digests(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line_dedup", line_dedup_stage),
    ("minhash", minhash_stage),
    ("decontamination", decontamination_stage),
    ("bpe", bpe_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


ORACLE_SQL = None

QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
