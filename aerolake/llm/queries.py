"""The registered queries of the training-data operators.

Each applies its operator with production parameters to its whole table and
derives the contract's columns from the operator's outputs.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolake.llm import (
    bpe_codec, decontaminate, fill_middle, filter_audit, html_text, license_scan, line_dedup, minhash, quality, suffix_dedup,
    token_count, toxicity, warc)
from aerolake.llm.common import prepare, sha256_hex, table
from aerolake.session import fresh_path

OVER_LIMIT_TOKENS = 4096


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    pairs = decontaminate.leaked_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return pairs.select("doc_id", "item_id", "n_item_tokens", "n_matched", "coverage",
                        F.size("tiles").alias("n_tiles"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_count.token_counts(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"), "n_tokens",
        (F.col("n_tokens") > OVER_LIMIT_TOKENS).alias("over_limit"))


def held_out(doc_id: str = "doc_id"):
    """The fold that no model learns from."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def fit_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.ToxicityModel:
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where(~held_out())
    return toxicity.fit(docs, labels)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, fit_toxicity(spark, docs, sf_dir))
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("passages").alias("n_passages"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    judged = quality.judge(quality.text_statistics(docs))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept", "distance")


def op5_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return bpe_digests(table(spark, sf_dir, "documents").select("doc_id", "text"))


def bpe_digests(docs: DataFrame) -> DataFrame:
    """Encode and decode ``docs`` (doc_id, text); one row of digests per document."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe_codec.round_trip_digests(docs, ranks, public_tokenizers.PATTERN)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), keep_first=False)
    return cut.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), sha256_hex("kept").alias("kept_sha256"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lines = line_dedup.line_decisions(docs)
    by_doc = lines.groupBy("doc_id").agg(
        F.count("*").alias("n_lines"), F.sum("n_links").alias("n_links"),
        F.array_sort(F.collect_list(F.when(~F.col("kept"), F.col("line_no")))).alias("removed"))
    return docs.select("doc_id").join(by_doc, "doc_id", "left").select(
        "doc_id", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce(F.size("removed"), F.lit(0)).alias("n_removed"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed_lines"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    extracted = html_text.extract_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return extracted.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    path = fresh_path(spark, "warc")
    warc.write_warc(warc.plan_records(table(spark, sf_dir, "pages").select("page_id", "url", "html")), path)
    # what a response says of its payload is taken from the payload itself
    responses = warc.read_warc(spark, path).where("record_type = 'response'").withColumns(
        {"payload_digest": F.sha1("payload"), "payload_bytes": F.octet_length("payload").cast("bigint")})
    revisits = warc.read_warc(spark, path, payload=False).where("record_type = 'revisit'")
    return responses.drop("payload").unionByName(revisits.drop("payload")).select(
        warc.page_id_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warc.page_id_of("refers_to").alias("refers_to"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    made = fill_middle.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha256_hex("output").alias("output_sha256"),
                       sha256_hex(fill_middle.restored()).alias("restored_sha256"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """[native]"""
    found = license_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    joined = lambda c: F.array_join(c, ",").alias(c)       # noqa: E731
    return found.select("doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"),
                        F.array_min("places").cast("bigint").alias("first_word"),
                        F.array_max("places").cast("bigint").alias("last_word"),
                        joined("base_labels"), joined("labels"), "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_token_counts": op2_token_counts,
    "op3_toxicity": op3_toxicity,
    "op4_quality": op4_quality,
    "op5_bpe_codec": op5_bpe_codec,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_line_dedup": op7_line_dedup,
    "op8_html_text": op8_html_text,
    "op9_minhash": op9_minhash,
    "op10_warc": op10_warc,
    "op11_fill_middle": op11_fill_middle,
    "op12_filter_audit": op12_filter_audit,
    "op13_license_scan": op13_license_scan,
}

ORACLE: dict[str, str] = {
    "op10_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS payload_digest FROM p),
r AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes)
                     ELSE page_id END AS top FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN top = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN top <> page_id THEN top END AS refers_to FROM r""",
    "op11_fill_middle": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id) AS x FROM documents),
h AS (SELECT doc_id, t, length(t)::BIGINT AS n, ('0x' || substr(x, 1, 8))::BIGINT AS h1, ('0x' || substr(x, 9, 8))::BIGINT AS h2,
             ('0x' || substr(x, 17, 8))::BIGINT AS h3, ('0x' || substr(x, 25, 8))::BIGINT AS h4 FROM d),
c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
             CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                  WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
s AS (SELECT *, substring(t, 1, a) AS p, substring(t, a + 1, b - a) AS m, substring(t, b + 1) AS z FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || z || '<M>' || m
                        ELSE '<S>' || z || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256 FROM s""",
    "op12_filter_audit": r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d),
f AS (SELECT part, len(words) < 50 AS a, 100 * len(list_distinct(words)) < 65 * len(words) AS b,
             100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
             coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false) AS e,
             coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS bad
      FROM w LEFT JOIN labels USING (doc_id)),
m AS (SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS bits, count(*) AS n,
             count(*) FILTER (good) AS g, count(*) FILTER (bad) AS x FROM f GROUP BY 1, 2),
l AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(l, bit)),
p AS (SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS o
      FROM l a, l b, l c, l d, l e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s AS (SELECT filter_order, step, o[step] AS own, coalesce(list_sum(o[1:step - 1]), 0)::INT AS earlier
      FROM p, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
q AS (SELECT part, filter_order, step, own,
             sum(CASE WHEN bits & (earlier | own) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
             sum(CASE WHEN bits & earlier = 0 AND bits & own <> 0 THEN n ELSE 0 END)::BIGINT AS removed,
             sum(CASE WHEN bits & earlier <> 0 AND bits & own <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
             sum(CASE WHEN bits = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
             sum(CASE WHEN bits & earlier = 0 AND bits & own <> 0 THEN g ELSE 0 END)::BIGINT AS good_lost,
             sum(CASE WHEN bits & earlier = 0 AND bits & own <> 0 THEN x ELSE 0 END)::BIGINT AS toxic_lost
      FROM m, s GROUP BY ALL)
SELECT * EXCLUDE (own), (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM q""",
}
