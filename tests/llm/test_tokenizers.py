"""Operators 2 and 5 against the public tokenizer libraries."""

import base64
import hashlib
import random
import struct

import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken

from aerolake.llm import bpe_codec, token_count
from aerolake.llm.common import prepare

MODEL = P.path("piece_bpe_32k.model")
RANKS = P.path("byte_bpe_multi_50k.tiktoken")

TEXTS = [
    None, "", " ", "   ", "\n", "a", "  two  blanks ", "tab\tand\r\nnew\x1c\x1d\x85line  x　y", "<s> </s> <unk> <|endoftext|>",
    "Ça été l'œuvre d'İstanbul; ß straße — naïve", "日本語のテキスト 12345 ١٢٣", "🙂🙃 👩‍👩‍👧 é", "\u0000 nul",
    "a▁b ▁ c", "x" * 3000, " " * 500 + "z", "ab" * 2000, "don't we'll I'd 'S", "﻿bom ﬁ", "1" * 333,
    "the quick brown fox, jumps over. the (lazy) dog! " * 200,
]
rng = random.Random(7)
ALPHABET = list("abcdefgh  \n\t,.'!-_/<>0123456789éüñß▁日本🙂\x1c\x85 ​")
TEXTS += ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(1, 400))) for _ in range(300)]


@pytest.fixture(scope="module")
def reference_encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_count_equals_library():
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    counter = token_count.load_counter(MODEL)
    for text in TEXTS:
        assert counter.count(text or "") == len(sp.encode(text or "")), text


def test_whole_text_equals_segments():
    counter = token_count.load_counter(MODEL)
    for text in TEXTS[-40:]:
        assert counter.count(text) == counter.merge_count(token_count.SPACE + text.replace(" ", token_count.SPACE))


def test_replay_equals_library(reference_encoding):
    codec = bpe_codec.MergeReplay(bpe_codec.load_ranks(RANKS))
    words = bpe_codec._words(P.PATTERN)
    got = codec.encode([words(t or "") for t in TEXTS])
    for text, ids in zip(TEXTS, got):
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == reference_encoding.encode_ordinary(text or ""), text


def test_replay_waits_for_lower_ranks():
    # b+c (rank 300) makes a+bc possible at the lower rank 290: it must come
    # before the second b+c of the word
    ranks = {bytes([b]): b for b in range(256)} | {b"abc": 290, b"bc": 300, b"abcb": 280, b"cbc": 299}
    codec = bpe_codec.MergeReplay(ranks)
    enc = tiktoken.Encoding("t", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 12))) for _ in range(400)]
    for word, ids in zip(words, codec.encode([[w] for w in words])):
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == enc.encode_ordinary(word)


def test_frames(spark, reference_encoding):
    prepare(spark)
    rows = [(i, t, "kept") for i, t in enumerate(TEXTS)] + [(0, None, "again"), (None, "x y", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_bytes string").repartition(3)
    counted = {(r.doc_id, r.n_bytes): r.n_tokens for r in token_count.token_counts(df, MODEL).collect()}
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert counted == {(i, c): len(sp.encode(t or "")) for i, t, c in rows}
    coded = bpe_codec.bpe_decode(bpe_codec.bpe_encode(df, RANKS, P.PATTERN), RANKS).collect()
    assert len(coded) == len(rows)
    for r in coded:
        assert bytes(r.decoded) == (r.text or "").encode()
        assert len(r.ids) // 4 == len(reference_encoding.encode_ordinary(r.text or ""))
    empty = df.limit(0)
    assert token_count.token_counts(empty, MODEL).count() == 0
    assert bpe_codec.bpe_decode(bpe_codec.bpe_encode(empty, RANKS, P.PATTERN), RANKS).count() == 0
    with pytest.raises(ValueError):
        token_count.token_counts(df, MODEL, out_col="n_bytes")


def test_queries(spark, reference_encoding):
    from aerolake.llm import queries

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    got = queries.op2_token_counts(spark, sf).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in got} == {
        d: (len((t or "").encode()), n := len(sp.encode(t or "")), n > 4096) for d, t in texts.items()}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    got = queries.op5_bpe_codec(spark, sf).collect()
    expected = {}
    for d, t in texts.items():
        ids = reference_encoding.encode_ordinary(t or "")
        expected[d] = (len(ids), sha(struct.pack(f"<{len(ids)}I", *ids)), sha((t or "").encode()))
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == expected


def test_digests_equal_encoding_and_decoding_apart(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)] + [(0, "again"), (None, "no id"), (99, "long " * 300_000)],
                               "doc_id bigint, text string")
    prepare(spark)
    sha = lambda b: hashlib.sha256(b).hexdigest()      # noqa: E731
    apart = bpe_codec.bpe_decode(bpe_codec.bpe_encode(df, RANKS, P.PATTERN), RANKS).collect()
    got = bpe_codec.round_trip_digests(df, RANKS, P.PATTERN).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(
        repr((r.doc_id, len(r.ids) // 4, sha(bytes(r.ids)), sha(bytes(r.decoded)))) for r in apart)
