"""Byte-level BPE encoding and decoding by corpus-level merge replay (operator 5).

Every Arrow block of documents is treated as a small corpus: its distinct
pre-tokens ("words") are laid out in one array of symbols, an inverted index
maps each adjacent token pair (by the rank of the token it would form) to the
positions where it stands, and the merges are replayed in rank order over the
whole block.  A merge rewrites one symbol and touches only its two neighbours,
whose new pairs are posted to the index.  The ids of a document are then the
concatenated ids of its words.

Ids travel as little-endian unsigned 32-bit integers in a binary column, four
bytes a token.  There is no shuffle and no state outside a task: a lost
executor costs the re-run of its tasks.  Memory is bounded by one Arrow block
plus a two-generation cache of encoded words.

Defined results: a null or empty text has no tokens (empty binary); other
columns pass through untouched, repeated rows give repeated results.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from aerolake.llm.common import released, worker_state

CACHE_WORDS = 400_000       # words per cache generation (two generations a worker, about 200 bytes a word)
CACHED_PAIRS = 400_000      # pairs whose rank a worker remembers
LONGEST_CACHED = 64         # longer words are encoded, not kept


def load_ranks(path: str) -> dict[bytes, int]:
    """``base64-token rank`` lines -> {token bytes: rank}."""
    with open(path, "rb") as f:
        return {base64.b64decode(tok): int(rank)
                for tok, rank in (line.split() for line in f if line.strip())}


class _Pairs(dict):
    """left << 32 | right -> rank of their merge, or -1; remembers a bounded number."""

    def __init__(self, ranks: dict[bytes, int], token: dict[int, bytes]):
        super().__init__()
        self.ranks, self.token = ranks, token

    def __missing__(self, key: int) -> int:
        if len(self) > CACHED_PAIRS:
            self.clear()
        rank = self[key] = self.ranks.get(self.token[key >> 32] + self.token[key & 0xFFFFFFFF], -1)
        return rank


class MergeReplay:
    """Encodes words by replaying merges in rank order over all words at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {rank: tok for tok, rank in ranks.items()}
        self.first = [ranks[bytes([b])] for b in range(256)]
        self.byte_pairs = [ranks.get(bytes((a, b)), -1) for a in range(256) for b in range(256)]
        self.pairs = _Pairs(ranks, self.token)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def replay(self, words: list[bytes]) -> list[list[int]]:
        """Token ids of each word.

        Positions of one rank are merged left to right.  Where a merge makes
        possible one of a lower rank in the same word, the word's remaining
        positions of this rank wait until that one is done, so each word goes
        through exactly the lowest-rank-first order.
        """
        sym: list[int] = []
        nxt: list[int] = []
        prv: list[int] = []
        word_of: list[int] = []
        starts: list[int] = []
        postings: dict[int, list[int]] = {}
        heap: list[int] = []
        pairs, first, byte_pairs = self.pairs, self.first, self.byte_pairs

        def post(rank: int, at: int) -> None:
            places = postings.get(rank)
            if places is None:
                postings[rank] = [at]
                heapq.heappush(heap, rank)
            else:
                places.append(at)

        for w, word in enumerate(words):
            base, n = len(sym), len(word)
            starts.append(base)
            sym.extend([first[b] for b in word])
            nxt.extend(range(base + 1, base + n + 1))
            prv.extend(range(base - 1, base + n - 1))
            word_of.extend([w] * n)
            nxt[-1] = -1
            prv[base] = -1
            at = base
            for left, right in zip(word, word[1:]):
                rank = byte_pairs[left << 8 | right]
                if rank >= 0:
                    places = postings.get(rank)
                    if places is None:
                        post(rank, at)
                    else:
                        places.append(at)
                at += 1

        while heap:
            rank = heapq.heappop(heap)
            places = postings.pop(rank)
            places.sort()
            waiting: set[int] = set()
            later: list[int] = []
            for at in places:
                right = nxt[at]
                if right < 0 or sym[at] < 0 or pairs[sym[at] << 32 | sym[right]] != rank:
                    continue
                if waiting and word_of[at] in waiting:
                    later.append(at)
                    continue
                after, before = nxt[right], prv[at]
                sym[at], sym[right] = rank, -1
                nxt[at] = after
                if after >= 0:
                    prv[after] = at
                    new = pairs[rank << 32 | sym[after]]
                    if new >= 0:
                        post(new, at)
                        if new < rank:
                            waiting.add(word_of[at])
                if before >= 0:
                    new = pairs[sym[before] << 32 | rank]
                    if new >= 0:
                        post(new, before)
                        if new < rank:
                            waiting.add(word_of[at])
            for at in later:
                post(rank, at)

        out = []
        for at in starts:
            ids = []
            while at >= 0:
                ids.append(sym[at])
                at = nxt[at]
            out.append(ids)
        return out

    def encode(self, texts_words: list[list[str]]) -> list[bytes]:
        """Little-endian ids of each text, given as its list of words."""
        known: dict[str, bytes] = {}
        fresh: dict[str, bytes] = {}
        young, old, ranks = self.young, self.old, self.ranks
        for words in texts_words:
            for word in set(words).difference(known):
                ids = young.get(word) or old.get(word)
                if ids is None:
                    raw = word.encode("utf-8", "surrogatepass")
                    rank = ranks.get(raw)
                    if rank is None:
                        fresh[word] = raw
                        ids = b""
                    else:
                        ids = struct.pack("<I", rank)
                known[word] = ids
        for word, ids in zip(fresh, self.replay(list(fresh.values()))):
            known[word] = struct.pack(f"<{len(ids)}I", *ids)
        # words of this block stay for the next ones
        young.update((w, known[w]) for w in fresh if len(w) <= LONGEST_CACHED)
        if len(young) > CACHE_WORDS:
            self.old, self.young = young, {}
        return [b"".join(map(known.__getitem__, words)) for words in texts_words]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, memoryview(ids).cast("I").tolist()))


def _codec(path: str) -> MergeReplay:
    return worker_state(("bpe", path), lambda: MergeReplay(load_ranks(path)))


@functools.lru_cache(maxsize=2)
def _words(pattern: str):
    # \s of the tokenizer is the Unicode White_Space property
    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall


def _append(batch: pa.RecordBatch, values: list, name: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.binary())],
                                      [*batch.schema.names, name])


def bpe_encode(df: DataFrame, ranks_path: str, pattern: str, text_col: str = "text",
               ids_col: str = "ids") -> DataFrame:
    """``df`` plus ``ids_col``: the text's token ids, 4 little-endian bytes each.

    Special tokens are not recognised; each match of ``pattern`` is encoded by
    itself.  ``ids_col`` must not be a column of ``df``.
    """
    if ids_col in df.columns:
        raise ValueError(f"column {ids_col} exists already")
    at = df.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, words = _codec(ranks_path), _words(pattern)
        for batch in batches:
            texts = batch.column(at).to_pylist()
            yield _append(batch, codec.encode([words(t) if t else [] for t in texts]), ids_col)

    return df.mapInArrow(released(run), T.StructType([*df.schema.fields, T.StructField(ids_col, T.BinaryType())]))


def bpe_decode(df: DataFrame, ranks_path: str, ids_col: str = "ids",
               bytes_col: str = "decoded") -> DataFrame:
    """``df`` plus ``bytes_col``: the bytes that the ids stand for (null ids: none)."""
    if bytes_col in df.columns:
        raise ValueError(f"column {bytes_col} exists already")
    at = df.columns.index(ids_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks_path)
        for batch in batches:
            yield _append(batch, [codec.decode(ids) if ids else b"" for ids in batch.column(at).to_pylist()], bytes_col)

    return df.mapInArrow(released(run), T.StructType([*df.schema.fields, T.StructField(bytes_col, T.BinaryType())]))


def round_trip_digests(df: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of ``df`` (doc_id, text): encoded,
    then decoded from the ids, in one step, so that neither leaves the task."""
    id_type = df.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, words = _codec(ranks_path), _words(pattern)
        for batch in batches:
            encoded = codec.encode([words(t) if t else [] for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(ids) // 4 for ids in encoded], pa.int64()),
                 pa.array([hashlib.sha256(ids).hexdigest() for ids in encoded], pa.string()),
                 pa.array([hashlib.sha256(codec.decode(ids)).hexdigest() for ids in encoded], pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return df.select("doc_id", "text").mapInArrow(
        released(run), f"doc_id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
