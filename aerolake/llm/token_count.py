"""Token counts by heap-and-linked-list byte-pair merging (operator 2).

The symbols of a segment form a doubly linked list; a heap holds every adjacent
pair that is a vocabulary piece, ordered by rank (the piece's score) and then
by position.  The lowest is popped again and again and merged while still
valid.  A segment's count is its symbols minus its merges; a symbol that is no
piece and was never merged counts as its UTF-8 bytes (byte fallback).  No ids
are ever formed.

A text is cut into segments at places no vocabulary piece can bridge, which is
derived from the vocabulary itself (see ``PieceCounter``), so that counting
segments apart equals counting the text whole and repeated segments are counted
once per worker (bounded two-generation cache).  No shuffle, no cross-row
state.

Defined results: null or empty text has 0 tokens; other columns pass through.
"""

from __future__ import annotations

import heapq
import string
from collections.abc import Iterable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from aerolake.llm.common import released, worker_state

SPACE = "▁"            # stands for a blank in the vocabulary's pieces
CACHE_SEGMENTS = 250_000    # per generation
LONGEST_CACHED = 64


class PieceCounter:
    """Counts tokens for a ``{piece: rank}`` vocabulary with byte fallback."""

    def __init__(self, ranks: dict[str, int]):
        if any(a != SPACE and b == SPACE for p in ranks for a, b in zip(p, p[1:])):
            raise ValueError("a piece spans a word boundary; segments can't be counted apart")
        self.ranks = ranks
        # punctuation that no piece joins to what stands before it (but other such
        # punctuation or a blank): a segment may end in front of it
        cut = set(string.punctuation)
        while True:
            joined = {b for p in ranks for a, b in zip(p, p[1:])
                      if b in cut and a not in cut and a != SPACE}
            if not joined:
                break
            cut -= joined
        marks = "".join(regex.escape(c) for c in sorted(cut))
        self.segments = regex.compile(
            f"{SPACE}*[{marks}]*[^{SPACE}{marks}]+|{SPACE}*[{marks}]+|{SPACE}+" if marks
            else f"{SPACE}*[^{SPACE}]+|{SPACE}+").findall
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def merge_count(self, text: str) -> int:
        """Tokens of one segment: initial symbols minus merges, unmerged
        unknown symbols as bytes."""
        ranks = self.ranks
        piece = list(text)
        n = len(piece)
        nxt = list(range(1, n + 1))
        prv = list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            rank = ranks.get(text[i:i + 2])
            if rank is not None:
                heap.append((rank, i, 2))
        heapq.heapify(heap)
        merges = 0
        while heap:
            rank, i, length = heapq.heappop(heap)
            left = piece[i]
            j = nxt[i]
            # stale: the left symbol is gone, or either side has grown
            if not left or j >= n or len(left) + len(piece[j]) != length \
                    or ranks.get(left + piece[j]) != rank:
                continue
            merged = piece[i] = left + piece[j]
            piece[j] = ""
            k = nxt[i] = nxt[j]
            merges += 1
            if k < n:
                prv[k] = i
                rank = ranks.get(merged + piece[k])
                if rank is not None:
                    heapq.heappush(heap, (rank, i, length + len(piece[k])))
            h = prv[i]
            if h >= 0:
                rank = ranks.get(piece[h] + merged)
                if rank is not None:
                    heapq.heappush(heap, (rank, h, len(piece[h]) + length))
        extra = sum(len(p.encode("utf-8", "surrogatepass")) - 1
                    for p in piece if len(p) == 1 and p not in ranks)
        return n - merges + extra

    def count(self, text: str) -> int:
        if not text:
            return 0
        total = 0
        young, old = self.young, self.old
        for segment in self.segments(SPACE + text.replace(" ", SPACE)):
            n = young.get(segment)
            if n is None:
                n = old.get(segment)
                if n is None:
                    n = self.merge_count(segment)
                if len(segment) <= LONGEST_CACHED:
                    young[segment] = n
                    if len(young) > CACHE_SEGMENTS:
                        self.old, self.young = old, young = young, {}
            total += n
        return total


def load_counter(model_path: str) -> PieceCounter:
    """A worker's counter for the model."""
    return worker_state(("pieces", model_path), lambda: read_counter(model_path))


def read_counter(model_path: str) -> PieceCounter:
    """The counter for a sentencepiece BPE model with an identity normaliser."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    ids = [i for i in range(model.get_piece_size())
           if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))]
    # the highest score merges first
    ids.sort(key=lambda i: -model.get_score(i))
    return PieceCounter({model.id_to_piece(i): rank for rank, i in enumerate(ids)})


def token_counts(df: DataFrame, model_path: str, text_col: str = "text",
                 out_col: str = "n_tokens") -> DataFrame:
    """``df`` plus ``out_col``, the number of tokens of the whole text."""
    if out_col in df.columns:
        raise ValueError(f"column {out_col} exists already")
    at = df.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = load_counter(model_path).count
        for batch in batches:
            counts = pa.array([count(t or "") for t in batch.column(at).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, counts], [*batch.schema.names, out_col])

    return df.mapInArrow(released(run), T.StructType([*df.schema.fields, T.StructField(out_col, T.LongType())]))
