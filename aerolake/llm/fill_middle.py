"""Fill-in-the-middle transformation by a Roaring-style boundary set (operator 11).

The places where a text may be cut are the byte offsets at which its code points
begin, and its end.  They are kept as a set in chunks of 65,536 offsets, each in
the smallest of three containers:

array    the offsets themselves, two bytes each (few boundaries)
bitmap   one bit an offset (dense and irregular: mixed scripts)
run      first offset and length of each run (plain ASCII is one run)

The cumulative cardinalities of the containers lead to the one that holds the
k-th boundary (binary search), and a local select in it gives the byte offset: an
index into the array, popcounts of the bitmap's words and then one word's bits, or
a binary search over the cumulative run lengths.  Both cuts of a document come
from one set, so the text is cut as UTF-8 bytes and never decoded.

Cuts and forms follow from the document's id alone (``fractions``), so a task that
is run again gives the same rows.  Each task holds one batch of whole texts; the
set of a text takes at most an eighth of its bytes.  No shuffle.

Defined results: null text is the empty text; a text that is empty or contains a
sentinel stays plain; a row without doc_id is hashed as if its id were empty; rows
that repeat a doc_id are each cut by it; other columns are ignored.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 16
ARRAY, BITMAP, RUN = "array", "bitmap", "run"

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 1
PLAIN_FROM = 90         # of 100: documents that stay plain
SPM_BELOW = 20          # of 100: of the others, those that put the suffix first


class ArrayContainer:
    kind = ARRAY

    def __init__(self, member: np.ndarray):
        self.offsets = np.flatnonzero(member).astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.offsets[k])


class BitmapContainer:
    kind = BITMAP

    def __init__(self, member: np.ndarray):
        bits = np.zeros(CHUNK, dtype=bool)
        bits[:len(member)] = member
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.upto = np.cumsum(np.bitwise_count(self.words), dtype=np.int64)

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.upto, k, side="right"))
        within = k - (int(self.upto[word - 1]) if word else 0)
        bits = np.unpackbits(self.words[word:word + 1].view(np.uint8), bitorder="little")
        return 64 * word + int(np.flatnonzero(bits)[within])


class RunContainer:
    kind = RUN

    def __init__(self, first: np.ndarray, length: np.ndarray):
        self.first = first
        self.upto = np.cumsum(length, dtype=np.int64)

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.upto, k, side="right"))
        return int(self.first[run]) + k - (int(self.upto[run - 1]) if run else 0)


def container(member: np.ndarray):
    """The smallest container for the members of one chunk (a mask)."""
    edges = np.flatnonzero(member[1:] != member[:-1]) + 1
    bounds = np.concatenate(([0] if member[0] else [], edges, [len(member)] if member[-1] else [])).astype(np.int64)
    first, length = bounds[::2], bounds[1::2] - bounds[::2]
    cardinality = int(length.sum())
    sizes = {RUN: 2 + 4 * len(first), ARRAY: 2 * cardinality, BITMAP: CHUNK // 8}
    smallest = min(sizes, key=sizes.get)
    if smallest == RUN:
        return RunContainer(first, length), cardinality
    return (ArrayContainer if smallest == ARRAY else BitmapContainer)(member), cardinality


class BoundarySet:
    """The code-point boundaries of a UTF-8 text, its end included."""

    def __init__(self, text: bytes):
        units = np.frombuffer(text, dtype=np.uint8)
        self.containers, self.before, total = [], [], 0
        for at in range(0, len(units) + 1, CHUNK):
            member = (units[at:at + CHUNK] & 0xC0) != 0x80
            if at + CHUNK > len(units):
                member = np.append(member, True)        # the end of the text
            held, cardinality = container(member)
            self.containers.append(held)
            self.before.append(total)
            total += cardinality
        self.cardinality = total

    def select(self, k: int) -> int:
        """The byte offset of boundary ``k`` (from 0)."""
        if not 0 <= k < self.cardinality:
            raise IndexError(k)
        c = bisect.bisect_right(self.before, k) - 1
        return c * CHUNK + self.containers[c].select(k - self.before[c])


def fractions(doc_id: str = "doc_id", seed: int = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers from the document's id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def rearrange(text: bytes, h: tuple[int, int, int, int], sentinels: tuple[bytes, bytes, bytes], plain_from: int,
              spm_below: int) -> tuple[int, str, int | None, int | None, bytes]:
    """(n, form, prefix_chars, middle_chars, output) of one text."""
    found = BoundarySet(text)
    n = found.cardinality - 1
    if not n or h[2] % 100 >= plain_from or any(s in text for s in sentinels):
        return n, "plain", None, None, text
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    i, j = found.select(low), found.select(high)
    p, s, m = sentinels
    if h[3] % 100 < spm_below:
        return n, "spm", low, high - low, b"".join((s, text[j:], p, text[:i], m, text[i:j]))
    return n, "psm", low, high - low, b"".join((p, text[:i], s, text[j:], m, text[i:j]))


def _transform(sentinels: tuple[bytes, bytes, bytes], plain_from: int, spm_below: int):
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    types = [None, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = zip(*(batch.column(i).to_pylist() for i in range(2, 6)))
            rows = [rearrange(text.as_py() or b"", h, sentinels, plain_from, spm_below)
                    for text, h in zip(batch.column(1).cast(pa.binary()), numbers)]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), types[1:])] if rows else [
                pa.array([], t) for t in types[1:]]
            columns[-1] = columns[-1].cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)
    return run


def fill_in_middle(docs: DataFrame, seed: int = SEED, sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE),
                   plain_from: int = PLAIN_FROM, spm_below: int = SPM_BELOW) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) for every row of
    ``docs`` (doc_id, text).  ``sentinels`` begin prefix, suffix and middle; none
    may be empty or part of another."""
    h = [x.alias(f"_h{i}") for i, x in enumerate(fractions(seed=seed))]
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", *h).mapInArrow(
        _transform(tuple(s.encode() for s in sentinels), plain_from, spm_below),
        f"doc_id {id_type}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restored(output: str = "output", form: str = "form",
             sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text that ``output`` was made from.  The three parts hold no sentinel, so
    the first of each is the one that was set."""
    p, s, m = sentinels
    out = F.col(output)
    body = lambda first: F.substring(out, F.lit(len(first) + 1), F.char_length(out))      # noqa: E731
    head = lambda first, second: F.substring_index(body(first), second, 1)                  # noqa: E731
    tail = lambda first, second: F.substring_index(F.substring_index(body(first), second, -1), m, 1)     # noqa: E731
    middle = F.substring_index(out, m, -1)
    return (F.when(F.col(form) == "psm", F.concat(head(p, s), middle, tail(p, s)))
            .when(F.col(form) == "spm", F.concat(tail(s, p), middle, head(s, p))).otherwise(out))
