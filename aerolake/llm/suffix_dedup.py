"""Repeated byte strings by longest-previous-factor arrays (operator 6).

A *window* is a string of ``MIN_BYTES`` bytes within one text.  The operator
finds, for every window, whether it stands earlier (in order of doc_id, then
place) and whether it stands later, and removes what the windows cover.

A corpus-wide suffix array is cut into independent pieces by content:

1. The anchor of a window is its leftmost 48-byte gram of least hash, so equal
   windows have equal anchors; about one position in 77 is an anchor of some
   window.  Consecutive windows of one anchor make a *context* (at most 352
   bytes).  Light rows (gram hash, context hash) are combined map-side: a gram
   that occurs once repeats nothing; if all its contexts are equal, all their
   windows repeat, and nothing else has to move.
2. Only for grams with different contexts are context bytes fetched and equal
   ones merged.  The windows of many grams are put in suffix order together
   (ranks of 4, 8, ... bytes up to the window), and the earlier matches are read
   off the order by previous and next smaller positions: the longest previous
   factor of a position is its longest common prefix with either neighbour.
   Run backwards, the same finds the later matches.
3. A gram with more than ``BUCKET`` different contexts would not fit one task:
   its windows are matched one by one by their 128-bit hashes, map-side
   combined, which is exact for any number.
4. Per document the repeated windows become byte spans.

Defined results: a null text is empty; texts below ``MIN_BYTES`` repeat nothing;
matches never cross documents; removal is judged on the input.  Rows are told
apart by doc_id and text, so rows repeated in full are copies of each other (all
of them lose the bytes, or, keeping first copies, none does by the other).
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.llm.common import stored

MIN_BYTES = 200
GRAM = 48
BLOCK_BITS = 21             # texts are hashed in blocks of up to 2 MiB
BUCKET = 8192               # different contexts of one gram that a task compares (about 2.3 MB)
SORT_BYTES = 1 << 20        # context bytes that are put in suffix order together

ROUNDS = 64                 # of looking past entries, all at once

BASE = 0x9FB21C651E98DF25
INVERSE = pow(BASE, -1, 1 << 64)
U = np.uint64


@functools.lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    out = []
    for b in (BASE, INVERSE):
        p = np.full((1 << BLOCK_BITS) + 1, b, dtype=np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def _sliding_least(v: np.ndarray, width: int) -> np.ndarray:
    cover = 1
    while cover * 2 <= width:
        v = np.minimum(v[:-cover], v[cover:])
        cover *= 2
    rest = width - cover
    return np.minimum(v[:-rest], v[rest:]) if rest else v


def _block_contexts(texts: list[bytes], min_bytes: int, gram: int):
    """(text number, first and last window start, gram hash, context hash) of the
    contexts of texts that fit one block together."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    x = np.frombuffer(b"".join(texts), dtype=np.uint8)
    power, inverse = _powers()
    n = len(x)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((x.astype(np.uint64) + U(1)) * power[:n], out=total[1:])
    h = _mix((total[gram:] - total[:-gram]) * inverse[:n - gram + 1])
    low = U((1 << BLOCK_BITS) - 1)
    least = _sliding_least((h & ~low) | np.arange(len(h), dtype=np.uint64), min_bytes - gram + 1)
    ends = np.cumsum(lengths)
    # window starts that stay within their text
    counts = np.maximum(0, lengths - min_bytes + 1)
    starts = np.repeat(ends - lengths - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
    anchor = (least[starts] & low).astype(np.int64)
    cut = np.flatnonzero(np.diff(anchor)) + 1
    first, last = np.concatenate(([0], cut)), np.concatenate((cut - 1, [len(starts) - 1]))
    lo, hi, at = starts[first], starts[last], anchor[first]
    context = (total[hi + min_bytes] - total[lo]) * inverse[lo]
    context = _mix(context ^ (hi - lo).astype(np.uint64) * U(0xC2B2AE3D27D4EB4F) ^ (at - lo).astype(np.uint64) << U(40))
    which = np.searchsorted(ends, lo, side="right")
    begin = (ends - lengths)[which]
    return which, lo - begin, hi - begin, h[at].view(np.int64), context.view(np.int64)


def contexts(texts: list[bytes], min_bytes: int = MIN_BYTES, gram: int = GRAM):
    """The contexts of ``texts``, in parts: (text number, lo, hi, gram hash, context
    hash) arrays.  A text beyond a block is cut, with windows in one piece only."""
    room = 1 << BLOCK_BITS
    block: list[bytes] = []
    origin: list[tuple[int, int]] = []
    held = 0

    def finish():
        which, lo, hi, g, c = _block_contexts(block, min_bytes, gram)
        number = np.array([o[0] for o in origin])[which]
        shift = np.array([o[1] for o in origin])[which]
        return number, lo + shift, hi + shift, g, c

    for number, text in enumerate(texts):
        if len(text) < min_bytes:
            continue
        for at in range(0, len(text) - min_bytes + 1, room - min_bytes + 1):
            piece = text[at:at + room]
            if held + len(piece) > room:
                yield finish()
                block, origin, held = [], [], 0
            block.append(piece)
            origin.append((number, at))
            held += len(piece)
    if block:
        yield finish()


# --- suffix order of a bucket of contexts ------------------------------------

def _ranks(key: np.ndarray, bits: int) -> np.ndarray:
    """Dense ranks of unsigned keys below ``2 ** bits``.  Where key and place fit one
    number, numbers are sorted in place of an order of places."""
    n = len(key)
    width = max(1, n - 1).bit_length()
    if bits + width > 64 or not n:
        return np.unique(key, return_inverse=True)[1].astype(np.int64)
    packed = key << U(width) | np.arange(n, dtype=np.uint64)
    packed.sort()
    at = (packed & U((1 << width) - 1)).astype(np.int64)
    packed >>= U(width)
    out = np.empty(n, dtype=np.int64)
    out[at] = np.concatenate(([0], np.cumsum(packed[1:] != packed[:-1])))
    return out


def _pair_ranks(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Dense ranks of pairs of ranks."""
    bits = [int(r.max()).bit_length() if len(r) else 0 for r in (high, low)]
    return _ranks(high.astype(np.uint64) << U(bits[1]) | low.astype(np.uint64), sum(bits))


def window_ranks(data: bytes, starts: np.ndarray, length: int) -> np.ndarray:
    """Rank of the ``length`` bytes from each start, in byte order (equal strings
    have equal ranks)."""
    x = np.frombuffer(data + b"\0" * 8, dtype=np.uint8)
    n = len(data)
    key = np.zeros(n, dtype=np.uint64)
    for k in range(4):
        key = key << U(8) | x[k:k + n]
    ranks = {4: _ranks(key, 32)}
    size = 4
    while size * 2 <= length:
        r = ranks[size]
        ranks[size * 2] = _pair_ranks(r, np.concatenate((r[size:], np.zeros(min(size, n), dtype=np.int64)))[:n])
        size *= 2
    out, at = np.zeros(len(starts), dtype=np.int64), 0
    for size in sorted(ranks, reverse=True):
        while at + size <= length:
            out = _pair_ranks(out, ranks[size][starts + at]) if at else ranks[size][starts]
            at += size
    for k in range(at, length):
        out = _pair_ranks(out, x[starts + k])
    return _ranks(out.astype(np.uint64), int(out.max()).bit_length()) if len(out) else out


def _with_smaller_before(position: np.ndarray, lcp: np.ndarray, past=np.greater) -> np.ndarray:
    """The common prefix of each entry with the last one before it at a smaller
    position (or an equal one, with ``greater``), 0 without one.  ``lcp`` is that of
    each entry with the one before it.

    Entries look past neighbours at greater positions, all at once: what such a
    neighbour has passed lies at greater positions too, so its own reach is taken over.
    """
    n = len(position)
    place = np.concatenate((np.arange(-1, n - 1), [-1]))          # the entry before the first is none
    common = np.concatenate((lcp, [0]))
    common[0] = 0
    at = np.concatenate((position, [np.iinfo(np.int64).min]))
    left = np.arange(n)
    for _ in range(ROUNDS):
        left = left[past(at[place[left]], at[left]) & (common[left] > 0)]
        if not len(left):
            return common[:-1]
        over = place[left]
        common[left], place[left] = np.minimum(common[left], common[over]), place[over]
    for i in left.tolist():                                         # many small steps: one by one
        while common[i] > 0 and past(at[place[i]], at[i]):
            common[i], place[i] = min(common[i], common[place[i]]), place[place[i]]
    return common[:-1]


def longest_previous_factors(position, lcp) -> np.ndarray:
    """For entries in suffix order with their text positions and the longest common
    prefix of each with the entry before it: the length of the longest match of
    each at an earlier position.

    That is the longer common prefix of those with its previous and its next entry in
    suffix order at a smaller position."""
    position, lcp = np.asarray(position, dtype=np.int64), np.asarray(lcp, dtype=np.int64)
    if not len(position):
        return lcp
    before = _with_smaller_before(position, lcp)
    after = _with_smaller_before(position[::-1], np.concatenate(([0], lcp[:0:-1])), np.greater_equal)
    return np.maximum(before, after[::-1])


def repeated_windows(rows: list[tuple[bytes, int]], min_bytes: int) -> tuple[np.ndarray, ...]:
    """For contexts (bytes, text position of the first window): the runs of windows that
    stand elsewhere, consecutive and with equal flags, as (context, first, last,
    earlier, later) arrays in order."""
    data = b"".join(r[0] for r in rows)
    lengths = np.array([len(r[0]) for r in rows])
    begins = np.cumsum(lengths) - lengths
    counts = lengths - min_bytes + 1
    owner = np.repeat(np.arange(len(rows)), counts)
    offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    rank = window_ranks(data, begins[owner] + offset, min_bytes)
    # windows without an equal one have no match of min_bytes
    window = np.flatnonzero(np.bincount(rank)[rank] > 1) if len(rank) else np.zeros(0, dtype=np.int64)
    owner, offset, rank = owner[window], offset[window], rank[window]
    position = np.array([r[1] for r in rows], dtype=np.int64)[owner] + offset
    order = np.lexsort((position, rank))
    lcp = np.concatenate(([0], np.diff(rank[order]) == 0))[:len(order)] * min_bytes
    earlier, later = np.zeros(len(order), dtype=bool), np.zeros(len(order), dtype=bool)
    earlier[order] = longest_previous_factors(position[order], lcp) >= min_bytes
    later[order] = longest_previous_factors(-position[order], lcp) >= min_bytes
    ends = np.flatnonzero((np.diff(owner) != 0) | (np.diff(offset) != 1) | (np.diff(earlier) != 0) | (np.diff(later) != 0))
    first = np.concatenate(([0], ends + 1))[:len(owner)]
    last = np.concatenate((ends, [len(owner) - 1]))[:len(owner)]
    return owner[first], offset[first], offset[last], earlier[first], later[first]


# --- Spark -------------------------------------------------------------------

RUN = "array<struct<first:int,last:int,earlier:boolean,later:boolean>>"
RUN_ARROW = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("earlier", pa.bool_()), ("later", pa.bool_())])


def _keys(docs: DataFrame) -> DataFrame:
    """(doc_id, t, text): t is a hash of the text; t and doc_id tell rows apart."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("t"),
                       F.col("text").cast("binary").alias("text"))


def _light(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = np.array([-(1 << 63) if d is None else d for d in batch.column(0).to_pylist()], dtype=np.int64)
        for number, _, _, g, c in contexts([t or b"" for t in batch.column(1).to_pylist()]):
            yield pa.RecordBatch.from_arrays([pa.array(g), pa.array(c), pa.array(ids[number])], ["g", "c", "doc"])


def _places(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, keys = batch.column(0), batch.column(1)
        for number, lo, hi, g, _ in contexts([t or b"" for t in batch.column(2).to_pylist()]):
            at = pa.array(number)
            yield pa.RecordBatch.from_arrays(
                [pa.array(g), ids.take(at), keys.take(at), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32))],
                ["g", "doc_id", "t", "lo", "hi"])


def _flat(lists: pa.ListArray, *names: str) -> tuple[np.ndarray, list[pa.Array]]:
    """The structs of a column of lists: the number of each one's list, and the named fields."""
    fields = lists.flatten()
    at = np.repeat(np.arange(len(lists)), pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
    return at, [fields.field(n) for n in names]


def _cut_contexts(min_bytes: int):
    """Rows (doc_id, t, text, places) as rows (g, doc_id, t, lo, context)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, (g, lo, hi) = _flat(batch.column(3), "g", "lo", "hi")
            texts = batch.column(2).to_pylist()
            cut = [texts[k][a:b] for k, a, b in zip(at.tolist(), lo.to_pylist(), (hi.to_numpy() + min_bytes).tolist())]
            at = pa.array(at)
            yield pa.RecordBatch.from_arrays(
                [g, batch.column(0).take(at), batch.column(1).take(at), lo, pa.array(cut, pa.binary())],
                ["g", "doc_id", "t", "lo", "context"])
    return run


def _order_buckets(min_bytes: int):
    """Rows (g, doc, lo, context), a gram's rows together, as (g, context, runs)."""
    def finish(rows: list[tuple]) -> pa.RecordBatch:
        # text order of the contexts' first copies: document and place in one number
        documents = {d: k for k, d in enumerate(sorted({r[1] for r in rows}))}
        owner, *fields = repeated_windows([(r[3], (documents[r[1]] << 40) + r[2]) for r in rows], min_bytes)
        runs = pa.StructArray.from_arrays([pa.array(f, t.type) for f, t in zip(fields, RUN_ARROW)], fields=list(RUN_ARROW))
        offsets = pa.array(np.searchsorted(owner, np.arange(len(rows) + 1)).astype(np.int32))
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[3] for r in rows], pa.binary()),
             pa.ListArray.from_arrays(offsets, runs)], ["g", "context", "runs"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size > SORT_BYTES and row[0] != held[-1][0]:
                    yield finish(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield finish(held)
    return run


def _single_windows(min_bytes: int):
    """Rows (g, doc, lo, context) as one row (h, doc, at, g, id, k) a window."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g, doc, lo, context in zip(*(c.to_pylist() for c in batch.columns)):
                count = len(context) - min_bytes + 1
                digest = xxhash.xxh3_128_digest(context)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([xxhash.xxh3_128_digest(context[k:k + min_bytes]) for k in range(count)], pa.binary()),
                     pa.array([doc] * count, pa.int64()), pa.array(range(lo, lo + count), pa.int32()),
                     pa.array([g] * count, pa.int64()), pa.array([digest] * count, pa.binary()), pa.array(range(count), pa.int32())],
                    ["h", "doc", "at", "g", "id", "k"])
    return run


def _matched_singly(different: DataFrame, min_bytes: int) -> DataFrame:
    """(g, context, runs) for the contexts of very frequent grams."""
    windows = different.select("g", "doc", "lo", "context").mapInArrow(
        _single_windows(min_bytes), "h binary, doc bigint, at int, g bigint, id binary, k int")
    windows = stored(windows, "suffix-windows")
    ends = stored(windows.groupBy("h").agg(
        F.count("*").alias("m"), F.min(F.struct("doc", "at")).alias("a"), F.max(F.struct("doc", "at")).alias("b")).where(
        "m > 1"), "suffix-matches")
    here = F.struct("doc", "at")
    by_context = windows.join(ends, "h").groupBy("g", "id").agg(F.array_sort(F.collect_list(F.struct(
        F.col("k").alias("first"), F.col("k").alias("last"), (here > F.col("a")).alias("earlier"),
        (here < F.col("b")).alias("later")))).alias("runs"))
    ids = different.select("g", "context").mapInArrow(_with_digest, "g bigint, context binary, id binary")
    return ids.join(by_context, ["g", "id"]).select("g", "context", "runs")


def _with_digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests = [xxhash.xxh3_128_digest(c) for c in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.binary())], ["g", "context", "id"])


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, t, runs) of the rows of ``docs`` (doc_id, text) with repeated
    windows; runs are of window starts with their flags (they may touch)."""
    rows = _keys(docs)
    light = rows.where(F.octet_length("text") >= MIN_BYTES).select("doc_id", "text").mapInArrow(
        _light, "g bigint, c bigint, doc bigint")
    grams = stored(light.groupBy("g").agg(F.count("*").alias("n"), F.min("c").alias("a"), F.max("c").alias("b"),
                                          F.min("doc").alias("first_doc")).where("n > 1").select(
        "g", "first_doc", (F.col("a") != F.col("b")).alias("mixed")), "suffix-grams")
    places = stored(rows.where(F.octet_length("text") >= MIN_BYTES).select("doc_id", "t", "text").mapInArrow(
        _places, "g bigint, doc_id bigint, t bigint, lo int, hi int").join(grams, "g"), "suffix-places")

    # all contexts of the gram are equal: every window stands elsewhere; it stands
    # earlier unless this is the gram's first place in its first document
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    plain = places.where(~F.col("mixed")).select(
        "doc_id", "t", "g", "lo", "hi", (key == F.col("first_doc")).alias("in_first"))

    wanted = places.where("mixed").groupBy(F.col("doc_id").alias("_d"), F.col("t").alias("_t")).agg(
        F.collect_set(F.struct("g", "lo", "hi")).alias("places"))
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("t") == F.col("_t"))
    found = stored(rows.join(wanted, same).select("doc_id", "t", "text", "places").mapInArrow(
        _cut_contexts(MIN_BYTES), "g bigint, doc_id bigint, t bigint, lo int, context binary"), "suffix-contexts")
    different = stored(found.groupBy("g", "context").agg(
        F.count("*").alias("n"), F.min(F.struct(key.alias("doc"), F.col("lo"))).alias("first")).select(
        "g", "first.doc", "first.lo", "n", "context"), "suffix-different")
    sizes = different.groupBy("g").agg(F.count("*").alias("m"))
    large = stored(sizes.where(F.col("m") > BUCKET).select("g"), "suffix-large")
    matched = different.join(large, "g", "left_anti").select("g", "doc", "lo", "context").repartition(
        "g").sortWithinPartitions("g").mapInArrow(_order_buckets(MIN_BYTES), f"g bigint, context binary, runs {RUN}")
    if not large.isEmpty():
        matched = matched.union(_matched_singly(different.join(large, "g"), MIN_BYTES))
    matched = stored(matched.join(different.select("g", "context", "n", "doc", F.col("lo").alias("_lo")), ["g", "context"]),
                     "suffix-matched")
    # a copy of a context stands earlier if it is not the first copy
    whole = F.octet_length("context") - MIN_BYTES
    is_first = (key == F.col("doc")) & (F.col("lo") == F.col("_lo"))
    runs = F.when(F.col("n") > 1, F.concat("runs", F.array(F.struct(
        F.lit(0).alias("first"), whole.cast("int").alias("last"), (~is_first).alias("earlier"), F.lit(True).alias("later"))))
        .cast(RUN)).otherwise(F.col("runs"))
    mixed = found.join(matched, ["g", "context"]).select("doc_id", "t", F.explode(runs).alias("r"), "lo").select(
        "doc_id", "t", F.lit(None).cast("bigint").alias("g"), (F.col("lo") + F.col("r.first")).alias("first"),
        (F.col("lo") + F.col("r.last")).alias("last"), F.col("r.earlier").alias("earlier"), F.lit(False).alias("in_first"))
    everything = plain.select("doc_id", "t", "g", F.col("lo").alias("first"), F.col("hi").alias("last"),
                              (~F.col("in_first")).alias("earlier"), "in_first").union(mixed)
    return everything.groupBy("doc_id", "t").agg(F.collect_set(F.struct(
        "first", "last", "earlier", "in_first", "g")).alias("runs"))


def merged(runs: list[dict], min_bytes: int, keep_first: bool) -> list[tuple[int, int]]:
    """The byte spans [start, end) that the runs of windows cover."""
    spans: list[tuple[int, int]] = []
    seen: set[int] = set()
    for r in sorted(runs, key=lambda r: (r["first"], r["last"])):
        if keep_first and not r["earlier"]:
            # the gram's first document: later places there repeat its first place
            if not r["in_first"] or r["g"] not in seen:
                seen.add(r["g"])
                continue
        start, end = r["first"], r["last"] + min_bytes
        if spans and start <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
        else:
            spans.append((start, end))
    return spans


def _covered(runs: pa.ListArray, min_bytes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``merged`` of every list of a column, without first copies kept: (list, start,
    end) arrays in order.  A list's number stands above the places of its runs."""
    at, (first, last) = _flat(runs, "first", "last")
    start = (at << 32) + first.to_numpy().astype(np.int64)
    end = (at << 32) + last.to_numpy().astype(np.int64) + min_bytes
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    opens = np.flatnonzero(np.concatenate(([True], start[1:] > end[:-1]))[:len(start)])
    closes = np.concatenate((opens[1:] - 1, [len(start) - 1]))[:len(opens)]
    low = (1 << 32) - 1
    return start[opens] >> 32, start[opens] & low, end[closes] & low


def _kept_firsts(runs: pa.ListArray, min_bytes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``_covered``, with first copies kept."""
    spans = [(k, a, b) for k, r in enumerate(runs.to_pylist()) for a, b in merged(r or [], min_bytes, True)]
    table = np.array(spans, dtype=np.int64).reshape(-1, 3)
    return table[:, 0], table[:, 1], table[:, 2]


def _remove(min_bytes: int, keep_first: bool, at: int):
    find = _kept_firsts if keep_first else _covered

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            owner, start, end = find(batch.column(batch.num_columns - 1), min_bytes)
            offsets = np.searchsorted(owner, np.arange(len(texts) + 1))
            begins, stops = start.tolist(), end.tolist()
            kept = []
            for text, a, b in zip(texts, offsets[:-1].tolist(), offsets[1:].tolist()):
                text = text or b""
                kept.append(text if a == b else b"".join(
                    text[i:j] for i, j in zip([0, *stops[a:b]], [*begins[a:b], len(text)])))
            spans = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.StructArray.from_arrays(
                [pa.array(start, pa.int64()), pa.array(end, pa.int64())], names=["start", "end"]))
            columns = [c for i, c in enumerate(batch.columns[:-1]) if i != at]
            names = [n for i, n in enumerate(batch.schema.names[:-1]) if i != at]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(kept, pa.binary()), spans],
                                             [*names, "kept", "spans"])
    return run


def remove_repeats(docs: DataFrame, keep_first: bool = True) -> DataFrame:
    """(doc_id, n_bytes, kept, spans) of every row of ``docs`` (doc_id, text): the
    bytes left (which may end within a character) and the spans removed.

    With ``keep_first`` the earliest copy of a string stays, else none does."""
    docs = docs.select("doc_id", "text")
    runs = stored(repeated_spans(docs), "suffix-runs").toDF("_d", "_t", "runs")
    same = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("t") == F.col("_t"))
    joined = _keys(docs).join(runs, same, "left").select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint").alias("n_bytes"), "text", "runs")
    return joined.mapInArrow(_remove(MIN_BYTES, keep_first, 2), T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()),
        T.StructField("kept", T.BinaryType()),
        T.StructField("spans", T.DataType.fromDDL("array<struct<start:bigint,end:bigint>>"))]))
