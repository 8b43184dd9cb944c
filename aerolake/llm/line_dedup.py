"""Line dedup by a segment-partition edit join (operator 7).

Lines (``\\n``-separated, with a word) are duplicates when they are equal, and lines
of at least ``MIN_CHARS`` code points are linked when their edit distance is at most
``THRESHOLD`` (in shorter ones two edits make another word).  A line is cut into THRESHOLD + 1
even segments; a line within the threshold must hold one of them unchanged, at
about the same place.  So every line is posted under its segments (index), and
under those of its substrings that could be a segment of a line of its own
length or up to THRESHOLD shorter, at the few starts that the lengths leave open
(probe).  Keys are hashes of (length, segment number, substring).

1. Light postings (key, line id) are combined map-side into per-key minima and
   maxima; keys that two different lines share survive.  Text is not moved.
2. Only the lines under surviving keys are fetched.  Each key is merged where it
   lies, in blocks of ``BLOCK`` lines a side.  Pairs whose counts of characters
   differ by more than the threshold allows are passed over (an array step for a
   line against a block); those confirmed by the banded bit-parallel edit distance
   leave the task.
3. Of equal lines the first (least doc_id, then line number) stays; it goes too
   if a linked line stands earlier.  Lines without a word always stay.

Copies of a line are one line id throughout, a hot key is cut in blocks, and the
joins are on line ids or documents, which adaptive execution can split.

Defined results: null or empty texts have no lines; a row without doc_id keeps
its text and takes no part; rows with the same doc_id are told apart by the
content of their lines, and rows repeated in full keep the same lines.
"""

from __future__ import annotations

import functools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.llm.common import released, stored

THRESHOLD = 2
MIN_CHARS = 20
BLOCK = 2000
CHARACTER_CLASSES = 32      # of the counts that are compared before the distance
BLANKS = " \t\n\v\f\r"
SEEN_LINES = 100_000        # line ids that a task remembers to post a line once

INDEX, PROBE = 1, 2

BASE = 0xA0761D6478BD642F | 1
INVERSE = pow(BASE, -1, 1 << 64)
KEY_LENGTH, KEY_SEGMENT = np.uint64(0x9E3779B97F4A7C15), 0xC2B2AE3D27D4EB4F


def line_digest(line: str) -> bytes:
    return xxhash.xxh3_128_digest(line.encode("utf-8", "surrogatepass"))


def line_id(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def segments(length: int, threshold: int) -> list[tuple[int, int]]:
    """(start, length) of the THRESHOLD + 1 even segments of a line."""
    parts = threshold + 1
    short, extra = divmod(length, parts)
    out, at = [], 0
    for i in range(parts):
        n = short + (i >= parts - extra)
        out.append((at, n))
        at += n
    return out


@functools.lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for b in (BASE, INVERSE):
        p = np.full(size, b, dtype=np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def postings(lines: list[str], threshold: int) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """(line numbers, keys, role) arrays of ``lines``; each has at least
    threshold + 1 code points."""
    lengths = np.array([len(x) for x in lines], dtype=np.int64)
    text = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    size = 1 << int(lengths.max()).bit_length()
    power, inverse = _powers(size)
    place = np.arange(len(text)) - np.repeat(starts, lengths)
    # prefix sums of a polynomial hash mod 2^64; a substring's hash is a difference
    total = np.concatenate((np.zeros(1, np.uint64),
                            np.cumsum((text.astype(np.uint64) + np.uint64(1)) * power[place], dtype=np.uint64)))

    def keys(which: np.ndarray, at: np.ndarray, n: np.ndarray, length: np.ndarray, segment: int) -> np.ndarray:
        first = starts[which] + at
        h = (total[first + n] - total[first]) * inverse[at]
        h = h ^ (length.astype(np.uint64) * KEY_LENGTH + np.uint64((segment + 1) * KEY_SEGMENT % (1 << 64)))
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        return (h ^ (h >> np.uint64(31))).view(np.int64)

    out = []
    parts = threshold + 1
    everyone = np.arange(len(lines))
    for delta in range(threshold + 1):
        length = lengths - delta                    # of the lines looked for
        short, extra = length // parts, length % parts
        for i in range(parts):
            start = short * i + np.maximum(0, i - (parts - extra))
            n = short + (i >= parts - extra)
            low = max(-i, delta - (threshold - i))
            high = min(i, delta + (threshold - i))
            for shift in range(low, high + 1):
                at = start + shift
                ok = everyone[(short > 0) & (at >= 0) & (at + n <= lengths)]
                role = INDEX if delta == 0 and shift == 0 else PROBE
                out.append((ok, keys(ok, at[ok], n[ok], length[ok], i), role))
    return out


def edit_distance_within(a: str, b: str, threshold: int) -> bool:
    """Whether the edit distance is at most ``threshold``.

    Bit d of the e-th vector says that a[:j + d - threshold] becomes b[:j] with
    at most e edits: one machine-sized band of 2 * threshold + 1 diagonals that
    moves along b.
    """
    if abs(len(a) - len(b)) > threshold:
        return False
    n, most = 0, min(len(a), len(b))
    while n < most and a[n] == b[n]:
        n += 1
    a, b = a[n:], b[n:]
    n, most = 0, min(len(a), len(b))
    while n < most and a[-1 - n] == b[-1 - n]:
        n += 1
    a, b = a[:len(a) - n], b[:len(b) - n]
    if not a or not b:
        return len(a) + len(b) <= threshold
    band = (1 << (2 * threshold + 1)) - 1
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << (i + threshold)
    rows = [((1 << (e + 1)) - 1) << threshold for e in range(threshold + 1)]
    for j, c in enumerate(b):
        match = where.get(c, 0) >> j & band
        before, rows[0] = rows[0], rows[0] & match
        alive = rows[0]
        for e in range(1, threshold + 1):
            # match; substitution and insertion from one edit less; deletion
            new = (rows[e] & match | before | before >> 1 | rows[e - 1] << 1) & band
            before, rows[e] = rows[e], new
            alive |= new
        if not alive:
            return False
    return bool(rows[threshold] >> (len(a) - len(b) + threshold) & 1)


def _with_words(text: str | None) -> list[tuple[int, str]]:
    return [(k, x) for k, x in enumerate(text.split("\n")) if x.strip(BLANKS)] if text else []


def _eligible(text: str | None, min_chars: int) -> list[tuple[int, str]]:
    return [(k, x) for k, x in _with_words(text) if len(x) >= min_chars]


def _occurrences(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs, numbers, digests = [], [], []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for k, line in _with_words(text):
                docs.append(doc_id), numbers.append(k), digests.append(line_digest(line))
        yield pa.RecordBatch.from_arrays(
            [pa.array(docs, pa.int64()), pa.array(numbers, pa.int32()), pa.array(digests, pa.binary()),
             pa.array([line_id(d) for d in digests], pa.int64())], ["doc_id", "line_no", "line", "id"])


def _post(min_chars: int, threshold: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            lines, ids = [], []
            for text in batch.column(0).to_pylist():
                for _, line in _eligible(text, min_chars):
                    h = line_id(line_digest(line))
                    if h not in seen:
                        seen.add(h)
                        lines.append(line), ids.append(h)
            if len(seen) > SEEN_LINES:
                seen.clear()
            if not lines:
                continue
            own = np.array(ids, dtype=np.int64)
            for which, key, role in postings(lines, threshold):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(own[which]), pa.array(np.full(len(key), role, dtype=np.int8))],
                    ["key", "id", "role"])
    return run


def _fetch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (text, line numbers) as rows (line, id, line_text)."""
    for batch in batches:
        digests, texts = [], []
        for text, numbers in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            lines = text.split("\n")
            for k in numbers:
                if k < len(lines):
                    digests.append(line_digest(lines[k])), texts.append(lines[k])
        yield pa.RecordBatch.from_arrays(
            [pa.array(digests, pa.binary()), pa.array([line_id(d) for d in digests], pa.int64()),
             pa.array(texts, pa.string())], ["line", "id", "line_text"])


def character_counts(texts: list[str]) -> np.ndarray:
    """How often each class of characters occurs in each text.  An edit changes the
    sum of the absolute differences between two texts' counts by 2 at most."""
    lengths = [len(x) for x in texts]
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    classes = (points * np.uint32(2654435761)) >> np.uint32(27)
    cells = np.repeat(np.arange(len(texts)) * CHARACTER_CLASSES, lengths) + classes
    return np.bincount(cells, minlength=len(texts) * CHARACTER_CLASSES).reshape(-1, CHARACTER_CLASSES).astype(np.int32)


def _merge(threshold: int):
    """Links (u, v) within each (key, i, j) group of rows sorted by group."""
    def links(rows: list[tuple]) -> Iterator[tuple[bytes, bytes]]:
        same = rows[0][1] == rows[0][2]
        left = [k for k, r in enumerate(rows) if same or r[3] == 0]
        right = np.array([k for k, r in enumerate(rows) if same or r[3] == 1], dtype=np.int64)
        if not left or not len(right):
            return
        codes: dict[bytes, int] = {}
        which = np.array([codes.setdefault(r[5], len(codes)) for r in rows])
        index = np.array([r[4] == INDEX for r in rows])
        counts = character_counts([r[6] for r in rows])
        of_right, counts_right, index_right = which[right], counts[right], index[right]
        for n, k in enumerate(left):
            at = n + 1 if same else 0
            near = np.abs(counts_right[at:] - counts[k]).sum(axis=1) <= 2 * threshold
            near &= (index_right[at:] | index[k]) & (of_right[at:] != which[k])
            line, text = rows[k][5:]
            for o in right[at:][near].tolist():
                other, other_text = rows[o][5:]
                if edit_distance_within(text, other_text, threshold):
                    yield (line, other) if line < other else (other, line)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        at = None

        def flush() -> pa.RecordBatch:
            found = sorted(set(links(held)))
            return pa.RecordBatch.from_arrays([pa.array([u for u, _ in found], pa.binary()),
                                               pa.array([v for _, v in found], pa.binary())], ["u", "v"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:3] != at:
                    if len(held) > 1:
                        yield flush()
                    at, held = row[:3], []
                held.append(row)
        if len(held) > 1:
            yield flush()
    return run


def line_occurrences(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, line, id) of every line with a word; ``line`` is its 128-bit
    digest, ``id`` the first half of that."""
    return docs.where("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        released(_occurrences), "doc_id bigint, line_no int, line binary, id bigint")


def line_links(docs: DataFrame, lines: DataFrame, min_chars: int = MIN_CHARS,
               threshold: int = THRESHOLD) -> DataFrame:
    """(u, v), u < v: the digests of all different lines within the threshold;
    ``lines`` has one row (line, id, first place) for each line of ``docs``."""
    posts = docs.where("doc_id is not null").select("text").mapInArrow(
        released(_post(min_chars, threshold)), "key bigint, id bigint, role tinyint")
    # as few columns as possible: these are the widest shuffles.  The join is the
    # same at every size, a broadcast of keys would grow with the corpus
    shared = posts.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b").select("key")
    kept = stored(posts.join(stored(shared, "line-keys").hint("merge"), "key").distinct(), "line-posts")

    wanted = lines.join(kept.select("id").distinct(), "id").groupBy(F.col("first.doc_id").alias("_id")).agg(
        F.collect_set("first.line_no").alias("_numbers"))
    texts = stored(docs.select(F.col("doc_id").cast("bigint").alias("_id"), "text").where("text is not null").join(
        wanted, "_id").select("text", "_numbers").mapInArrow(
            released(_fetch), "line binary, id bigint, line_text string").dropDuplicates(["line"]), "line-texts")

    sizes = kept.groupBy("key").agg(F.count("*").alias("n_posts"))
    n = F.ceil(F.col("n_posts") / BLOCK).cast("int")
    spread = kept.join(sizes, "key").withColumn("_n", n).withColumn("_g", F.pmod(F.xxhash64("id"), F.col("_n")).cast("int")).withColumn(
        "_o", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).select(
        "key", F.least("_g", "_o").alias("i"), F.greatest("_g", "_o").alias("j"),
        (F.col("_g") > F.col("_o")).cast("int").alias("side"), "role", "id")
    group = ["key", "i", "j"]
    return spread.join(texts, "id").select(*group, "side", "role", "line", "line_text").repartition(
        *group).sortWithinPartitions(*group).mapInArrow(released(_merge(threshold)), "u binary, v binary").distinct()


def line_decisions(docs: DataFrame, min_chars: int = MIN_CHARS, threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, line_no, line, n_copies, n_links, kept) of every line with a word of
    ``docs`` (doc_id, text); n_links counts the different lines it is linked with."""
    docs = docs.select("doc_id", "text")
    occurrences = stored(line_occurrences(docs), "line-occurrences")
    first = stored(occurrences.groupBy("line", "id").agg(F.min(F.struct("doc_id", "line_no")).alias("first"),
                                                         F.count("*").alias("n_copies")), "line-first")
    links = stored(line_links(docs, first, min_chars, threshold), "line-links")
    both = links.union(links.select("v", "u")).toDF("line", "other")
    linked = both.join(first.select(F.col("line").alias("other"), F.col("first").alias("at")), "other").groupBy(
        "line").agg(F.count("*").alias("n_links"), F.min("at").alias("earliest"))
    decided = stored(first.join(linked, "line", "left").select(
        "line", "first", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce(F.col("first") < F.col("earliest"), F.lit(True)).alias("first_stays")), "line-decisions")
    return occurrences.join(decided, "line").select(
        "doc_id", "line_no", "line", "n_copies", "n_links",
        (F.col("first_stays") & (F.struct("doc_id", "line_no") == F.col("first"))).alias("kept"))


def _drop_lines(at: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, gone in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                if gone:
                    digests = {g["line_no"]: set() for g in gone}
                    for g in gone:
                        digests[g["line_no"]].add(g["line"])
                    text = "\n".join(x for k, x in enumerate(text.split("\n"))
                                     if k not in digests or line_digest(x) not in digests[k])
                out.append(text)
            columns = list(batch.columns[:-1])
            columns[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1])
    return run


def remove_lines(df: DataFrame, decisions: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with the lines that ``decisions`` doesn't keep cut from its text."""
    gone = decisions.where("not kept").groupBy(F.col("doc_id").alias("_line_doc")).agg(
        F.collect_set(F.struct("line_no", "line")).alias("_line_gone"))
    joined = df.join(gone, F.col("doc_id").cast("bigint") == F.col("_line_doc"), "left").select(
        *[df[c] for c in df.columns], "_line_gone")
    return joined.mapInArrow(_drop_lines(df.columns.index(text_col)), T.StructType(df.schema.fields))


def deduplicate_lines(df: DataFrame, **options) -> DataFrame:
    """``df`` with repeated and nearly repeated lines cut from ``text``."""
    return remove_lines(df, line_decisions(df, **options))
