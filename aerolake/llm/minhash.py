"""MinHash near-duplicates by a signature-coordinate inverted join (operator 9).

1. Every text becomes its set of distinct 5-word shingles (64-bit hashes), its
   size, a 128-bit key of the whole set and a MinHash signature of ``COORDINATES``
   values.  Equal sets collapse into one *node* (map-side combined), so copies
   cost nothing further.
2. Nodes are posted under each (coordinate, value) of a prefix of ``PREFIX``
   coordinates.  Linked sets agree on a coordinate with probability >= 0.75, so
   they miss each other in all prefix lists with probability <= 0.25^16.
3. First merge: within each list every node is paired with the list's least node
   only.  Pairs whose sizes allow the similarity and whose signatures collide in
   at least ``MIN_MATCHES`` of all coordinates are confirmed on the full sets;
   confirmed links are contracted to components.
4. Second merge, which skips every list that lies in one component: the other
   lists are cut by set size (linked sets fall in the same class or the next) and
   merged across components, in blocks of about ``BLOCK`` nodes a side, a pair
   being counted in its first common list only.  The largest component of a long
   list has blocks of its own, which don't meet each other, so a large group costs
   rows in proportion to the nodes outside it.  The texts of the nodes
   that take part in a possible pair join their blocks, and a node is confirmed
   against the best-matching nodes first, skipping the pairs whose components the
   block has joined already.  Only confirmed links leave a task.

So pairs are never written out: large groups of near copies cost a few rows a
document, while no component loses a link.  A group of any size is spread:
minima are combined before the shuffle, long lists are cut in blocks, joins on
hot nodes can be split.  Every phase is a table in shared storage.

Parameters: with 64 coordinates a linked pair (J >= 0.75) has fewer than 28
collisions with probability below 1e-7.

Defined results: null or empty texts (or without words) have an empty set, are
their own component and linked with nothing.  Rows without doc_id take no part
in components (component_id null) and are kept.  Rows are told apart by their
set, so a doc_id that occurs twice gets a result for each row.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import released, stored, worker_state
from aerolake.llm.components import connected_components

SHINGLE = 5
PERCENT = 75                # a link: 100 * intersection >= PERCENT * union
COORDINATES = 64
PREFIX = 16
MIN_MATCHES = 28
BLOCK = 1024
SIZE_STEP = 1.3334          # just above 100 / PERCENT: linked sizes are at most one class apart
CACHED_WORDS = 150_000

_M = (1 << 64) - 1
_rng = np.random.RandomState(20240229)
MULTIPLIERS = (_rng.randint(0, 1 << 62, COORDINATES).astype(np.uint64) << np.uint64(1)) | np.uint64(1)
ADDENDS = _rng.randint(0, 1 << 62, COORDINATES).astype(np.uint64)
BASE = np.uint64(0xD6E8FEB86659FD93)


class _WordHash(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(self) < CACHED_WORDS:
            self[word] = h
        return h



def _mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64 bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes of a text.

    Only A-Z are lowered, words are separated by blanks and 0x09-0x0D: that is
    what ``bytes.lower`` and ``bytes.split`` do.  Fewer than 5 words make one
    shingle (hashed with their number).
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    h = np.array(list(map(worker_state("minhash", _WordHash).__getitem__, words)), dtype=np.uint64)
    width = min(SHINGLE, len(h))
    n = len(h) - width + 1
    out = np.full(n, width, dtype=np.uint64)
    for k in range(width):
        out = out * BASE + h[k:k + n]
    return np.unique(_mix(out))


def signature(shingles: np.ndarray) -> np.ndarray:
    """``COORDINATES`` minima of as many permutations, 32 bits each."""
    low = None
    for i in range(0, len(shingles), 4096):
        part = (shingles[None, i:i + 4096] * MULTIPLIERS[:, None] + ADDENDS[:, None]).min(axis=1)
        low = part if low is None else np.minimum(low, part)
    return (low >> np.uint64(32)).astype(np.uint32)


def _signatures(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    coordinate = np.arange(PREFIX, dtype=np.int64)
    for batch in batches:
        sizes, keys, signs, prefixes = [], [], [], []
        for text in batch.column(1).to_pylist():
            shingles = shingle_set(text)
            sizes.append(len(shingles))
            if not len(shingles):
                keys.append(None), signs.append(None), prefixes.append(None)
                continue
            s = signature(shingles)
            keys.append(xxhash.xxh3_128_digest(shingles.tobytes()))
            signs.append(s.tobytes())
            prefixes.append(s[:PREFIX].astype(np.int64) * PREFIX + coordinate)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()),
             pa.array(signs, pa.binary()), pa.array(prefixes, pa.list_(pa.int64()))],
            ["doc_id", "n_shingles", "node", "sig", "prefix"])


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, node, sig, prefix) of ``docs`` (doc_id, text)."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        released(_signatures), "doc_id bigint, n_shingles bigint, node binary, sig binary, prefix array<bigint>")


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets are linked."""
    if 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
        return False
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= PERCENT * (len(a) + len(b) - common)


def _sizes_allow(a: str, b: str) -> F.Column:
    return (F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT)


def _enough_matches(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (u, v, sig_u, sig_v) with enough equal coordinates, as (u, v)."""
    for batch in batches:
        a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint32).reshape(-1, COORDINATES)
                for i in (2, 3))
        keep = pa.array((a == b).sum(axis=1) >= MIN_MATCHES)
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["u", "v"])


def _confirmed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (u, v, text_u, text_v) that are linked on their full sets, as (u, v)."""
    @functools.lru_cache(maxsize=64)
    def shingles(text: str) -> np.ndarray:
        return shingle_set(text)

    for batch in batches:
        keep = pa.array([similar(shingles(a), shingles(b)) for a, b in
                         zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())], pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["u", "v"])


def _texts(wanted: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, text): a document's text for each node of ``wanted``."""
    ids = wanted.distinct().join(nodes.select("node", "doc_id"), "node").select("node", F.col("doc_id").alias("_id"))
    # several rows of one doc_id are told apart by their set
    found = docs.select(F.col("doc_id").cast("bigint").alias("_id"), "text").where("text is not null").join(
        ids, "_id").select("node", "text").mapInArrow(released(_of_node), "node binary, text string")
    return stored(found.dropDuplicates(["node"]), "minhash-texts")


def _confirm(pairs: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (u, v) that are linked on the full sets of their documents."""
    texts = _texts(pairs.select(F.explode(F.array("u", "v")).alias("node")), nodes, docs)
    of = lambda side: texts.select(F.col("node").alias(side), F.col("text").alias(f"text_{side}"))
    full = pairs.join(of("u"), "u").join(of("v"), "v").select("u", "v", "text_u", "text_v")
    return full.mapInArrow(released(_confirmed), "u binary, v binary")


def _of_node(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, text) whose text has that node's set."""
    for batch in batches:
        keep = pa.array([xxhash.xxh3_128_digest(shingle_set(t).tobytes()) == n for n, t in
                         zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())], pa.bool_())
        yield batch.filter(keep)


def _possible(rows: list[tuple]) -> Iterator[tuple[int, list[int]]]:
    """Of one group of rows (``BLOCK_ROW``): the pairs across components that sizes
    and signatures allow, as (row, other rows, best match first).  Side 0 rows meet
    side 1 rows, or all rows if i = j; one of a pair is of the group's own size
    class (``low``), so that a pair meets in one group."""
    key, same = rows[0][0], rows[0][2] == rows[0][3]
    left = [k for k, r in enumerate(rows) if same or r[4] == 0]
    right = np.array([k for k, r in enumerate(rows) if same or r[4] == 1], dtype=np.int64)
    if not left or not len(right):
        return
    sig = np.frombuffer(b"".join(r[9] for r in rows), dtype=np.uint32).reshape(-1, COORDINATES)
    size = np.array([r[8] for r in rows])
    low = np.array([r[5] for r in rows], dtype=bool)
    codes: dict[bytes, int] = {}
    comp = np.array([codes.setdefault(r[7], len(codes)) for r in rows])
    sig_right, size_right, comp_right, low_right = sig[right], size[right], comp[right], low[right]
    here = key % PREFIX
    for n, k in enumerate(left):
        start = n + 1 if same else 0
        s = size_right[start:]
        ok = np.flatnonzero((comp_right[start:] != comp[k]) & (low_right[start:] | low[k]) & (
            100 * np.minimum(s, size[k]) >= PERCENT * np.maximum(s, size[k]))) + start
        if not len(ok):
            continue
        equal = sig_right[ok] == sig[k]
        matches = equal.sum(axis=1)
        # counted in the first list of the prefix that both share
        good = np.flatnonzero((matches >= MIN_MATCHES) & ~equal[:, :here].any(axis=1))
        if len(good):
            yield k, right[ok[good[np.argsort(-matches[good], kind="stable")]]].tolist()


def _grouped(batches: Iterable[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The (key, s, i, j) groups of two rows and more."""
    held: list[tuple] = []
    at = None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:4] != at:
                if len(held) > 1:
                    yield held
                at, held = row[:4], []
            held.append(row)
    if len(held) > 1:
        yield held


# a list's key, size class, blocks, which block the row is of, whether its own class
# is the group's, and the node
BLOCK_ROW = ("key bigint, s int, i int, j int, side int, low int, node binary, comp binary, n bigint, sig binary")
BLOCK_ARROW = pa.schema([("key", pa.int64()), ("s", pa.int32()), ("i", pa.int32()), ("j", pa.int32()),
                         ("side", pa.int32()), ("low", pa.int32()), ("node", pa.binary()), ("comp", pa.binary()),
                         ("n", pa.int64()), ("sig", pa.binary())])


def _taking_part(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each group that are in a possible pair."""
    for rows in _grouped(batches):
        part: set[int] = set()
        for k, others in _possible(rows):
            part.add(k)
            part.update(others)
        if part:
            columns = zip(*(rows[k] for k in sorted(part)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, BLOCK_ARROW.types)],
                                             schema=BLOCK_ARROW)


def _links_across(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (u, v) that join the components of each group of rows with text."""
    for rows in _grouped(batches):
        sets: dict[int, np.ndarray] = {}
        root: dict[bytes, bytes] = {}

        def find(c: bytes) -> bytes:
            while (up := root.get(c, c)) != c:
                root[c] = c = root.get(up, up)
            return c

        def shingles(k: int) -> np.ndarray:
            if k not in sets:
                sets[k] = shingle_set(rows[k][10])
            return sets[k]

        found = []
        for k, others in _possible(rows):
            for o in others:
                a, b = find(rows[k][7]), find(rows[o][7])
                if a != b and similar(shingles(k), shingles(o)):
                    root[a] = b
                    found.append((rows[k][6], rows[o][6]))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([u for u, _ in found], pa.binary()),
                                              pa.array([v for _, v in found], pa.binary())], ["u", "v"])


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``
    (doc_id, text).  component_id is the least doc_id reachable over links, kept
    tells whether the row has that id."""
    docs = docs.select("doc_id", "text")
    rows = stored(signatures(docs), "minhash-signatures")
    nodes = stored(
        rows.where("node is not null and doc_id is not null").groupBy("node").agg(
            F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"),
            F.first("sig").alias("sig"), F.first("prefix").alias("prefix")), "minhash-nodes")
    posts = nodes.select("node", "n", F.explode("prefix").alias("key"))

    # lists of two nodes and more, each with its least node
    lists = stored(posts.groupBy("key").agg(F.min("node").alias("u"), F.max("node").alias("_max")).where(
        "u < _max").drop("_max"), "minhash-lists")
    small = nodes.select("node", "n", "sig")
    star = posts.select(F.col("node").alias("v"), "key").join(lists.select("key", "u"), "key").where(
        "u < v").select("u", "v").distinct()
    of = lambda side: small.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"),
                                   F.col("sig").alias(f"sig_{side}"))
    pairs = stored(star.join(of("u"), "u").join(of("v"), "v").where(_sizes_allow("n_u", "n_v")).select(
        "u", "v", "sig_u", "sig_v").mapInArrow(released(_enough_matches), "u binary, v binary"), "minhash-pairs")
    links = stored(_confirm(pairs, nodes, docs), "minhash-links")
    roots = stored(connected_components(links), "minhash-roots")

    # second merge: lists that hold several components
    posted = stored(posts.join(lists.select("key"), "key").join(roots, "node", "left").select(
        "key", "node", "n", F.coalesce("root", "node").alias("comp")), "minhash-posted")
    several = (F.min("comp").alias("a"), F.max("comp").alias("b"))
    mixed = stored(posted.groupBy("key").agg(*several).where("a < b").select("key"), "minhash-mixed")
    own = F.floor(F.ln("n") / math.log(SIZE_STEP)).cast("int")
    classed = stored(posted.join(mixed, "key").withColumn("_own", own).withColumn(
        "s", F.explode(F.array("_own", F.col("_own") - 1))).select(
        "key", "s", (F.col("s") == F.col("_own")).cast("int").alias("low"), "node", "comp", "n"), "minhash-classed")
    # a group needs two components and a node of its own class
    by_comp = classed.groupBy("key", "s", "comp").agg(F.count("*").alias("c"), F.max("low").alias("low"))
    long = F.col("n_posts") > BLOCK
    blocks = lambda n: F.ceil(n / BLOCK).cast("int")       # noqa: E731
    worth = stored(by_comp.groupBy("key", "s").agg(
        F.count("*").alias("n_comps"), F.max("low").alias("low"), F.sum("c").alias("n_posts"),
        F.max(F.struct("c", "comp")).alias("top")).where("n_comps > 1 and low = 1").select(
        "key", "s", F.when(long, F.col("top.comp")).alias("_top"),
        F.when(long, blocks(F.col("n_posts") - F.col("top.c"))).otherwise(1).alias("_rest"),
        F.when(long, blocks(F.col("top.c"))).otherwise(0).alias("_tops")), "minhash-groups")
    # blocks 0.. hold the rest, which meets everything; then come those of the largest
    # component, which meet the rest
    in_top = F.coalesce(F.col("comp") == F.col("_top"), F.lit(False))
    place = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")     # noqa: E731
    spread = classed.join(worth, ["key", "s"]).withColumn(
        "_g", F.when(in_top, F.col("_rest") + place("_tops")).otherwise(place("_rest"))).withColumn(
        "_o", F.explode(F.sequence(F.lit(0), F.when(in_top, F.col("_rest")).otherwise(F.col("_rest") + F.col("_tops")) - 1))).select(
        "key", "s", F.least("_g", "_o").alias("i"), F.greatest("_g", "_o").alias("j"),
        (F.col("_g") > F.col("_o")).cast("int").alias("side"), "low", "node", "comp", "n")
    group = ["key", "s", "i", "j"]
    together = lambda df: df.repartition(*group).sortWithinPartitions(*group)
    taking_part = stored(together(spread.join(nodes.select("node", "sig"), "node").select(
        *group, "side", "low", "node", "comp", "n", "sig")).mapInArrow(released(_taking_part), BLOCK_ROW), "minhash-blocks")
    if not taking_part.isEmpty():
        texts = _texts(taking_part.select("node"), nodes, docs)
        more = together(taking_part.join(texts, "node").select(*taking_part.columns, "text")).mapInArrow(
            released(_links_across), "u binary, v binary")
        links = links.union(stored(more, "minhash-links"))
        roots = stored(connected_components(links), "minhash-roots")

    member = nodes.select("node", F.col("doc_id").alias("_first")).join(roots, "node", "left").select(
        "node", F.coalesce("root", "node").alias("root"), "_first")
    least = member.groupBy("root").agg(F.min("_first").alias("component_id"))
    found = stored(member.join(least, "root").select("node", "component_id"), "minhash-components")
    out = rows.select("doc_id", "n_shingles", "node").join(found, "node", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("_c"))
    component = F.when(F.col("doc_id").isNotNull(), F.col("_c"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == F.col("_c"), F.lit(True)).alias("kept"))


def deduplicate(df: DataFrame) -> DataFrame:
    """The rows of ``df`` (with doc_id and text) but one document of each group.

    Rows without doc_id stay.  A doc_id that occurs on several rows stays if one
    of its rows does."""
    gone = near_duplicates(df).groupBy("doc_id").agg(F.max(F.col("kept").cast("int")).alias("k")).where(
        "k = 0").select(F.col("doc_id").alias("_gone"))
    gone = stored(gone, "minhash-gone")
    return df.join(gone, F.col("doc_id").cast("bigint") == F.col("_gone"), "left_anti")
