"""Benchmark decontamination by greedy string tiling (operator 1).

Texts are sequences of lower-cased alphanumeric tokens.  A document and a
benchmark item are compared where they share a seed, ``min_match`` consecutive
tokens.  Then the longest matches of unmarked tokens are found with Karp-Rabin
hashes of the current search length and marked as tiles, longest first and
never overlapping, while the search length falls to ``min_match``.  The share of
the item's tokens under tiles is its coverage; since tiles may come in any
order, reordered passages count in full.  A document leaks an item when the
coverage reaches the threshold.

Both sides post their seeds as tables, under 64-bit hashes that decide
candidates only.  A bitmap of the benchmark's seeds, built by Spark and never
larger than ``FILTER_BITS``, goes to the tasks, so a document posts few seeds that
no item has; equal texts post once.  Each item is then searched by its rare seeds
alone: ordered by the number of texts that hold them, as many of the most frequent
seeds are left out as can't cover ``min_coverage`` of the item by themselves.  A
leaking text holds one of the others, so the join loses no pair, and a phrase that
stands everywhere joins nothing.  The texts of candidates are tiled against their
items, ``GROUP_ITEMS`` at a time.  Neither table passes through the driver.

Defined results: null and empty texts have no tokens; an item with fewer than
``min_match`` tokens can't be tiled and never matches; equal items are reported
each under their id, as are repeated rows of the benchmark; repeated documents leak
alike.  Neither parameter of size decides a result.
"""

from __future__ import annotations

import dataclasses
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolake.llm.common import released, stored

MIN_MATCH = 4
MIN_COVERAGE = 0.5
FILTER_BITS = 1 << 27           # most bits of the bitmap of benchmark seeds (16 MB)
BITS_A_SEED = 64                # bits a seed while the bitmap is smaller than that
BITMAP_BITS = 1 << 15           # positions of one bitmap aggregate of Spark, a fixed value
GROUP_ITEMS = 64                # items that one row sets beside a text
KNOWN_TOKENS = 1 << 19          # hashes of tokens that a task keeps
FIRST_SEARCH_LENGTH = 16
BASE = np.uint64(0x9E3779B97F4A7C15)
LEAKS = "array<struct<item_id:bigint,n_item_tokens:int,n_matched:int,coverage:double,tiles:array<struct<item_start:int,doc_start:int,length:int>>>>"

TOKEN = re.compile(r"[^\W_]+")


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall(text.lower()) if text else []


def rolling(ids: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hash (mod 2^64) of every window of ``length`` ids."""
    n = len(ids) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    h = np.zeros(n, dtype=np.uint64)
    for k in range(length):
        h = h * BASE + ids[k:k + n].astype(np.uint64)
    return h


def tile(item: np.ndarray, doc: np.ndarray, min_match: int,
         usable: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two id sequences: (item start, doc start, length).

    ``usable`` marks the doc positions that may be matched (all if None).  Of
    matches of one length the one that stands first in the item, then in the
    document, is marked first.
    """
    free_item = np.ones(len(item), dtype=bool)
    free_doc = np.ones(len(doc), dtype=bool) if usable is None else usable.copy()
    tiles = []
    search = max(min_match, FIRST_SEARCH_LENGTH)
    while True:
        matches = _scan(item, doc, free_item, free_doc, search)
        longest = max((m[2] for m in matches), default=0)
        if longest > 2 * search:        # long passages: start over from their length
            search = longest
            continue
        by_length = defaultdict(list)
        for i, j, n in matches:
            by_length[n].append((i, j))
        while by_length:
            n = max(by_length)
            for i, j in sorted(set(by_length.pop(n))):
                open_ = free_item[i:i + n] & free_doc[j:j + n]
                if open_.all():
                    free_item[i:i + n] = False
                    free_doc[j:j + n] = False
                    tiles.append((i, j, n))
                    continue
                # partly marked meanwhile: what is left of it competes by its own length
                edges = np.flatnonzero(np.diff(np.concatenate(([0], open_.astype(np.int8), [0]))))
                for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
                    if b - a >= search:
                        by_length[b - a].append((i + a, j + a))
        if search <= min_match:
            return sorted(tiles)
        search = max(min_match, search // 2)


def _windows(ids: np.ndarray, free: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the windows that hold free positions only."""
    h = rolling(ids, length)
    if not len(h):
        return np.zeros(0, dtype=np.int64), h
    taken = np.concatenate(([0], np.cumsum(~free)))
    starts = np.flatnonzero(taken[length:] == taken[:-length])
    return starts, h[starts]


def _scan(item, doc, free_item, free_doc, length) -> list[tuple[int, int, int]]:
    """Maximal matches of at least ``length`` free tokens."""
    at_i, h_i = _windows(item, free_item, length)
    at_j, h_j = _windows(doc, free_doc, length)
    hits = defaultdict(list)
    wanted = np.isin(h_j, h_i)
    for j, h in zip(at_j[wanted].tolist(), h_j[wanted].tolist()):
        hits[h].append(j)
    found = []
    for i, h in zip(at_i.tolist(), h_i.tolist()):
        for j in hits.get(h, ()):
            if i and j and item[i - 1] == doc[j - 1] and free_item[i - 1] and free_doc[j - 1]:
                continue                # reported from its first position
            if not np.array_equal(item[i:i + length], doc[j:j + length]):
                continue
            n, most = length, min(len(item) - i, len(doc) - j)
            while n < most and item[i + n] == doc[j + n] and free_item[i + n] and free_doc[j + n]:
                n += 1
            found.append((i, j, n))
    return found


def _covered(starts: list[int], length: int) -> set[int]:
    return {p for s in starts for p in range(s, s + length)}


class _Vocabulary(dict):
    def __missing__(self, token: str) -> int:
        return 0


@dataclasses.dataclass
class ItemIndex:
    """Seeds of a block of benchmark items; token ids are local to the block, 0 is any other token."""

    vocabulary: _Vocabulary
    items: list[tuple[int, np.ndarray]]
    seeds: np.ndarray           # sorted distinct seed hashes
    first: np.ndarray           # per seed: where its owners begin
    owners: np.ndarray          # (item, position) rows
    min_match: int

    @classmethod
    def build(cls, rows: list[tuple[int, str | None]], min_match: int) -> ItemIndex:
        vocabulary = _Vocabulary()
        items, hashes, owners = [], [], []
        for item_id, text in rows:
            words = tokens(text)
            if len(words) < min_match:
                continue
            ids = np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in words], dtype=np.int64)
            h = rolling(ids, min_match)
            hashes.append(h)
            owners.append(np.stack([np.full(len(h), len(items)), np.arange(len(h))], axis=1))
            items.append((item_id, ids))
        if not items:
            return cls(vocabulary, [], np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros((0, 2), np.int64), min_match)
        h, own = np.concatenate(hashes), np.concatenate(owners)
        order = np.argsort(h, kind="stable")
        seeds, first = np.unique(h[order], return_index=True)
        return cls(vocabulary, items, seeds, np.append(first, len(h)), own[order], min_match)

    def leaks(self, text: str | None, min_coverage: float) -> list[dict]:
        words = tokens(text)
        k = self.min_match
        if not self.items or len(words) < k:
            return []
        doc = np.array(list(map(self.vocabulary.__getitem__, words)), dtype=np.int64)
        h = rolling(doc, k)
        at = np.searchsorted(self.seeds, h)
        at[at == len(self.seeds)] = 0
        hit = np.flatnonzero(self.seeds[at] == h)
        if not len(hit):
            return []
        doc_seeds, item_seeds = defaultdict(list), defaultdict(list)
        for j in hit.tolist():
            s = at[j]
            for item, i in self.owners[self.first[s]:self.first[s + 1]].tolist():
                doc_seeds[item].append(j)
                item_seeds[item].append(i)
        out = []
        for item, places in doc_seeds.items():
            item_id, ids = self.items[item]
            if len(_covered(item_seeds[item], k)) < min_coverage * len(ids):
                continue                # tiles lie within the seeds' cover
            near = np.array(sorted(_covered(places, k)))
            # only what the seeds cover can be tiled; a -1 keeps separate stretches apart
            position = np.arange(len(near)) + np.concatenate(([0], np.cumsum(np.diff(near) > 1)))
            part = np.full(position[-1] + 1, -1, dtype=np.int64)
            origin = part.copy()
            part[position], origin[position] = doc[near], near
            tiles = tile(ids, part, k, part >= 0)
            matched = sum(n for _, _, n in tiles)
            if matched >= min_coverage * len(ids):
                out.append({"item_id": item_id, "n_item_tokens": len(ids), "n_matched": matched,
                            "coverage": matched / len(ids),
                            "tiles": [{"item_start": i, "doc_start": int(origin[j]), "length": n}
                                      for i, j, n in tiles]})
        return sorted(out, key=lambda x: x["item_id"])


class _TokenHashes(dict):
    def __missing__(self, token: str) -> int:
        if len(self) >= KNOWN_TOKENS:
            self.clear()
        value = self[token] = xxhash.xxh3_64_intdigest(token)
        return value


def seeds_of(text: str, known: _TokenHashes, min_match: int) -> tuple[int, np.ndarray]:
    """Number of tokens, and the hash of the seed that starts at each position."""
    words = tokens(text)
    return len(words), rolling(np.array(list(map(known.__getitem__, words)), dtype=np.uint64), min_match)


def text_key(col: str | Column) -> Column:
    """128 bits that stand for a text (null: null)."""
    return F.unhex(F.md5(col))


def _item_seeds(benchmark: DataFrame, min_match: int) -> DataFrame:
    """Every different item text once: item_key, text, n_tokens, seeds (one a position)."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _TokenHashes()
        for batch in batches:
            rows = []
            for key, text in zip(*(c.to_pylist() for c in batch.columns)):
                n, h = seeds_of(text, known, min_match)
                if len(h):
                    rows.append((key, text, n, h.view(np.int64)))
            columns = list(zip(*rows)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.string(), pa.int32(), pa.list_(pa.int64())))],
                ["item_key", "text", "n_tokens", "seeds"])

    texts = benchmark.select("text").where("text is not null").distinct().select(text_key("text"), "text")
    return texts.mapInArrow(released(run), "item_key binary, text string, n_tokens int, seeds array<bigint>")


def _seed_filter(items: DataFrame, most_bits: int) -> np.ndarray:
    """Bitmap of the items' seeds by their low bits, as bytes: ``most_bits`` at most,
    whatever the size of the benchmark (a fuller one lets more seeds through)."""
    n = items.agg(F.sum(F.size("seeds"))).first()[0] or 0
    bits = max(BITMAP_BITS, min(most_bits, 1 << (BITS_A_SEED * n).bit_length()))
    parts = (items.select(F.explode("seeds").alias("seed"))
             .select(F.col("seed").bitwiseAND(F.lit(bits - 1)).alias("place"))
             .groupBy(F.shiftright("place", 15).alias("part"))
             .agg(F.bitmap_construct_agg(F.col("place").bitwiseAND(F.lit(BITMAP_BITS - 1))).alias("bits")))
    bitmap = np.zeros(bits // 8, dtype=np.uint8)
    for row in parts.collect():
        at = row.part * (BITMAP_BITS // 8)
        bitmap[at:at + len(row.bits)] = np.frombuffer(row.bits, dtype=np.uint8)
    return bitmap


def _text_seeds(texts: DataFrame, bitmap: np.ndarray, min_match: int) -> DataFrame:
    """Every different text (key, text) that has seeds in the bitmap: key, its distinct seeds there."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, mask = _TokenHashes(), np.uint64(len(bitmap) * 8 - 1)
        for batch in batches:
            keys, found = [], []
            for key, text in zip(*(c.to_pylist() for c in batch.columns)):
                h = seeds_of(text, known, min_match)[1]
                place = h & mask
                bit = bitmap[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)
                h = h[(bit & 1).astype(bool)]
                if len(h):
                    keys.append(key)
                    found.append(np.unique(h).view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(found, pa.list_(pa.int64()))],
                                             ["key", "seeds"])

    posted = texts.mapInArrow(released(run), "key binary, seeds array<bigint>")
    return posted.groupBy("key").agg(F.first("seeds").alias("seeds"))


def rare_seeds(at: list[int], seeds: list[int], counts: list[int], n_tokens: int,
               min_match: int, min_coverage: float) -> list[int]:
    """The seeds of which a text must hold one to cover ``min_coverage`` of the item:
    all but the most frequent that can't do it by themselves."""
    places = defaultdict(list)
    for p, s in zip(at, seeds):
        places[s].append(p)
    order = sorted(dict(zip(seeds, counts)).items(), key=lambda x: (x[1], x[0]))
    cover: set[int] = set()
    while order:
        cover |= _covered(places[order[-1][0]], min_match)
        if len(cover) >= min_coverage * n_tokens:
            break
        order.pop()
    return [s for s, n in order if n]


def _rare_seeds(items: DataFrame, posted: DataFrame, min_match: int, min_coverage: float) -> DataFrame:
    """(item_key, seed): each item's rare seeds by the number of texts in ``posted``."""
    counts = posted.select(F.explode("seeds").alias("seed")).groupBy("seed").agg(F.count("*").alias("n"))
    places = items.select("item_key", "n_tokens", F.posexplode("seeds").alias("at", "seed"))
    # one row an item, no longer than the item itself
    by_item = (places.join(counts, "seed", "left").groupBy("item_key", "n_tokens")
               .agg(F.collect_list(F.struct("at", "seed", F.coalesce("n", F.lit(0)).alias("n"))).alias("p"))
               .select("item_key", "n_tokens", "p.at", "p.seed", "p.n"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rare = [(key, rare_seeds(at, seeds, n, n_tokens, min_match, min_coverage))
                    for key, n_tokens, at, seeds, n in zip(*(c.to_pylist() for c in batch.columns))]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in rare], pa.binary()),
                                              pa.array([r for _, r in rare], pa.list_(pa.int64()))],
                                             ["item_key", "rare"])

    rare = by_item.mapInArrow(run, "item_key binary, rare array<bigint>")
    return rare.select("item_key", F.explode("rare").alias("seed"))


def _tiled(beside: DataFrame, min_match: int, min_coverage: float) -> DataFrame:
    """Leaks of rows (key, text, items: array of item_key and text)."""
    tile_type = pa.struct([("item_start", pa.int32()), ("doc_start", pa.int32()), ("length", pa.int32())])
    fields = [("key", pa.binary()), ("item_key", pa.binary()), ("n_item_tokens", pa.int32()),
              ("n_matched", pa.int32()), ("coverage", pa.float64()), ("tiles", pa.list_(tile_type))]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, text, items in zip(*(c.to_pylist() for c in batch.columns)):
                index = ItemIndex.build([(i, item["text"]) for i, item in enumerate(items)], min_match)
                for leak in index.leaks(text, min_coverage):
                    out.append({**leak, "key": key, "item_key": items[leak.pop("item_id")]["item_key"]})
            yield pa.RecordBatch.from_pylist(out, pa.schema(fields))

    schema = ("key binary, item_key binary, n_item_tokens int, n_matched int, coverage double, "
              "tiles array<struct<item_start:int,doc_start:int,length:int>>")
    return beside.mapInArrow(released(run), schema)


def leaking_texts(texts: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH,
                  min_coverage: float = MIN_COVERAGE, filter_bits: int = FILTER_BITS,
                  group_items: int = GROUP_ITEMS) -> DataFrame:
    """One row (key, item_id, n_item_tokens, n_matched, coverage, tiles) for each different
    text of ``texts`` (column text) and each benchmark row (item_id, text) that it leaks."""
    items = stored(_item_seeds(benchmark, min_match), "benchmark-items")
    texts = texts.where("text is not null").select(text_key("text").alias("key"), "text")
    posted = stored(_text_seeds(texts, _seed_filter(items, filter_bits), min_match), "text-seeds")
    rare = _rare_seeds(items, posted, min_match, min_coverage)
    pairs = (posted.select("key", F.explode("seeds").alias("seed")).join(rare, "seed")
             .select("key", "item_key").distinct())
    place = F.row_number().over(Window.partitionBy("key").orderBy("item_key")) - 1
    groups = stored(pairs.withColumn("group", F.floor(place / group_items))
                    .join(items.select("item_key", "text"), "item_key")
                    .groupBy("key", "group").agg(F.collect_list(F.struct("item_key", "text")).alias("items")),
                    "candidates")
    # stored, so that its true size decides how it is joined with the documents
    wanted = texts.join(groups.select("key"), "key", "left_semi").distinct()
    beside = wanted.join(groups, "key").select("key", "text", "items")
    leaks = stored(_tiled(beside, min_match, min_coverage), "leaks")
    ids = benchmark.where("text is not null").select(text_key("text").alias("item_key"), "item_id")
    return leaks.join(ids, "item_key").select("key", "item_id", "n_item_tokens", "n_matched", "coverage", "tiles")


def _unused(name: str, columns: list[str]) -> str:
    while name in columns:
        name += "_"
    return name


def mark_leaks(df: DataFrame, benchmark: DataFrame, text_col: str = "text",
               leaks_col: str = "leaks", **options) -> DataFrame:
    """``df`` plus ``leaks_col``: the items that the text leaks, with their tiles
    (empty where it leaks none)."""
    if leaks_col in df.columns:
        raise ValueError(f"column {leaks_col} exists already")
    key = _unused("_text_key", [*df.columns, leaks_col])
    leaks = leaking_texts(df.select(F.col(text_col).alias("text")), benchmark, **options)
    found = leaks.groupBy(F.col("key").alias(key)).agg(
        F.sort_array(F.collect_list(F.struct(*leaks.columns[1:]))).alias(leaks_col))
    marked = df.withColumn(key, text_key(text_col)).join(found, key, "left").drop(key)
    return marked.withColumn(leaks_col, F.coalesce(leaks_col, F.array()).cast(LEAKS))


def leaked_pairs(df: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row (doc_id, item_id, n_item_tokens, n_matched, coverage, tiles) per leak."""
    leaks = leaking_texts(df.select("text"), benchmark, **options)
    return df.select("doc_id", text_key("text").alias("key")).join(leaks, "key").drop("key")


def decontaminate(df: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df`` that leak no item, with their columns."""
    key = _unused("_text_key", df.columns)
    leaks = leaking_texts(df.select(F.col(text_col).alias("text")), benchmark, **options)
    leaking = leaks.select(F.col("key").alias(key))
    return df.withColumn(key, text_key(text_col)).join(leaking, key, "left_anti").drop(key)
