"""Licence scan by an exact set-similarity join (operator 13, native).

A template (``license_templates``) is found in a block of text when the block's set
of words holds at least ``PERCENT`` of the template's.  Blocks are lines for notices
and paragraphs (between blank lines) for longer texts; a block of more than
``WINDOW`` words is taken in windows of that many, each half a window after the one
before, so nothing of a long text is left out and sets stay bounded.

1. One scan: each block becomes its distinct words that occur in any template.
   Others can't add to an overlap.  Length filter: a block with fewer of them than
   the least overlap that any template asks for is dropped (nearly all are).
2. The words are ordered by the number of remaining blocks that hold them, rarest
   first (one order for blocks and templates).
3. Prefix filter: a pair that shares ``overlap`` words shares one within the first
   ``size - overlap + 1`` words of both, so only these are posted.  Positional
   filter: what follows the shared word on both sides must be able to fill the
   overlap.  Length filter, by template.
4. Survivors are verified on the full sets.  Where the words of a template are all
   among those of another one in the same block (CC BY in CC BY-NC), only the larger
   is reported.

Everything is DataFrame functions.  What goes to all tasks is bounded by the
templates, whose number of words is checked (``MAX_TEMPLATE_WORDS``): their words in
order, and their prefix postings.  Blocks are never shuffled to be matched, so no
word, line or group of copies can be hot.

Places of phrases (``phrase_places``) are counted apart, on the words of the whole
text.

Defined results: null and empty texts have no words, places or labels; each row is
judged by its own text, also where a doc_id is repeated or null; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.llm.common import stored
from aerolake.llm.license_templates import BODY, NOTICE, TEMPLATES

# The phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

PERCENT = 90                # of a template's words that a block must hold
WINDOW = 512                # words
MAX_TEMPLATE_WORDS = 20_000

NOT_WORDS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANK_LINES = "\\n[\\x20\\x09-\\x0D]*\\n"


def words_of(lowered) -> Column:
    return F.array_remove(F.split(lowered, NOT_WORDS), "")


def lowered(text: str) -> Column:
    return F.translate(F.coalesce(F.col(text), F.lit("")), CAPITALS, SMALL)


def template_table(spark, templates=TEMPLATES) -> DataFrame:
    """(template, label, kind, words, n, overlap) with distinct words."""
    rows = [F.struct(F.lit(i).alias("template"), F.lit(label).alias("label"), F.lit(kind).alias("kind"), F.lit(text).alias("text"))
            for i, (label, kind, text) in enumerate(templates)]
    raw = spark.range(1).select(F.inline(F.array(*rows)))
    held = F.array_distinct(words_of(lowered("text")))
    return raw.select("template", "label", "kind", held.alias("words")).withColumn("n", F.size("words")).withColumn(
        "overlap", F.ceil(F.col("n") * PERCENT / 100).cast("int")).where("n > 0")


def _windows(words: Column) -> Column:
    """A block's words in windows."""
    step, n = WINDOW // 2, F.size(words)
    starts = F.sequence(F.lit(0), F.greatest(F.ceil((n - WINDOW) / step), F.lit(0)).cast("int"))
    return F.transform(starts, lambda i: F.slice(words, i * step + 1, F.lit(WINDOW)))


def _possible(block: str, known: list[str], least: int) -> Column:
    """The windows of a block that hold ``least`` distinct words of ``known``, reduced
    to these.  One expression in which words are split once (a filter on a column of
    words would be pushed below it and split them again)."""
    reduced = lambda words: F.array_distinct(F.filter(words, lambda w: w.isin(known)))     # noqa: E731
    windows = F.flatten(F.transform(F.array(words_of(block)), _windows))
    return F.filter(F.transform(windows, reduced), lambda words: F.size(words) >= least)


def blocks(docs: DataFrame, vocabulary: dict[str, list[str]], least: dict[str, int]) -> DataFrame:
    """(row, kind, words): the blocks of ``docs`` (row, lowered) that hold at least
    ``least[kind]`` distinct words of ``vocabulary[kind]``, reduced to these."""
    found = None
    for kind, cut in ((NOTICE, "\\n"), (BODY, BLANK_LINES)):
        if kind not in vocabulary:
            continue
        of_kind = docs.select("row", F.explode(F.split("lowered", cut)).alias("block")).select(
            "row", F.lit(kind).alias("kind"), F.explode(_possible("block", vocabulary[kind], least[kind])).alias("words"))
        found = of_kind if found is None else found.unionByName(of_kind)
    return found


def template_matches(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """(row, template, label, containment) of the templates in the blocks of ``docs``
    (row, lowered); one row for each block and template."""
    spark = docs.sparkSession
    table = template_table(spark, templates)
    known = table.collect()                                    # the templates' own words: a parameter
    if sum(t["n"] for t in known) > MAX_TEMPLATE_WORDS:
        raise ValueError(f"the templates have more than {MAX_TEMPLATE_WORDS} words")
    vocabulary, least = {}, {}
    for t in known:
        vocabulary.setdefault(t["kind"], set()).update(t["words"])
        least[t["kind"]] = min(least.get(t["kind"], t["overlap"]), t["overlap"])
    possible = stored(blocks(docs, {k: sorted(v) for k, v in vocabulary.items()}, least), "license-blocks")

    # the global order; at most one row for each word of a template comes back
    frequency = {r["word"]: r["n_blocks"] for r in possible.select(F.explode("words").alias("word")).groupBy(
        "word").agg(F.count("*").alias("n_blocks")).collect()}
    order = sorted(set().union(*vocabulary.values()), key=lambda w: (frequency.get(w, 0), w))
    in_order = lambda words: F.array_intersect(F.array(*[F.lit(w) for w in order]), words)     # noqa: E731

    def posted(df: DataFrame, keep: list[str], most: Column) -> DataFrame:
        prefix = F.slice("words", F.lit(1), F.greatest(most, F.lit(0)))
        return df.select(*keep, F.posexplode(prefix).alias("place", "word"))

    sets = possible.select("row", "kind", in_order("words").alias("words"), F.size("words").alias("size"))
    asked = F.create_map(*[F.lit(x) for kv in least.items() for x in kv])
    posts = posted(sets, ["row", "kind", "words", "size"], F.col("size") - asked[F.col("kind")] + 1)
    t = table.withColumn("words", in_order("words"))
    t_posts = posted(t, ["template", "label", "kind", "n", "overlap", "words"], F.col("n") - F.col("overlap") + 1).select(
        "template", "label", F.col("kind").alias("t_kind"), "n", "overlap", F.col("words").alias("t_words"),
        F.col("place").alias("t_place"), F.col("word").alias("t_word"))
    # the right side is bounded by MAX_TEMPLATE_WORDS
    joined = posts.join(F.broadcast(t_posts), (F.col("word") == F.col("t_word")) & (F.col("kind") == F.col("t_kind")))
    candidates = joined.where(
        (F.col("size") >= F.col("overlap"))                                              # length
        & (F.col("place") <= F.col("size") - F.col("overlap"))                           # prefix, by template
        & (F.least(F.col("size") - F.col("place"), F.col("n") - F.col("t_place")) >= F.col("overlap")))   # position
    common = F.array_intersect("words", "t_words")
    # verified at the pair's first shared word: both prefixes hold it
    verified = candidates.withColumn("_common", common).where(
        (F.size("_common") >= F.col("overlap")) & (F.element_at("_common", 1) == F.col("word"))).select(
        "row", "words", "template", "label", (F.size("_common") / F.col("n")).alias("containment"))
    inside = {t["template"]: [o["template"] for o in known if o["kind"] == t["kind"] and set(t["words"]) < set(o["words"])]
              for t in known}
    larger = F.create_map(*[x for k, v in inside.items() for x in (F.lit(k), F.array(*[F.lit(o) for o in v]).cast("array<int>"))])
    by_block = verified.groupBy("row", "words").agg(F.collect_set("template").alias("_all"),
                                                    F.collect_set(F.struct("template", "label", "containment")).alias("_m"))
    return by_block.select("row", "_all", F.inline("_m")).where(
        ~F.arrays_overlap("_all", larger[F.col("template")])).drop("_all")


def phrase_places(words: str, text: str, phrase: str) -> Column:
    """Word numbers (from 0) at which the phrase begins in the array ``words``."""
    parts = phrase.split()
    at = lambda i, k: F.get(F.col(words), i + k)       # noqa: E731
    found = F.filter(F.sequence(F.lit(0), F.size(words) - len(parts)), lambda i: (at(i, 0) == parts[0]) & _rest(at, i, parts))
    return F.when((F.size(words) >= len(parts)) & F.col(text).contains(parts[-1]), found).otherwise(
        F.array().cast("array<int>"))


def _rest(at, i, parts: list[str]) -> Column:
    cond = F.lit(True)
    for k, word in enumerate(parts[1:], 1):
        cond = cond & (at(i, k) == word)
    return cond


def scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES) -> DataFrame:
    """(doc_id, n_words, places, base_labels, template_labels, labels, score) for every
    row of ``docs`` (doc_id, text).

    ``places`` holds all phrases' starts in order, label arrays are sorted and distinct;
    ``score`` is the largest containment found, 1 with a phrase, 0 with neither."""
    rows = docs.select("doc_id", lowered("text").alias("lowered"))
    whole = rows.withColumn("words", words_of("lowered"))
    for k, phrase in enumerate(phrases):
        whole = whole.withColumn(f"_p{k}", phrase_places("words", "lowered", phrase))
    kinds = [F.when(F.size(f"_p{k}") > 0, F.lit(label)) for k, label in enumerate(phrases.values())]
    base = whole.select(
        "doc_id", F.xxhash64("lowered").alias("_hash"), F.size("words").cast("bigint").alias("n_words"),
        F.array_sort(F.flatten(F.array(*[F.col(f"_p{k}") for k in range(len(phrases))]))).alias("places"),
        F.array_sort(F.array_distinct(F.array_compact(F.array(*kinds)))).alias("base_labels"))
    # a row is known by its id and text: rows equal in both have equal matches
    keyed = rows.select(F.struct("doc_id", F.xxhash64("lowered").alias("hash")).alias("row"), "lowered")
    found = template_matches(keyed, templates).groupBy(
        F.col("row.doc_id").alias("_id"), F.col("row.hash").alias("_h")).agg(
        F.array_sort(F.collect_set("label")).alias("_labels"), F.max("containment").alias("_best"))
    out = base.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_h")), "left")
    none = F.array().cast("array<string>")
    with_templates = F.coalesce("_labels", none)
    return out.select(
        "doc_id", "n_words", "places", "base_labels", with_templates.alias("template_labels"),
        F.array_sort(F.array_union("base_labels", with_templates)).alias("labels"),
        F.when(F.size("base_labels") > 0, F.lit(1.0)).otherwise(F.coalesce("_best", F.lit(0.0))).alias("score"))
