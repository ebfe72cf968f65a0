"""Benchmark decontamination by spaced seeds, with Spark expressions only.

A mask selects some of the words of a window and ignores the others, so that equal selections are
found although other words were replaced. Seeds of documents meet those of the benchmark by hash; around a
hit, the item is laid beside the document and equal words are counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabgauge.llm.common import stored

# A document is contaminated if so many of the words of a window of an item stand in it in place.
WINDOW, SHARE = 12, 0.75
# The masks for items of so many words, the last ones for all longer ones: 1 selects a word, 0 ignores
# it. However the words that may differ lie in a window, some mask selects none of them.
_LONG = ("110111", "11010011", "110001011", "111011")
MASKS = {
    1: ("1",),
    2: ("11",),
    3: ("111",),
    4: ("111", "1011", "1101"),
    5: ("1111", "10111", "11011", "11101"),
    6: ("11111", "101111", "110111", "111011", "111101"),
    7: ("11111", "110111", "111011"),
    8: ("11111", "101111", "110111", "111011", "1100111", "1110101", "11010011"),
    9: (*_LONG, "11111"),
    10: _LONG[:3],
    11: _LONG[:2],
    WINDOW: _LONG,
}
# Benchmark words that are broadcast at once (about 100 bytes each); more are taken in turn.
BLOCK_WORDS = 500_000


def word_hashes(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters and digits."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def _size_class(words: str) -> Column:
    return F.least(F.size(words), F.lit(WINDOW))


def _masks(items: DataFrame) -> list[str]:
    """The masks for the items there are."""
    sizes = [r[0] for r in items.select(_size_class("item_words")).distinct().collect()]
    return sorted({mask for size in sizes for mask in MASKS.get(size, ())})


def _seeds(rows: DataFrame, words: str, masks: list[str], whole: bool, *kept: str) -> DataFrame:
    """One row per mask and position at which the mask fits: kept columns, place, mask and seed. Of the
    rows that are ``whole`` items only those get a seed that the mask is for."""
    at = rows.select(*kept, words, F.posexplode(words).alias("place", "_word"))
    each = []
    for mask in masks:
        chosen = [F.get(words, F.col("place") + k) for k, c in enumerate(mask) if c == "1"]
        fits = F.col("place") + len(mask) <= F.size(words)
        if whole:
            fits &= _size_class(words).isin([size for size in MASKS if mask in MASKS[size]])
        each.append(F.when(fits, F.xxhash64(F.lit(mask), *chosen)))
    return at.select(*kept, "place", F.posexplode(F.array(*each)).alias("mask", "seed")).filter(
        "seed IS NOT NULL"
    )


def _blocks(items: DataFrame) -> list[DataFrame]:
    """The benchmark in parts of about BLOCK_WORDS words each, cut by item id."""
    words = items.agg(F.coalesce(F.sum(F.size("item_words")), F.lit(0))).first()[0]
    count = -(-words // BLOCK_WORDS)
    if count <= 1:
        return [items]
    return [items.filter(F.pmod(F.xxhash64("item_id"), F.lit(count)) == k) for k in range(count)]


def find_contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents with passages of benchmark items: doc_id, item_id, equal_words, first_word.

    A pair is returned if an item can be laid beside a document so that in some window of WINDOW
    item words (the whole item if shorter) at least SHARE of the words are equal. So an item of one word
    is found wherever the word is. ``equal_words`` is the most equal words of all such ways,
    ``first_word`` the first of them in the document, from 0. Null and empty texts have no words and
    match nothing; rows with null ids are left out; repeated rows count once. Texts are
    read whole, those with a hit twice; other columns are ignored. Ways to lay one item beside one text
    are gathered in one row: no more than both have words, however repetitive they are.
    """
    items = stored(
        benchmark.filter("item_id IS NOT NULL").select(
            "item_id", word_hashes(F.col("text")).alias("item_words")
        ).distinct(),
        "benchmark-words",
    )
    read = docs.filter("doc_id IS NOT NULL").select("doc_id", word_hashes(F.col("text")).alias("words"))
    # Without an item with words any mask will do, as there is nothing to meet.
    masks = _masks(items) or list(_LONG)
    key = F.xxhash64("text").alias("digest")
    texts = docs.filter("doc_id IS NOT NULL").select("doc_id", key, F.col("text").alias("text"))
    read = texts.select("doc_id", "digest", word_hashes(F.col("text")).alias("words"))
    seeds = _seeds(read, "words", masks, False, "doc_id", "digest")
    found = None
    for block in _blocks(items):
        # Both sides of at most about BLOCK_WORDS words.
        index = _seeds(block, "item_words", masks, True, "item_id").select(
            "seed", "mask", "item_id", F.col("place").alias("item_place")
        )
        hits = seeds.join(F.broadcast(index.distinct()), ["seed", "mask"])
        part = _verified(_shifts(hits), texts, block)
        found = part if found is None else found.unionByName(part)
    return found.groupBy("doc_id", "item_id").agg(
        F.max("equal_words").alias("equal_words"), F.min("first_word").alias("first_word")
    )


def _shifts(hits: DataFrame) -> DataFrame:
    """The distinct ways to lay an item beside a text that some hit proposes, for each text and item:
    doc_id, digest, item_id, shifts. No more than both have words, however often the masks fit."""
    rows = hits.select("doc_id", "digest", "item_id", (F.col("place") - F.col("item_place")).alias("shift"))
    ways = rows.groupBy("doc_id", "digest", "item_id").agg(F.collect_set("shift").alias("shifts"))
    return stored(ways, "benchmark-hits")


def _verified(shifts: DataFrame, texts: DataFrame, items: DataFrame) -> DataFrame:
    """Lay the items beside the texts, which are only now read again, as one row per text and item.

    The words are bound by a lambda, so that they are split and hashed once for each row.
    """
    size = F.size("item_words")
    width = F.least(F.lit(WINDOW), size)
    need = F.ceil(width * SHARE)

    def laid(words: Column) -> Column:
        def equal(shift: Column, at: Column) -> Column:
            same = F.get(words, shift + at) == F.get("item_words", at)
            return F.coalesce(same.cast("int"), F.lit(0))

        def count(shift: Column, first: Column, long: Column) -> Column:
            places = F.sequence(first, first + long - 1)
            return F.aggregate(places, F.lit(0), lambda a, k: a + equal(shift, k))

        def holds(shift: Column) -> Column:
            return F.exists(F.sequence(F.lit(0), size - width), lambda k: count(shift, k, width) >= need)

        def first(shift: Column) -> Column:
            return F.aggregate(
                F.sequence(F.lit(0), size - 1),
                F.lit(None).cast("int"),
                lambda a, k: F.coalesce(a, F.when(equal(shift, k) == 1, shift + k)),
            )

        def summed(good: Column) -> Column:
            return F.struct(
                F.array_max(F.transform(good, lambda s: count(s, F.lit(0), size))).cast("long").alias("equal_words"),
                F.array_min(F.transform(good, first)).cast("long").alias("first_word"),
            )

        return F.get(F.transform(F.array(F.filter("shifts", holds)), summed), F.lit(0))

    pairs = shifts.join(texts, ["doc_id", "digest"]).join(F.broadcast(items), "item_id")
    found = F.inline(F.transform(F.array(word_hashes(F.col("text"))), laid))
    return pairs.select("doc_id", "item_id", found).filter("equal_words IS NOT NULL")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without benchmark passages, with all their columns; null ids are kept."""
    found = stored(find_contamination(docs, benchmark).select("doc_id").distinct(), "contaminated")
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)
