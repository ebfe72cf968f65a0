"""Language identification by rank-order profiles.

A profile lists the most frequent character n-grams of a language in order of frequency. A document
gets the language whose profile has its own most frequent n-grams least out of place.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fabgauge.llm.common import SLICE, sorted_unique, stored, tidy

# N-grams in a profile; an n-gram outside it is this far out of place.
PROFILE = 400
# Documents per language that its profile is counted from, chosen by hash of their id.
SAMPLE_PER_LANGUAGE = 1000
# N-grams a task holds before it counts them; a longer text is counted alone.
HELD = 4_000_000
UNKNOWN = "und"
# Codes of a character: 1 is any run of other characters, letters follow by code point.
LETTERS = 1021


@cache
def _letter_codes() -> np.ndarray:
    """Code of each code point; two letters of one script rarely share one."""
    codes = np.ones(0x110000, np.uint32)
    letters = [c for c in range(0x110000) if unicodedata.category(chr(c))[0] == "L"]
    codes[letters] = 2 + np.array(letters, np.uint32) % LETTERS
    return codes


def grams(text: str | None) -> np.ndarray:
    """Codes of all n-grams of one to three characters of a whole text, within words and their
    edges; none if it has no letter."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le"), "<u4")
    codes = np.concatenate(([1], _letter_codes()[points], [1])).astype(np.uint32)
    codes = codes[np.concatenate(([True], (codes[1:] != 1) | (codes[:-1] != 1)))]
    if len(codes) < 3:
        return np.zeros(0, np.uint32)
    pairs = (codes[:-1] << np.uint32(10)) | codes[1:]
    triples = (pairs[:-1] << np.uint32(10)) | codes[2:]
    return np.concatenate((codes[codes > 1], pairs, triples[codes[1:-1] > 1]))


def ranked(text: str | None, size: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams in order; equally frequent ones by code."""
    found, counts = sorted_unique(grams(text))
    return found[np.argsort(-counts, kind="stable")[:size]]


def learn_profiles(
    docs: DataFrame, size: int = PROFILE, per_language: int = SAMPLE_PER_LANGUAGE
) -> dict[str, np.ndarray]:
    """Profiles from rows with doc_id, text and lang, of which up to ``per_language`` ids (at most 1000)
    are read for each language.

    Those are the ids with the smallest hashes. A limit of the hash by the number of ids leaves about twice
    as many, so that few rows of a language meet in one task however many there are. Rows with a null in one
    of the three are not learned from, an id repeated within a language counts once, with its first text in
    byte order. Without any row there is no profile.
    """
    per_language = min(per_language, 1000)
    known = docs.select("doc_id", "lang", "text").filter(
        "lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL"
    )
    ids = known.select("doc_id", "lang", F.xxhash64("doc_id").alias("hash"))
    share = (2 * per_language + 100) / F.approx_count_distinct("doc_id")
    limits = stored(ids.groupBy("lang").agg(share.alias("share")), "language-limits")
    small = ids.join(limits, "lang").filter(F.col("hash") / 2.0**64 + 0.5 <= F.col("share"))
    first = Window.partitionBy("lang").orderBy("hash", "doc_id")
    chosen = (
        small.select("doc_id", "lang", "hash")
        .distinct()
        .withColumn("n", F.row_number().over(first))
        .filter(F.col("n") <= per_language)
        .select("doc_id", "lang")
    )

    def counted(lang: str, each: list[np.ndarray]) -> pa.RecordBatch:
        codes, counts = sorted_unique(np.concatenate(each))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(codes), pa.string()),
                pa.array(codes.astype(np.int64)),
                pa.array(counts.astype(np.int64)),
            ],
            names=["lang", "code", "n"],
        )

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, list[np.ndarray]] = {}
        held = 0
        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text"), strict=True):
                waiting.setdefault(lang.as_py(), []).append(grams(text.as_py()))
                held += len(waiting[lang.as_py()][-1])
                if held > HELD:
                    yield from (counted(*each) for each in waiting.items())
                    waiting, held = {}, 0
        yield from (counted(*each) for each in waiting.items())

    # A thousand ids a language; the ids of one language are no more than that.
    sample = known.join(F.broadcast(stored(chosen, "language-sample")), ["doc_id", "lang"])
    sample = sample.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    sums = sample.select("lang", "text").mapInArrow(count, "lang string, code long, n long")
    sums = sums.groupBy("lang", "code").agg(F.sum("n").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.col("n").desc(), "code")
    rows = sums.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= size).collect()
    profiles: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["rank"])):
        profiles.setdefault(r["lang"], []).append(r["code"])
    return {lang: np.array(codes, np.uint32) for lang, codes in profiles.items()}


class Ranks:
    """Ranks of all profiles' n-grams, side by side."""

    def __init__(self, profiles: dict[str, np.ndarray], size: int = PROFILE):
        self.languages = sorted(profiles)
        self.size = size
        self.codes = np.unique(np.concatenate([np.zeros(0, np.uint32), *profiles.values()]))
        self.ranks = np.full((len(self.languages), len(self.codes) + 1), -1, np.int64)
        for k, lang in enumerate(self.languages):
            self.ranks[k, np.searchsorted(self.codes, profiles[lang])] = np.arange(len(profiles[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        mine = ranked(text, self.size)
        if not len(mine) or not self.languages:
            return UNKNOWN, 0.0
        at = np.searchsorted(self.codes, mine)
        known = self.codes[np.minimum(at, len(self.codes) - 1)] == mine
        theirs = self.ranks[:, np.where(known, at, len(self.codes))]
        apart = np.where(theirs < 0, self.size, np.abs(theirs - np.arange(len(mine))))
        distance = apart.sum(axis=1)
        best = int(np.argmin(distance))
        return self.languages[best], 1.0 - float(distance[best]) / (self.size * len(mine))


def identify_languages(docs: DataFrame, profiles: dict[str, np.ndarray], text_column: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` (1: nothing out of place, 0: nothing known) to every row.

    Null texts, texts without a letter, and all texts if no profile was learned, are ``und`` with
    score 0. Between equally near languages the alphabetically first wins. Repeated rows are
    judged each; other columns are kept, except those two, which are replaced.
    """
    base = docs.drop("lang_pred", "score")
    ranks = docs.sparkSession.sparkContext.broadcast(Ranks(profiles))

    @tidy
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple[str, float]] = []
            for at in range(0, batch.num_rows, SLICE):
                texts = batch.column(text_column).slice(at, SLICE).to_pylist()
                found += [ranks.value.predict(text) for text in texts]
            yield batch.append_column(
                "lang_pred", pa.array([x[0] for x in found], pa.string())
            ).append_column("score", pa.array([x[1] for x in found], pa.float64()))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema)
    return base.mapInArrow(judge, f"{schema}, lang_pred string, score double")
