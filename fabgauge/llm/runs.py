"""Periodic runs of words: stretches that repeat themselves several times in a row.

A suffix automaton holds all substrings of a text, and the path from the state of a prefix up the suffix
links holds all that end there. Every word appended gives the whole path of its prefix a new colour, the
place of the last occurrence, as the access operation of a link-cut tree does. The path falls into segments
of one earlier colour each; a segment that is long against the distance of its colour is a square, and
squares of one start and period are one run. The paths that keep a colour are stacks on the heavy chains
of the tree, so one word costs a few steps whatever the length of the text.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabgauge.llm.common import slices

# A run holds its period so many times, and so many words at least.
REPEATS, SHORTEST = 4, 6

Run = tuple[int, int, int]
RUN_TYPE = "array<struct<start: bigint, length: bigint, period: bigint>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_MIX = np.uint64(0x9E3779B97F4A7C15)


def word_numbers(words: list[bytes]) -> np.ndarray:
    """Equal numbers for equal words, counted from 0."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def pieces(words: np.ndarray, repeats: int = REPEATS, shortest: int = SHORTEST) -> list[tuple[int, int]]:
    """Stretches, as (first, after last), of which one holds each run whole.

    Three neighbouring words inside a run occur in it ``repeats`` - 1 times or more, so a run stops where
    they do not. What is left is cut again until nothing changes.
    """
    found, open_ = [], [(0, len(words))]
    while open_:
        first, after = open_.pop()
        if after - first < shortest:
            continue
        part = words[first:after].astype(np.uint64)
        code = ((part[:-2] * _MIX + part[1:-1]) * _MIX + part[2:]) * _MIX
        order = np.argsort(code)
        ranked = code[order]
        begin = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
        count = np.diff(np.append(begin, len(ranked)))
        if count.max() < repeats - 1:
            continue
        often = np.zeros(len(code) + 2, bool)
        often[1:-1][order] = np.repeat(count >= repeats - 1, count)
        edges = np.flatnonzero(often[1:] != often[:-1]).reshape(-1, 2)
        if len(edges) == 1 and edges[0, 1] - edges[0, 0] == len(code):
            found.append((first, after))
        else:
            open_ += [(first + int(a), first + int(b) + 2) for a, b in edges]
    return sorted(found)


class _Automaton:
    """Lengths and suffix links of the states of a suffix automaton, and the state of each prefix."""

    def __init__(self, words: list[int]):
        room = 2 * len(words) + 1
        self.length = length = array("i", bytes(4 * room))
        self.link = link = array("i", bytes(4 * room))
        self.prefix = prefix = array("i")
        step: list[dict[int, int]] = [{}]
        link[0] = -1
        last = 0
        for at, word in enumerate(words):
            new = len(step)
            step.append({})
            length[new] = at + 1
            state = last
            while state >= 0 and word not in step[state]:
                step[state][word] = new
                state = link[state]
            if state >= 0:
                target = step[state][word]
                if length[target] > length[state] + 1:
                    copy = len(step)
                    step.append(step[target].copy())
                    length[copy] = length[state] + 1
                    link[copy] = link[target]
                    link[target] = copy
                    while state >= 0 and step[state].get(word) == target:
                        step[state][word] = copy
                        state = link[state]
                    target = copy
                link[new] = target
            prefix.append(new)
            last = new
        self.states = len(step)


def _chains(link: array, length: array, states: int) -> array:
    """The top state of the heavy chain of each state."""
    order = np.argsort(np.frombuffer(length, np.int32)[:states], kind="stable").tolist()
    size = array("i", [1]) * states
    heavy = array("i", [-1]) * states
    for state in reversed(order[1:]):
        above = link[state]
        size[above] += size[state]
        if heavy[above] < 0 or size[state] > size[heavy[above]]:
            heavy[above] = state
    top = array("i", range(states))
    for state in order[1:]:
        above = link[state]
        if heavy[above] == state and above:
            top[state] = top[above]
    return top


def piece_runs(words: list[int], repeats: int = REPEATS) -> Iterator[Run]:
    """All runs of at least ``repeats`` periods, as (start, length, period)."""
    automaton = _Automaton(words)
    length, link = automaton.length, automaton.link
    top = _chains(link, length, automaton.states)
    # Segments of a chain, the shallowest last: length at the lower end, place of the last occurrence.
    segments: dict[int, list[tuple[int, int]]] = {}
    ends: dict[tuple[int, int], int] = {}
    more = repeats - 1
    for at, state in enumerate(automaton.prefix):
        below = -1
        while state > 0:
            chain = top[state]
            stack = segments.setdefault(chain, [])
            deep = length[state]
            lowest = -1
            while stack:
                bottom, before = stack[-1]
                common = bottom if bottom <= deep else deep
                if lowest < 0:
                    lowest = before
                period = at - before
                # The part of a segment in a chain further up says nothing new.
                if before != below and common >= more * period:
                    ends[(at - common - period + 1, period)] = at
                if bottom <= deep:
                    stack.pop()
                if bottom >= deep:
                    break
            stack.append((deep, at))
            if lowest >= 0:
                below = lowest
            state = link[chain]
    for (start, period), end in ends.items():
        yield start, end - start + 1, period


def runs_of(words: np.ndarray, repeats: int = REPEATS, shortest: int = SHORTEST) -> list[Run]:
    """All runs of numbered words by start, then period."""
    found = [
        (first + start, length, period)
        for first, after in pieces(words, repeats, shortest)
        for start, length, period in piece_runs(words[first:after].tolist(), repeats)
        if length >= shortest
    ]
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed(words: list[bytes], runs: list[Run]) -> bytes:
    """The words without the later periods of any run."""
    if not runs:
        return b" ".join(words)
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return b" ".join([words[k] for k in np.flatnonzero(kept)])


def find_runs(docs: DataFrame, repeats: int = REPEATS, shortest: int = SHORTEST) -> DataFrame:
    """The runs of each whole text, and the text with one period left of each: doc_id, runs, collapsed.

    Words are what white space of ASCII separates. A run is a stretch of consecutive words with smallest
    period q, at least ``repeats`` * q and ``shortest`` words long, that can't be extended at either end;
    ``runs`` holds (start, length, period) by start, then period. ``collapsed`` joins with single spaces
    the words that no run holds after its first q words. Every row gives one row, repeated and null ids
    included; a null or empty text has no words, no runs and an empty ``collapsed``; an empty table gives
    no rows. Other columns are ignored. The memory of a task follows its longest periodic stretch.
    """
    if repeats < 2 or shortest < repeats + 1:
        raise ValueError("a run needs two periods or more, and more words than periods")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in slices(batch):
                offsets, rows, left = [0], [], []
                for text in texts:
                    words = (text or "").encode().split()
                    runs = runs_of(word_numbers(words), repeats, shortest)
                    rows += runs
                    offsets.append(len(rows))
                    left.append(collapsed(words, runs))
                columns = np.array(rows, np.int64).reshape(-1, 3).T
                structs = pa.StructArray.from_arrays([pa.array(c) for c in columns], fields=list(_RUN))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), structs),
                        pa.array(left, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "runs", "collapsed"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return rows.mapInArrow(search, f"doc_id long, runs {RUN_TYPE}, collapsed string")


def most_periodic(runs: Column) -> Column:
    """The run with the greatest length/period, the first of equal ones; null without runs."""
    better = lambda best, run: run["length"] * best["period"] > best["length"] * run["period"]
    return F.aggregate(runs, F.get(runs, F.lit(0)), lambda a, x: F.when(better(a, x), x).otherwise(a))


def run_digests(found: DataFrame) -> DataFrame:
    """One row of numbers and digests for each row of ``find_runs``."""
    lines = F.transform(
        "runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    )
    best = F.col("_best")
    return found.withColumn("_best", most_periodic(F.col("runs"))).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("1000 * _best.length div _best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The documents of which a tenth, chosen by id, ends in repetitions of its own words.

    With h the CRC-32 of the id as text and g = h / 10, a text with h % 10 = 0 and n > 0 words gets for
    each word i >= a the word a + (i - a) % p, where a = g % n and p = 1 + (n - a) / (3 + g % 8).
    """
    code = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split(F.col("text"), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    changed = docs.select(
        "doc_id",
        "text",
        F.when(F.pmod(code, F.lit(10)) == 0, words).alias("_words"),
        F.floor(code / 10).alias("_g"),
    )
    n = F.size("_words")
    first = F.pmod(F.col("_g"), n)
    period = 1 + F.floor((n - first) / (3 + F.pmod(F.col("_g"), F.lit(8))))
    source = lambda w, i: F.get(
        "_words", F.when(i < F.col("_a"), i).otherwise(F.col("_a") + F.pmod(i - F.col("_a"), F.col("_p"))).cast("int")
    )
    planted = changed.withColumn("_a", F.when(n > 0, first)).withColumn("_p", F.when(n > 0, period))
    return planted.select(
        "doc_id",
        F.when(F.col("_a").isNotNull(), F.array_join(F.transform("_words", source), " "))
        .otherwise(F.col("text"))
        .alias("text"),
    )
