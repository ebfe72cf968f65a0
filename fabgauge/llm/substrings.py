"""Removal of long passages that an earlier document holds already, by suffix automata.

1. Every window of words is represented by the least hash of the word groups in it, its anchor; equal
   windows have equal anchors. Texts are reduced to the stretches whose anchors occur in several
   documents.
2. Of these, the segments in which a window occurs for the first time are the reference. The hashes only
   choose what stands in it. It is cut into shards of bounded size by anchor.
3. A suffix automaton of each shard, with the smallest document of each of its states, reaches
   every task that streams segments of these anchors. The matching statistics say how many of the last words stand in the
   shard, and whether an earlier document holds them. Where they reach the width of a window,
   its words go; neighbouring windows form one maximal span.

Automata compare the words themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabgauge.llm.common import partitions, slices, stored

# Words of a window, the least passage that is removed.
WIDTH = 50
# Words of the reference in a shard; a task holds one automaton at a time.
SHARD_WORDS = 65_536
# Documents of an anchor that one task streams; an anchor of more is dealt to several tasks.
HOT = 2048
# Segments of one anchor in the reference; an anchor of more is dealt to shards by whole windows.
WIDE = 256

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _groups(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all groups of ``size`` neighbouring words, a power of 2."""
    reach = 1
    while reach < size:
        hashes = (hashes[:-reach] * _MIX) ^ (hashes[reach:] >> np.uint64(1))
        hashes = (hashes ^ (hashes >> np.uint64(31))) * _MIX
        reach *= 2
    return hashes


def _least(values: np.ndarray, size: int) -> np.ndarray:
    """The least of each ``size`` neighbouring values."""
    reach = 1
    while 2 * reach <= size:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = size - reach
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _power(limit: int) -> int:
    return 1 << max(0, limit.bit_length() - 1)


def windows(words: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Anchor and hash of each window, by its first word; none in shorter texts."""
    if len(words) < width:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    size = _power(max(1, width // 3))
    anchors = _least(_groups(hashes, size), width - size + 1)
    half = _power(width)
    code = _groups(hashes, half)
    last = len(words) - width + 1
    whole = (code[:last] * _MIX) ^ (code[width - half :][:last] >> np.uint64(1))
    return anchors.view(np.int64), ((whole ^ (whole >> np.uint64(29))) * _MIX).view(np.int64)


def _stretches(flags: np.ndarray) -> np.ndarray:
    """First and after last of each stretch of true flags."""
    edged = np.concatenate(([False], flags, [False]))
    return np.flatnonzero(edged[1:] != edged[:-1]).reshape(-1, 2)


def _same(anchors: np.ndarray) -> np.ndarray:
    """First and after last of each stretch of equal anchors."""
    first = np.flatnonzero(np.concatenate(([True], anchors[1:] != anchors[:-1])))
    return np.stack([first, np.append(first[1:], len(anchors))], 1)


class Automaton:
    """Suffix automaton of word sequences added in ascending order of their documents.

    ``first`` has the smallest document in which the words of a state occur.
    """

    def __init__(self):
        self.numbers: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.length, self.link, self.first = [0], [-1], [0]

    def add(self, words: list[bytes], doc: int) -> None:
        numbers, state = self.numbers, 0
        for word in words:
            state = self._append(state, numbers.setdefault(word, len(numbers)), doc)

    def _state(self, length: int, link: int, first: int, step: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.first.append(first)
        self.step.append(step)
        return len(self.step) - 1

    def _append(self, last: int, word: int, doc: int) -> int:
        step, length, link = self.step, self.length, self.link
        target = step[last].get(word)
        if target is not None:
            return target if length[target] == length[last] + 1 else self._split(last, word, target)
        new = self._state(length[last] + 1, 0, doc, {})
        while last >= 0 and word not in step[last]:
            step[last][word] = new
            last = link[last]
        if last >= 0:
            target = step[last][word]
            link[new] = target if length[target] == length[last] + 1 else self._split(last, word, target)
        return new

    def _split(self, last: int, word: int, target: int) -> int:
        step, link = self.step, self.link
        copy = self._state(self.length[last] + 1, link[target], self.first[target], step[target].copy())
        link[target] = copy
        while last >= 0 and step[last].get(word) == target:
            step[last][word] = copy
            last = link[last]
        return copy

    def spans(self, words: list[bytes], doc: int, width: int) -> list[tuple[int, int]]:
        """Maximal spans whose windows all stand in an earlier document of the automaton."""
        get, step, length, link, first = self.numbers.get, self.step, self.length, self.link, self.first
        state = matched = 0
        found: list[tuple[int, int]] = []
        begin = before = -1
        for at, word in enumerate(words):
            number = get(word)
            if number is None:
                state = matched = 0
                continue
            after = step[state].get(number)
            while after is None and state:
                state = link[state]
                matched = length[state]
                after = step[state].get(number)
            if after is None:
                continue
            state = after
            matched += 1
            if matched >= width:
                # No more than a window is followed, so the state has its smallest document.
                matched = width
                while length[link[state]] >= width:
                    state = link[state]
                if first[state] < doc:
                    if at != before + 1 or begin < 0:
                        if begin >= 0:
                            found.append((begin, before + 1))
                        begin = at - width + 1
                    before = at
        if begin >= 0:
            found.append((begin, before + 1))
        return found


def _anchors(texts: DataFrame, width: int) -> DataFrame:
    """The distinct anchors of each document."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, values in slices(batch):
                sets = [np.unique(windows(t.encode().split(), width)[0]) for t in values]
                owner = np.repeat(np.array(ids, np.int64), [len(s) for s in sets])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(owner), pa.array(np.concatenate(sets) if sets else owner)], names=["doc_id", "anchor"]
                )

    return texts.select("doc_id", "text").mapInArrow(read, "doc_id long, anchor long")


def _repeating(texts: DataFrame, width: int) -> DataFrame:
    """Stretches of the texts whose anchors several documents have: doc_id, digest, at, text, and of the
    anchors in them the tasks they are dealt to and whether an earlier document has them."""
    anchors = stored(_anchors(texts, width), "anchors")
    shared = (
        anchors.groupBy("anchor")
        .agg(F.min("doc_id").alias("_first"), F.max("doc_id").alias("_last"), F.count(F.lit(1)).alias("_docs"))
        .filter("_first < _last")
    )
    flag = F.struct(
        "anchor",
        F.ceil(F.col("_docs") / HOT).cast("int").alias("tasks"),
        (F.col("_first") < F.col("doc_id")).alias("later"),
    )
    flags = anchors.join(shared, "anchor").groupBy("doc_id").agg(F.collect_set(flag).alias("_flags"))
    flagged = texts.join(flags, "doc_id").select(
        "doc_id", "digest", "text", "_flags.anchor", "_flags.tasks", "_flags.later"
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows: list[tuple] = []
                for doc, digest, text, anchor, tasks, later in zip(*part, strict=True):
                    words = text.encode().split()
                    mine = windows(words, width)[0]
                    order = np.argsort(np.array(anchor))
                    names = np.array(anchor)[order]
                    flags = np.isin(mine, names)
                    covered = np.zeros(len(words) + 1, np.int64)
                    for a, b in _stretches(flags):
                        covered[a] += 1
                        covered[b + width - 1] -= 1
                    for a, b in _stretches(np.cumsum(covered[:-1]) > 0):
                        inside = np.unique(mine[a : b - width + 1])
                        at = np.searchsorted(names, inside)
                        known = names[np.minimum(at, len(names) - 1)] == inside
                        chosen = order[at[known]]
                        rows.append(
                            (
                                doc,
                                digest,
                                int(a),
                                b" ".join(words[a:b]).decode(),
                                inside[known],
                                [tasks[k] for k in chosen],
                                [later[k] for k in chosen],
                            )
                        )
                yield pa.RecordBatch.from_pylist([dict(zip(_STRETCH.names, r, strict=True)) for r in rows], _STRETCH)

    return flagged.mapInArrow(
        cut, "doc_id long, digest long, at long, text string, anchors array<long>, tasks array<int>, later array<boolean>"
    )


_STRETCH = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("digest", pa.int64()),
        ("at", pa.int64()),
        ("text", pa.string()),
        ("anchors", pa.list_(pa.int64())),
        ("tasks", pa.list_(pa.int32())),
        ("later", pa.list_(pa.bool_())),
    ]
)


def _first_places(stretches: DataFrame, width: int) -> DataFrame:
    """Anchor and document of each window that several documents have, for the first of them."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts, anchors in slices(batch):
                each = []
                for doc, text, names in zip(ids, texts, anchors, strict=True):
                    mine, whole = windows(text.encode().split(), width)
                    kept = np.isin(mine, np.array(names))
                    each.append(np.stack([mine[kept], whole[kept], np.full(int(kept.sum()), doc)]))
                columns = np.concatenate([np.zeros((3, 0), np.int64), *each], 1)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["anchor", "window", "doc_id"])

    rows = stretches.select("doc_id", "text", "anchors").mapInArrow(read, "anchor long, window long, doc_id long")
    found = rows.groupBy("anchor", "window").agg(F.min("doc_id").alias("_first"), F.max("doc_id").alias("_last"))
    return found.filter("_first < _last").select("anchor", F.col("_first").alias("doc_id")).distinct()


_STREAMED = ["doc_id", "digest", "at", "text"]
_SEGMENT = "anchor long, tasks int, doc_id long, digest long, at long, text string"


def _segments(stretches: DataFrame, width: int) -> DataFrame:
    """The text of the windows of each anchor in ``chosen``: _SEGMENT."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows: list[tuple] = []
                for doc, digest, at, text, anchors, tasks in zip(*part, strict=True):
                    if not anchors:
                        continue
                    words = text.encode().split()
                    mine = windows(words, width)[0]
                    wanted = dict(zip(anchors, tasks, strict=True))
                    for a, b in _same(mine):
                        if (name := int(mine[a])) in wanted:
                            passage = b" ".join(words[a : b + width - 1])
                            rows.append((name, wanted[name], doc, digest, at + int(a), passage))
                yield _segment_batch(rows)

    rows = stretches.select("doc_id", "digest", "at", "text", "_chosen.anchor", "_chosen.tasks")
    return rows.mapInArrow(cut, _SEGMENT)


def _segment_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 6
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    arrays = [pa.array(c, k) for c, k in zip(columns[:5], kinds, strict=True)]
    arrays.append(pa.array(columns[5], pa.binary()).cast(pa.string()))
    return pa.RecordBatch.from_arrays(arrays, names=["anchor", "tasks", "doc_id", "digest", "at", "text"])


def _routed(segments: DataFrame, wide: DataFrame, width: int) -> DataFrame:
    """Segments with the anchor in place as ``route``; those of a wide anchor as single windows, with the
    hash of the window."""
    marked = segments.join(wide, "anchor", "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows: list[tuple] = []
                for *row, text, split in zip(*part, strict=True):
                    if not split:
                        rows.append((*row, text.encode()))
                        continue
                    words = text.encode().split()
                    _, tasks, doc, digest, at = row
                    for k, name in enumerate(windows(words, width)[1].tolist()):
                        rows.append((name, tasks, doc, digest, at + k, b" ".join(words[k : k + width])))
                yield _segment_batch(rows)

    rows = marked.select("anchor", "tasks", "doc_id", "digest", "at", "text", "wide")
    return rows.mapInArrow(cut, _SEGMENT).withColumnRenamed("anchor", "route")


def _chosen(stretches: DataFrame, condition) -> DataFrame:
    """Stretches with those of their anchors for which ``condition(anchor, later)`` holds."""
    pairs = F.arrays_zip("anchors", "tasks", "later")
    chosen = F.filter(pairs, lambda p: condition(p["anchors"], p["later"]))
    kept = F.transform(chosen, lambda p: F.struct(p["anchors"].alias("anchor"), p["tasks"].alias("tasks")))
    return stretches.withColumn("_chosen", kept).filter(F.size("_chosen") > 0)


def repeated_spans(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Spans of words that an earlier document holds: doc_id, digest (xxhash64 of the text), spans.

    A window is ``width`` consecutive words of one document; words are what white space of ASCII separates.
    A word is in a span if a window that covers it also stands in a document with a smaller doc_id.
    ``spans`` has (first, after) word numbers, which may overlap; documents without any are left out.
    Rows without doc_id or text take no part. Rows of one id are never earlier than each other;
    those of one id and text are one. Other columns are ignored.
    """
    spark = docs.sparkSession
    texts = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("digest")
    )
    stretches = stored(_repeating(texts, width), "repeating-stretches")
    places = stored(_first_places(stretches, width), "first-places")
    wide = places.groupBy("anchor").count().filter(F.col("count") > WIDE).select("anchor", F.lit(True).alias("wide"))
    firsts = places.groupBy("doc_id").agg(F.collect_set("anchor").alias("_firsts"))
    held = _chosen(stretches.join(firsts, "doc_id"), lambda anchor, later: F.array_contains("_firsts", anchor))
    reference = stored(_routed(_segments(held, width), wide, width), "reference")
    words = reference.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0] // 6
    count = max(partitions(spark), words // SHARD_WORDS)
    shard = F.pmod(F.xxhash64("route"), F.lit(count))
    # Each task that streams segments of a shard gets the reference of the shard.
    sharded = reference.withColumn("shard", shard)
    copies = sharded.groupBy("shard").agg(F.max("tasks").alias("_copies"))
    task = F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)).alias("task")
    shards = sharded.join(copies, "shard").select("shard", task, F.lit(0).alias("kind"), *_STREAMED)
    later = _routed(_segments(_chosen(stretches, lambda anchor, later: later), width), wide, width)
    dealt = F.pmod(F.xxhash64("doc_id", "digest"), F.col("tasks")).cast("int").alias("task")
    streamed = later.select(shard.alias("shard"), dealt, F.lit(1).alias("kind"), *_STREAMED)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, key = Automaton(), None
        for batch in batches:
            for part in slices(batch):
                found: list[tuple] = []
                for number, at_task, kind, doc, digest, at, text in zip(*part, strict=True):
                    if (number, at_task) != key:
                        automaton, key = Automaton(), (number, at_task)
                    passage = text.encode().split()
                    if kind == 0:
                        automaton.add(passage, doc)
                    else:
                        found += [
                            (doc, digest, at + a, at + b) for a, b in automaton.spans(passage, doc, width)
                        ]
                columns = list(zip(*found, strict=True)) or [()] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], names=["doc_id", "digest", "first", "after"]
                )

    rows = shards.unionByName(streamed).repartition(count, "shard", "task")
    rows = rows.sortWithinPartitions("shard", "task", "kind", "doc_id")
    found = rows.mapInArrow(match, "doc_id long, digest long, first long, after long")
    return found.groupBy("doc_id", "digest").agg(F.collect_set(F.struct("first", "after")).alias("spans"))


def remove_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Each document without the words of ``repeated_spans``: doc_id, n_words, n_removed, kept.

    ``kept`` has the other words joined by single spaces. Every row gives one row. A null or empty text has
    no words and an empty ``kept``; a row without doc_id keeps all its words; an empty table gives no rows.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("digest"))
    found = plain.join(repeated_spans(docs, width), ["doc_id", "digest"], "left")

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts, firsts, afters in slices(batch):
                totals, removed, left = [], [], []
                for text, begin, end in zip(texts, firsts, afters, strict=True):
                    words = (text or "").encode().split()
                    total = len(words)
                    if begin:
                        kept = np.ones(total, bool)
                        for a, b in zip(begin, end, strict=True):
                            kept[a:b] = False
                        words = [words[k] for k in np.flatnonzero(kept)]
                    totals.append(total)
                    removed.append(total - len(words))
                    left.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array(totals, pa.int64()),
                        pa.array(removed, pa.int64()),
                        pa.array(left, pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n_words", "n_removed", "kept"],
                )

    rows = found.select("doc_id", "text", "spans.first", "spans.after")
    return rows.mapInArrow(drop, "doc_id long, n_words long, n_removed long, kept string")
