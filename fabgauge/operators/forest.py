"""Random forests whose nodes Spark splits together while they are large and grows in one task each once small.

A tree sees each row as often as a Poisson draw says, made from the id of the row and the number of the tree.
While a node holds more rows than a task may hold, histograms of its rows are added up over all tasks and
the best cut is taken from the sum. A smaller node goes with its rows to one task, which grows what is below it.
Values are read as the number of the bin they fall in, one byte each.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fabgauge.operators.ordered import shuffle_partitions
from fabgauge.operators.profile import melt
from fabgauge.session import ensure_checkpoint_dir, pin, release, together

# Bins of a feature, and how many quantiles are looked at to find their limits.
BINS, QUANTILES = 32, 256
# Bytes of a node's rows that one task may hold, and nodes whose histograms are held at a time.
GROUP_BYTES, NODES_AT_ONCE = 16_000_000, 512
# Bytes of drawn rows that are dealt out by tree at a time; they are on disk until their trees are grown.
ROUND_BYTES = 500_000_000
# Rows from which a node is counted by itself.
LARGE = 2000
# Nodes of a forest that scores are made from at a time, 20 bytes each.
GROUP_NODES = 250_000
# A smaller gain is rounding.
LEAST_GAIN = 1e-12
# Shares of rows drawn at most 0, 1, 2, ... times, when as many are drawn as there are.
DRAWN = np.cumsum([0.36787944117144233 / f for f in np.cumprod([1.0, *range(1, 13)])])

GROWN = "tree int, top int, node int, left int, right int, feature int, bin int, gain double, counts array<double>"
SAVED = (
    "treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, "
    "rawCount: bigint, gain: double, leftChild: int, rightChild: int, split: struct<featureIndex: int, "
    "leftCategoriesOrThreshold: array<double>, numCategories: int>>"
)
_LISTS = pa.list_(pa.float64())
_CUT = pa.schema(
    [("number", pa.int32()), ("gain", pa.float64()), ("feature", pa.int32()), ("bin", pa.int32())]
    + [("lower", _LISTS), ("counts", _LISTS)]
)
_SPLIT = pa.struct([("featureIndex", pa.int32()), ("leftCategoriesOrThreshold", _LISTS), ("numCategories", pa.int32())])
_NODE = pa.struct(
    [("id", pa.int32()), ("prediction", pa.float64()), ("impurity", pa.float64()), ("impurityStats", _LISTS)]
    + [("rawCount", pa.int64()), ("gain", pa.float64()), ("leftChild", pa.int32()), ("rightChild", pa.int32())]
    + [("split", _SPLIT)]
)
_SAVED = pa.schema([("treeID", pa.int32()), ("nodeData", _NODE)])


def bin_limits(rows: DataFrame, features: Sequence[str]) -> list[list[float]]:
    """Increasing upper limits of all bins but the last: every value if there are few, else quantiles."""
    shares = F.lit(np.arange(QUANTILES + 1) / QUANTILES)
    values = [F.nanvl(F.col(f"`{f}`").cast("double"), F.lit(None)).alias(f"q{i}") for i, f in enumerate(features)]
    # The sketches of approxQuantile, whose result the driver would fetch number by number.
    quantiles = F.percentile_approx("value", shares, 4 * QUANTILES).alias("values")
    long = melt(rows.select(*values), [f"q{i}" for i in range(len(features))])
    found = {r["feature"]: r["values"] for r in long.groupBy("feature").agg(quantiles).collect()}
    limits = []
    for i in range(len(features)):
        values = found.get(f"q{i}") or []
        distinct = np.unique(values)[:-1]
        if len(distinct) >= BINS:
            distinct = np.unique([values[QUANTILES * i // BINS] for i in range(1, BINS)])
        limits.append(distinct.astype(float).tolist())
    return limits


def draws(ids: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is drawn for the tree."""
    start = ((tree + 1) * 0x9E3779B97F4A7C15 + seed * 0xD1B54A32D192ED03) & 0xFFFFFFFFFFFFFFFF
    x = ids.view(np.uint64) ^ np.uint64(start)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB), (31, 1)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    x >>= np.uint64(11)
    # Doubles of 53 bits: a limit is passed from the next whole number on. The later limits are passed by few.
    limits = np.ceil(DRAWN * 2.0**53).astype(np.uint64)
    count = (x >= limits[0]).view(np.uint8)
    for limit in limits[1:3]:
        count += (x >= limit).view(np.uint8)
    many = np.flatnonzero(count == 3)
    count[many] = np.searchsorted(limits, x[many], side="right")
    return count


def chosen_features(seed: int, tree: int, node: int, count: int, features: int) -> np.ndarray:
    return np.random.default_rng([seed, tree, node]).permutation(features)[:count]


def histograms(bins: np.ndarray, label: np.ndarray, count: np.ndarray, node: np.ndarray, chosen: np.ndarray, classes: int):
    """Rows drawn by node, chosen feature, class and bin."""
    nodes, wide = chosen.shape
    rows, features = bins.shape
    at = chosen.take(node, 0)
    at += (np.arange(rows) * features)[:, None]
    values = bins.ravel().take(at)
    cell = np.add(((node * (wide * classes) + label) * BINS)[:, None], np.arange(wide) * (classes * BINS), out=at)
    cell += values
    size = nodes * wide * classes * BINS
    return np.bincount(cell.ravel(), np.repeat(count, wide), size).reshape(nodes, wide, classes, BINS)


def sorted_histograms(bins: np.ndarray, label: np.ndarray, count: np.ndarray, node: np.ndarray, chosen: np.ndarray, classes: int):
    """The same for rows sorted by node: a large node is counted by itself, which needs no places of its cells."""
    ends = np.searchsorted(node, np.arange(len(chosen) + 1))
    large = np.diff(ends) >= LARGE
    if not large.any():
        return histograms(bins, label, count, node, chosen, classes)
    hist = np.empty((*chosen.shape, classes, BINS))
    small = np.flatnonzero(~large)
    if len(small):
        rows = np.flatnonzero(~large[node])
        number = (np.cumsum(~large) - 1)[node[rows]]
        hist[small] = histograms(bins[rows], label[rows], count[rows], number, chosen[small], classes)
    for n in np.flatnonzero(large):
        rows = slice(ends[n], ends[n + 1])
        start, times = label[rows] * BINS, count[rows]
        for i, feature in enumerate(chosen[n]):
            hist[n, i] = np.bincount(start + bins[rows, feature], times, classes * BINS).reshape(classes, BINS)
    return hist


def best_cuts(hist: np.ndarray, weight: np.ndarray):
    """By node: gain of Gini impurity, place of the feature, last bin to the left, rows of the left child by class."""
    left = hist.cumsum(3)
    total = left[:, :1, :, -1:]
    left = left[..., :-1]
    score = None
    for part in (left, total - left):
        size = square = 0.0
        # Class by class, as sums over a last axis of two are slow.
        for c, w in enumerate(weight):
            weighted = part[:, :, c] * w
            size, square = size + weighted, square + weighted * weighted
        with np.errstate(invalid="ignore"):
            side = np.where(size > 0, square / size, -np.inf)
        score = side if score is None else score + side
    flat = score.reshape(len(hist), -1)
    best = flat.argmax(1)
    weighted = total[:, 0, :, 0] * weight
    size = weighted.sum(-1)
    gain = flat[np.arange(len(hist)), best] / size - ((weighted / size[:, None]) ** 2).sum(-1)
    place, last = np.divmod(best, BINS - 1)
    return gain, place, last, left[np.arange(len(hist)), place, :, last]


@dataclass
class Nodes:
    """A tree, or the lower part of one, level by level, as lists or arrays; leaves have no children."""

    left: Sequence[int] = field(default_factory=list)
    right: Sequence[int] = field(default_factory=list)
    feature: Sequence[int] = field(default_factory=list)
    bin: Sequence[int] = field(default_factory=list)
    gain: Sequence[float] = field(default_factory=list)
    counts: Sequence = field(default_factory=list)

    def add(self, counts: np.ndarray) -> int:
        """Leaves with these rows by class; returns the number of the first."""
        first, more = len(self.left), len(counts)
        for column, value in ((self.left, -1), (self.right, -1), (self.feature, -1), (self.bin, -1), (self.gain, -1.0)):
            column.extend([value] * more)
        self.counts.extend(counts.tolist())
        return first

    def cut(self, node: int, feature: int, last: int, gain: float, children: int) -> None:
        self.left[node], self.right[node] = children, children + 1
        self.feature[node], self.bin[node], self.gain[node] = feature, last, gain

    def place(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        left, right, feature, last = (np.array(c) for c in (self.left, self.right, self.feature, self.bin))
        node = np.zeros(len(bins), np.int64)
        open_ = np.flatnonzero(left[node] >= 0)
        while len(open_):
            at = node[open_]
            node[open_] = np.where(bins[open_, feature[at]] <= last[at], left[at], right[at])
            open_ = open_[left[node[open_]] >= 0]
        return node


def grown(bins, label, count, weight, wide: int, depth: int, random: np.random.Generator) -> Nodes:
    """All nodes below and with the one that holds these rows, each column as one array."""
    levels, classes, features = [], len(weight), bins.shape[1]
    raw, start = np.bincount(label, count, classes)[None], 0
    node = np.zeros(len(label), np.int64)
    for level in range(depth + 1):
        links, gains = np.full((4, len(raw)), -1), np.full(len(raw), -1.0)
        levels.append((links, gains, raw))
        start += len(raw)
        open_ = np.flatnonzero((raw > 0).sum(1) > 1)
        if level == depth or not len(open_):
            break
        # The last place is for rows without a node.
        number = np.full(len(raw) + 1, -1)
        number[open_] = np.arange(len(open_))
        node = number[node]
        keep = np.flatnonzero(node >= 0)
        # Short numbers are sorted by their digits, which takes a few passes.
        short = np.uint16 if len(open_) < 2**16 else np.int64
        keep = keep[np.argsort(node[keep].astype(short), kind="stable")]
        bins, label, count, node = (c.take(keep, 0) for c in (bins, label, count, node))
        target, below, children = np.full(len(open_), -1), [], 0
        for low in range(0, len(open_), NODES_AT_ONCE):
            part = open_[low : low + NODES_AT_ONCE]
            chosen = random.random((len(part), features)).argpartition(wide - 1, 1)[:, :wide]
            rows = slice(*np.searchsorted(node, [low, low + len(part)]))
            hist = sorted_histograms(bins[rows], label[rows], count[rows], node[rows] - low, chosen, classes)
            gain, place, last, left = best_cuts(hist, weight)
            cut = np.flatnonzero(gain > LEAST_GAIN)
            child, at, left = children + 2 * np.arange(len(cut)), part[cut], left[cut]
            links[:, at] = start + child, start + child + 1, chosen[cut, place[cut]], last[cut]
            gains[at], target[low + cut] = gain[cut], child
            below.append(np.stack([left, raw[at] - left], 1).reshape(-1, classes))
            children += 2 * len(cut)
        if not children:
            break
        # Rows are moved once a level, when those of the next one are sorted.
        test, last = links[2:, open_]
        upper = bins[np.arange(len(bins)), test[node]] > last[node]
        child = target[node]
        node = np.where(child >= 0, child + upper, -1)
        raw = np.concatenate(below)
    links, gains, counts = (np.concatenate(c, -1 if i == 0 else 0) for i, c in enumerate(zip(*levels)))
    return Nodes(*links, gains, counts)


def _lists(values: np.ndarray) -> pa.Array:
    """Each row of the array as a list."""
    ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(ends, values.ravel().astype(float))


def in_preorder(nodes: Nodes, weight: np.ndarray, limits: Sequence[Sequence[float]]) -> pa.StructArray:
    """A whole tree as the rows of a saved model; two leaves that predict the same become one, as in Spark's trees."""
    left, right, feature, last, gain, counts = (np.array(c) for c in vars(nodes).values())
    stats = counts * weight
    predicted = stats.argmax(1)
    impurity = 1 - ((stats / stats.sum(1, keepdims=True)) ** 2).sum(1)
    levels, level = [], np.zeros(1, int)
    while len(level):
        levels.append(level)
        level = level[left[level] >= 0]
        level = np.concatenate([left[level], right[level]])
    size = np.ones(len(left), int)
    for level in reversed(levels):
        inner = level[left[level] >= 0]
        a, b = left[inner], right[inner]
        same = (left[a] < 0) & (left[b] < 0) & (predicted[a] == predicted[b])
        left[inner[same]] = right[inner[same]] = -1
        size[inner[~same]] += size[a[~same]] + size[b[~same]]
    at, level = np.full(len(left), -1), np.zeros(1, int)
    at[0] = 0
    while len(level):
        level = level[left[level] >= 0]
        a, b = left[level], right[level]
        at[a], at[b] = at[level] + 1, at[level] + 1 + size[a]
        level = np.concatenate([a, b])
    order = np.empty(size[0], int)
    order[at[at >= 0]] = np.flatnonzero(at >= 0)
    inner = left[order] >= 0
    cut = order[inner]
    starts = np.cumsum([0, *map(len, limits)])[:-1]
    edges = np.concatenate([np.asarray(x, float) for x in limits])[starts[feature[cut]] + last[cut]]
    ends = np.concatenate([[0], np.cumsum(inner)]).astype(np.int32)
    of = lambda values, other: np.where(inner, values, other)
    split = [of(feature[order], -1), pa.ListArray.from_arrays(ends, edges), np.full(len(order), -1)]
    columns = [np.arange(len(order)), predicted[order].astype(float), impurity[order], _lists(stats[order])]
    columns += [counts[order].sum(1).astype(int), of(gain[order], -1.0), of(at[left[order]], -1), of(at[right[order]], -1)]
    return _struct([*columns, _struct(split, _SPLIT)], _NODE)


def _struct(columns: Sequence, kind: pa.StructType) -> pa.StructArray:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, kind, strict=True)]
    return pa.StructArray.from_arrays(arrays, fields=list(kind))


@dataclass(frozen=True)
class Setting:
    """What all tasks need to know: limits of bins, weight by class, features tried at a node, levels and seed."""

    limits: list[list[float]]
    weight: np.ndarray
    wide: int
    depth: int
    seed: int

    def matrix(self, column: pa.Array, extra: int = 0) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, len(self.limits) + extra)


def binned_rows(rows: DataFrame, vector: str, label: str, limits: Sequence[Sequence[float]]) -> DataFrame:
    """``id, label, bins`` in a stored table, with one byte per feature."""

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            bins = np.empty(values.shape, np.uint8)
            for i, edges in enumerate(limits):
                bins[:, i] = np.searchsorted(edges, values[:, i])
            cells = pa.array([r.tobytes() for r in bins], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], cells], names=["id", "label", "bins"])

    plain = rows.select(
        F.monotonically_increasing_id().alias("id"), F.col(label).cast("int").alias("label"), vector_to_array(vector)
    )
    return pin(plain.mapInArrow(binned, "id long, label int, bins binary"))


def _placed(data: Setting, tops: list[Nodes], trees: Sequence[int], batch: pa.RecordBatch):
    """For each tree the rows drawn: bins, class, how often, and the leaf of the part grown so far."""
    ids, label = (batch.column(i).to_numpy() for i in (0, 1))
    bins = data.matrix(batch.column(2))
    for tree in trees:
        count = draws(ids, tree, data.seed)
        drawn = np.flatnonzero(count)
        yield tree, bins[drawn], label[drawn], count[drawn], tops[tree].place(bins[drawn])


def _cut_large(table: DataFrame, data: Setting, tops: list[Nodes], nodes: list[tuple[int, int]]) -> list:
    """Best cuts of leaves from histograms that are added up over all tasks: number in the list, cut and counts."""
    trees = sorted({tree for tree, _ in nodes})
    wide, classes, features, weight = data.wide, len(data.weight), len(data.limits), data.weight
    chosen = np.array([chosen_features(data.seed, *n, wide, features) for n in nodes])
    number = {n: i for i, n in enumerate(nodes)}
    cell = np.zeros((1, wide, classes, BINS))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(nodes), *cell.shape[1:]))
        for batch in batches:
            for tree, bins, label, count, node in _placed(data, tops, trees, batch):
                for at in np.flatnonzero(np.bincount(node)):
                    if (i := number.get((tree, int(at)))) is not None:
                        rows = np.flatnonzero(node == at)
                        held = (c.take(rows, 0) for c in (bins, label, count))
                        total[i] += sorted_histograms(*held, np.zeros(len(rows), int), chosen[i : i + 1], classes)[0]
        found = np.flatnonzero(total.any((1, 2, 3)))
        yield pa.RecordBatch.from_pydict(
            {"number": pa.array(found, pa.int32()), "hist": pa.array([total[i].tobytes() for i in found], pa.binary())}
        )

    def cut(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(h) for h in table["hist"].to_pylist()], 0).reshape(cell.shape)
        gain, place, last, left = best_cuts(total, weight)
        i = table["number"][0].as_py()
        row = {"number": i, "gain": gain[0], "feature": int(chosen[i, place[0]]), "bin": int(last[0])}
        counts = {"lower": left[0].tolist(), "counts": total[0, 0].sum(1).tolist()}
        return pa.Table.from_pylist([row | counts], _CUT)

    hists = table.mapInArrow(counted, "number int, hist binary")
    cuts = hists.groupBy("number").applyInArrow(
        cut, "number int, gain double, feature int, bin int, lower array<double>, counts array<double>"
    )
    return cuts.collect()


def top_parts(
    table: DataFrame, data: Setting, trees: int, rows: int, group_rows: int
) -> tuple[list[Nodes], dict[tuple[int, int], int]]:
    """The part of each tree above nodes that fit a task, and those nodes with the levels left below them."""
    classes = len(data.weight)
    tops = [Nodes() for _ in range(trees)]
    for top in tops:
        top.add(np.full((1, classes), float(rows)))
    small, large = {}, {(tree, 0): data.depth for tree in range(trees)}
    if rows <= group_rows or data.depth == 0:
        return tops, large
    while large:
        level, large = list(large.items()), {}
        made = []
        for low in range(0, len(level), NODES_AT_ONCE):
            part = level[low : low + NODES_AT_ONCE]
            made += [(part[r.number], r) for r in _cut_large(table, data, tops, [n for n, _ in part])]
        for ((tree, node), depth), row in sorted(made, key=lambda m: m[0]):
            top, counts, lower = tops[tree], np.array(row.counts), np.array(row.lower)
            top.counts[node] = counts.tolist()
            if row.gain <= LEAST_GAIN:
                continue
            children = top.add(np.array([lower, counts - lower]))
            top.cut(node, row.feature, row.bin, row.gain, children)
            for child, held in ((children, lower), (children + 1, counts - lower)):
                if depth > 1 and (held > 0).sum() > 1:
                    (small if held.sum() <= group_rows else large)[tree, child] = depth - 1
    return tops, small


def forest_nodes(table: DataFrame, data: Setting, trees: int, group_rows: int) -> DataFrame:
    """All trees as ``treeID, nodeData``, the rows of a saved model."""
    return lower_parts(table, data, *top_parts(table, data, trees, table.count(), group_rows), range(trees))


def lower_parts(
    table: DataFrame, data: Setting, tops: list[Nodes], small: dict[tuple[int, int], int], trees: range
) -> DataFrame:
    """These trees, whose parts above are given, as ``treeID, nodeData``."""
    weight, limits, seed, wide, classes = data.weight, data.limits, data.seed, data.wide, len(data.weight)
    spark = table.sparkSession
    # Nodes are dealt out evenly enough by their hash if there are more partitions than cores; putting a tree together is short.
    cores = spark.sparkContext.defaultParallelism
    parts = max(shuffle_partitions(table), 4 * cores)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree, bins, label, count, node in _placed(data, tops, trees, batch):
                cells = np.column_stack([label.astype(np.uint8), count, bins])
                found = [int(n) for n in np.unique(node) if (tree, int(n)) in small]
                yield pa.RecordBatch.from_pydict(
                    {
                        "tree": pa.array([tree] * len(found), pa.int32()),
                        "top": pa.array(found, pa.int32()),
                        "cells": pa.array([cells[node == n].tobytes() for n in found], pa.binary()),
                    }
                )

    def below(key: tuple, table: pa.Table) -> pa.Table:
        tree, top = (k.as_py() for k in key)
        cells = data.matrix(table["cells"], 2)
        random = np.random.default_rng([seed, tree, top])
        label, count = cells[:, 0].astype(int), cells[:, 1].astype(float)
        # The order in which blocks of rows arrive changes no count, so it changes no tree.
        found = grown(cells[:, 2:], label, count, weight, wide, small[tree, top], random)
        number = len(found.left)
        columns = [np.full(number, tree), np.full(number, top), np.arange(number)]
        columns += [found.left, found.right, found.feature, found.bin]
        return pa.table(
            [*[pa.array(c, pa.int32()) for c in columns], pa.array(found.gain), _lists(found.counts)],
            names=["tree", "top", "node", "left", "right", "feature", "bin", "gain", "counts"],
        )

    def whole(key: tuple, table: pa.Table) -> pa.Table:
        tree = key[0].as_py()
        upper = [np.array(c) for c in vars(tops[tree]).values()]
        table = table.filter(pc.greater_equal(table["node"], 0)).sort_by([("top", "ascending"), ("node", "ascending")])
        table = table.combine_chunks()
        top, node, left, right, feature, last, gain = (table[c].to_numpy() for c in table.column_names[1:-1])
        counts = pc.list_flatten(table["counts"]).to_numpy().reshape(len(node), -1 if len(node) else classes)
        # The first node of a lower part is the leaf it was grown from; the others follow the nodes above.
        leaf = np.flatnonzero(node == 0)
        before = len(upper[0]) + leaf - np.arange(len(leaf)) - 1
        start = np.repeat(before, np.diff([*leaf, len(node)]))
        at, more = np.where(node == 0, top, start + node), len(node) - len(leaf)
        lower = [np.where(left < 0, -1, start + left), np.where(right < 0, -1, start + right), feature, last, gain, counts]
        columns = []
        for above, below in zip(upper, lower, strict=True):
            columns.append(np.concatenate([above, np.zeros((more, *above.shape[1:]), above.dtype)]))
            columns[-1][at] = below
        data = in_preorder(Nodes(*columns), weight, limits)
        return pa.Table.from_arrays([pa.array(np.full(len(data), tree), pa.int32()), data], schema=_SAVED)

    blocks = table.mapInArrow(dealt, "tree int, top int, cells binary")
    lower = blocks.repartition(parts, "tree", "top").groupBy("tree", "top").applyInArrow(below, GROWN)
    # Each tree has a row, also one that is the part above alone.
    none = [f"-1 AS {c}" for c in ("top", "node", "left", "right", "feature", "bin")]
    every = spark.range(trees.start, trees.stop).selectExpr("cast(id AS int) AS tree", *none, "-1D AS gain", "array(0D) AS counts")
    together = lower.unionByName(every).repartition(2 * cores, "tree").groupBy("tree")
    return together.applyInArrow(whole, SAVED)


class Trees:
    """Some trees of a saved forest for two classes, as arrays of nodes in preorder: a left child follows its node.

    The value of a leaf is its share of class 1, and its right child the place of its share of class 0.
    """

    def __init__(self, table: pa.Table):
        """From rows of ``compact``, whole trees."""
        order = np.lexsort([table[c].to_numpy() for c in ("id", "treeID")])
        self.roots = np.flatnonzero(table["id"].to_numpy()[order] == 0)
        self.feature, self.value = (table[c].to_numpy()[order] for c in ("feature", "value"))
        inner = self.feature >= 0
        self.good = table["good"].to_numpy()[order][~inner]
        start = np.repeat(self.roots, np.diff([*self.roots, len(order)]))
        self.right = np.where(inner, table["right"].to_numpy()[order] + start, np.cumsum(~inner) - 1).astype(np.int32)

    def votes(self, leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shares of class 0 and 1."""
        return self.good[self.right[leaves]], self.value[leaves]

    def leaves(self, root: int, values: np.ndarray) -> np.ndarray:
        node = np.full(len(values), root)
        open_ = np.flatnonzero(self.feature[node] >= 0)
        while len(open_):
            at = node[open_]
            lower = values[open_, self.feature[at]] <= self.value[at]
            at = node[open_] = np.where(lower, at + 1, self.right[at])
            open_ = open_[self.feature[at] >= 0]
        return node

    def other_leaves(self, root: int, values: np.ndarray, other: np.ndarray):
        """The leaf of each row, and ``row, feature, leaf`` where one feature taken from ``other`` leaves the row's path.

        A path is left at the first node that tests the feature and sends the other value to the other side; only
        from there on it is walked again.
        """
        node, met = np.full(len(values), root), np.zeros(values.shape, bool)
        open_ = np.flatnonzero(self.feature[node] >= 0)
        left = [(np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64))]
        while len(open_):
            at = node[open_]
            feature, limit = self.feature[at], self.value[at]
            lower = values[open_, feature] <= limit
            first = np.flatnonzero((lower != (other[open_, feature] <= limit)) & ~met[open_, feature])
            below, above = at + 1, self.right[at]
            row, tests = open_[first], feature[first]
            met[row, tests] = True
            left.append((row, tests, np.where(lower[first], above[first], below[first])))
            at = node[open_] = np.where(lower, below, above)
            open_ = open_[self.feature[at] >= 0]
        row, feature, leaf = (np.concatenate(c) for c in zip(*left))
        open_ = np.flatnonzero(self.feature[leaf] >= 0)
        while len(open_):
            at, rows = leaf[open_], row[open_]
            tests = self.feature[at]
            source = np.where(tests == feature[open_], other[rows, tests], values[rows, tests])
            at = leaf[open_] = np.where(source <= self.value[at], at + 1, self.right[at])
            open_ = open_[self.feature[at] >= 0]
        return node, row, feature, leaf


def compact(nodes: DataFrame) -> DataFrame:
    """The columns of a node table that scores need."""
    split, stats = F.col("nodeData.split"), F.col("nodeData.impurityStats")
    total = F.aggregate(stats, F.lit(0.0), lambda sum_, rows: sum_ + rows)
    leaf, (good, bad) = F.col("nodeData.leftChild") < 0, (F.try_divide(stats[c], total) for c in (0, 1))
    return nodes.select(
        "treeID",
        F.col("nodeData.id").alias("id"),
        F.col("nodeData.rightChild").alias("right"),
        F.when(leaf, -1).otherwise(split["featureIndex"]).cast("int").alias("feature"),
        F.when(leaf, F.coalesce(bad, F.lit(0.0))).otherwise(F.get(split["leftCategoriesOrThreshold"], F.lit(0))).alias("value"),
        F.when(leaf, F.coalesce(good, F.lit(0.0))).alias("good"),
    )


def tree_groups(nodes: DataFrame) -> list[Broadcast]:
    """All trees in order, in groups of about GROUP_NODES nodes, of which the driver and a worker hold one at a time."""
    sizes = sorted(tuple(r) for r in nodes.groupBy("treeID").count().collect())
    ends = np.cumsum([n for _, n in sizes])
    number = (ends - 1) // GROUP_NODES
    groups = []
    for g in np.unique(number):
        trees = [sizes[i][0] for i in np.flatnonzero(number == g)]
        rows = compact(nodes.where(F.col("treeID").between(trees[0], trees[-1])))
        groups.append(nodes.sparkSession.sparkContext.broadcast(Trees(rows.toArrow())))
    return groups


def opened(groups: Sequence[Broadcast]) -> Iterator[Trees]:
    """One group after the other; a worker, which would keep all it once read, forgets each after its use."""
    for group in groups:
        yield group.value
        if getattr(group, "_path", None):
            vars(group).pop("_value", None)


def share(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Probability of class 1 from the votes, as Spark's model has it."""
    return np.divide(bad, good + bad, out=np.zeros(bad.shape), where=good + bad != 0)


def scores(groups: Sequence[Broadcast], values: np.ndarray) -> np.ndarray:
    """Probability of class 1 by row; the votes are added up tree by tree, as Spark's model does."""
    totals = np.zeros((2, len(values)))
    for trees in opened(groups):
        for root in trees.roots:
            totals += trees.votes(trees.leaves(root, values))
    return share(*totals)


def changed_scores(groups: Sequence[Broadcast], values: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Scores by row and feature, with the one feature taken from ``other``, added up in the same order."""
    totals = np.zeros((2, *values.shape))
    for trees in opened(groups):
        for root in trees.roots:
            leaf, row, feature, again = trees.other_leaves(root, values, other)
            for total, plain, moved in zip(totals, trees.votes(leaf), trees.votes(again), strict=True):
                # Where the path is left, the other leaf votes instead.
                kept = total[row, feature] + moved
                total += plain[:, None]
                total[row, feature] = kept
    return share(*totals)


class GrownForest(PipelineModel):
    """Preparation and a grown forest in the files of Spark's model.

    Spark's model holds an object per node and is read from the files only when ``stages`` are asked for, as
    saving and ``transform`` do; rows are scored from the trees as arrays, and importances added up by Spark.
    """

    def __init__(self, preparation: Sequence[Transformer], folder: str, classes: int, depth: int):
        super(PipelineModel, self).__init__()
        self.preparation, self.folder, self.classes, self.depth = list(preparation), folder, classes, depth
        self._forest = self._groups = None

    @property
    def stages(self) -> list[Transformer]:
        if self._forest is None:
            self._forest = RandomForestClassificationModel.load(self.folder)._set(maxDepth=self.depth)
        return [*self.preparation, self._forest]

    def nodes(self) -> DataFrame:
        """``treeID, nodeData`` of all nodes."""
        return SparkSession.active().read.schema(SAVED).parquet(f"{self.folder}/data")

    def groups(self) -> list[Broadcast]:
        """The trees as arrays, sent to the workers once."""
        if self._groups is None:
            self._groups = tree_groups(self.nodes())
        return self._groups

    def importances(self, features: int) -> np.ndarray:
        """Gains of each feature by the rows they were made on, as shares of a tree's and then of all, as Spark's model
        has them, added up where the nodes are."""
        rows = F.aggregate("nodeData.impurityStats", F.lit(0.0), lambda sum_, rows: sum_ + rows)
        inner = self.nodes().where("nodeData.leftChild >= 0")
        by_tree = inner.groupBy("treeID", F.col("nodeData.split.featureIndex").alias("feature"))
        found = by_tree.agg(F.sum(F.col("nodeData.gain") * rows).alias("gain")).orderBy("treeID", "feature").toArrow()
        tree, feature, gain = (found[c].to_numpy() for c in ("treeID", "feature", "gain"))
        whole = np.bincount(tree, gain)[tree]
        shares = np.divide(gain, whole, out=np.zeros(len(gain)), where=whole != 0)
        total = np.bincount(feature, shares, features)
        return total / total.sum() if total.sum() else total

    def score(self, rows: DataFrame, name: str) -> DataFrame:
        """The rows with the probability of class 1, for a forest of two classes."""
        groups = self.groups()

        @F.arrow_udf("double")
        def scored(values: pa.Array) -> pa.Array:
            matrix = values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)
            return pa.array(scores(groups, matrix))

        ready = PipelineModel(self.preparation).transform(rows)
        return ready.select(*rows.columns, scored(vector_to_array("_features")).alias(name))


def train(
    rows: DataFrame, features: Sequence[str], classifier: RandomForestClassifier, weight: Mapping[int, float]
) -> str:
    """The folder of the classifier's forest, grown on prepared rows, whose columns ``features`` make up its vector.

    The classifier fits trees without levels meanwhile, on a row per class that no tree is grown from; the grown
    trees take their place in its saved model. Trees are grown in rounds, as each gets rows of its own: their files
    go after a round, so that those of all trees are never on disk at once.
    """
    spark = rows.sparkSession
    trees, depth, seed = (classifier.getOrDefault(p) for p in ("numTrees", "maxDepth", "seed"))
    vector, label = classifier.getFeaturesCol(), classifier.getLabelCol()
    weights = np.array([weight.get(c, 0.0) for c in range(max(weight) + 1)])
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/forest-{uuid.uuid4().hex}"

    def save_roots() -> None:
        frame = spark.range(len(weights), numPartitions=1).select(
            array_to_vector(F.array_repeat(F.lit(0.0), len(features))).alias(vector),
            F.col("id").cast("double").alias(label),
            F.lit(1.0).alias(classifier.getWeightCol()),
        )
        classifier.copy({classifier.maxDepth: 0}).fit(frame).write().save(folder)

    def binned() -> tuple[Setting, DataFrame]:
        limits = bin_limits(rows, features)
        data = Setting(limits, weights, math.ceil(math.sqrt(len(features))), depth, seed)
        return data, binned_rows(rows, vector, label, limits)

    (data, table), _ = together(binned, save_roots)
    row_bytes, count = len(features) + 2, table.count()
    tops, small = top_parts(table, data, trees, count, GROUP_BYTES // row_bytes)
    # Draws leave some 0.63 of the rows.
    at_once = max(1, int(ROUND_BYTES // (0.64 * row_bytes * max(1, count))))
    for first in range(0, trees, at_once):
        found = lower_parts(table, data, tops, small, range(first, min(first + at_once, trees)))
        found.write.mode("append" if first else "overwrite").parquet(f"{folder}/data")
        del found
        release(spark)
    return folder
