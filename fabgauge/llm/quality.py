"""Quality classifier: support vectors on naive Bayes features.

Indicators of byte n-grams are scaled by the log ratio of their smoothed shares in both classes; a
linear hinge-loss model is fitted to them by dual coordinate descent, and its margin becomes a
probability by a logistic curve fitted to labelled documents that the model hasn't seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabgauge.llm.common import SLICE, tidy

# Lengths of n-grams in bytes, and buckets they are hashed to.
GRAMS = (1, 2, 3, 4)
BUCKETS = 1 << 18
# Further indicators: doubled words are more than 1/128, 1/64, ... 1/1 of all words.
DOUBLED = 8
WIDTH = BUCKETS + DOUBLED
# Labelled documents of each class that the fit reads, in expectation; chosen by hash of their id.
SAMPLE_PER_CLASS = 4000
EPOCHS = 15
COST = 1.0
# One in so many sampled documents fits the logistic curve.
CALIBRATION = 4
# Part of the median squared length that every document gets, so that a few n-grams say little.
FLOOR = 0.25


def features(text: str | None) -> np.ndarray:
    """Indicators of a whole text: buckets of its distinct n-grams, and how common the n-gram of a word
    and the same word is in it."""
    data = np.frombuffer((text or "").encode(), np.uint8).astype(np.uint32)
    found = []
    code = np.zeros(len(data), np.uint32)
    for n in range(1, max(GRAMS) + 1):
        if len(data) < n:
            break
        code = code[: len(data) - n + 1] * np.uint32(257) + data[n - 1 :] + np.uint32(1)
        if n in GRAMS:
            mixed = (code ^ np.uint32(n * 0x01000193)) * np.uint32(0x9E3779B1)
            found.append(mixed >> np.uint32(32 - 18))
    if not found:
        return np.zeros(0, np.int64)
    seen = np.zeros(WIDTH, bool)
    seen[np.concatenate(found)] = True
    words = text.split()
    doubled = sum(map(eq, words, islice(words, 1, None)))
    seen[BUCKETS:] = doubled * 2.0 ** np.arange(DOUBLED - 1, -1, -1) > len(words)
    return np.flatnonzero(seen)


def log_count_ratio(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Log of the smoothed share of each n-gram in class 1 against class 0."""
    counts = np.ones((2, WIDTH))
    for row, label in zip(rows, labels, strict=True):
        counts[int(label)][row] += 1
    shares = counts / counts.sum(axis=1, keepdims=True)
    return np.log(shares[1] / shares[0])


def scaled(row: np.ndarray, ratio: np.ndarray, floor: float) -> np.ndarray:
    """Scaled indicators of a document at about unit length."""
    x = ratio[row]
    return x / np.sqrt(x @ x + floor)


def dual_coordinate_descent(
    rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray, floor: float, seed: int = 0
) -> np.ndarray:
    """Weights (the last one is the bias) of the hinge-loss model on scaled indicators.

    Each class has the same total cost. Scaled values are made again at each step, as those of all documents
    would take several times the memory of the rows.
    """
    signs = np.where(labels == 1, 1.0, -1.0)
    share = np.array([np.mean(labels == label) for label in (0, 1)])
    cost = COST * 0.5 / share[labels.astype(int)]
    weights = np.zeros(WIDTH + 1)
    values = lambda row: np.append(scaled(row, ratio, floor), 1.0)
    squares = np.array([x @ x for x in map(values, rows)])
    alpha = np.zeros(len(rows))
    random = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in random.permutation(len(rows)):
            place, x = np.append(rows[i], WIDTH), values(rows[i])
            gradient = signs[i] * (weights[place] @ x) - 1.0
            new = min(max(alpha[i] - gradient / squares[i], 0.0), cost[i])
            if new != alpha[i]:
                weights[place] += (new - alpha[i]) * signs[i] * x
                alpha[i] = new
    return weights


def logistic_curve(margins: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the weighted logistic regression of labels on margins, by Newton steps on
    a slightly penalised loss, so that it exists for separable data too."""
    x = np.column_stack([margins, np.ones_like(margins)])
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weights * (p - labels)) + 0.1 * (beta - [1.0, 0.0])
        hessian = (x * (weights * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(max(beta[0], 1e-3)), float(beta[1])


def fit(sample: DataFrame, shares: dict[int, float]) -> tuple[np.ndarray, float, float, float]:
    """Log-count ratios and weights in one array, floor, slope and offset from a bounded sample.

    ``sample`` has doc_id, text and label; ``shares`` says which part of each class was sampled. One
    task fits the model. Rows are sorted first, so a repeated attempt gives the same.
    """

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, labels, held = [], [], []
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE).to_pydict()
                rows += [features(t).astype(np.int32) for t in part["text"]]
                labels += part["label"]
                held += part["held"]
        if not rows:
            return
        y, out = np.array(labels), np.array(held)
        fitted = np.flatnonzero(~out) if len(set(y[~out])) == 2 else np.arange(len(y))
        checked = np.flatnonzero(out) if len(set(y[out])) == 2 else np.arange(len(y))
        chosen = [rows[i] for i in fitted]
        ratio = log_count_ratio(chosen, y[fitted])
        floor = FLOOR * float(np.median([ratio[row] @ ratio[row] for row in chosen])) + 1e-9
        weights = dual_coordinate_descent(chosen, y[fitted], ratio, floor)
        margins = np.array(
            [scaled(rows[i], ratio, floor) @ weights[rows[i]] + weights[-1] for i in checked]
        )
        importance = np.array([1 / shares[int(y[i])] for i in checked])
        slope, offset = logistic_curve(margins, y[checked], importance * len(checked) / importance.sum())
        model = np.concatenate([ratio, weights]).astype("<f4").tobytes()
        yield pa.RecordBatch.from_pydict(
            {"model": pa.array([model], pa.binary()), "floor": [floor], "slope": [slope], "offset": [offset]}
        )

    held = F.pmod(F.xxhash64("doc_id", F.lit("calibration")), F.lit(CALIBRATION)) == 0
    rows = sample.select("doc_id", "text", "label", held.alias("held"))
    found = (
        rows.repartition(1)
        .sortWithinPartitions("doc_id", "label", F.xxhash64("text"))
        .mapInArrow(run, "model binary, floor double, slope double, offset double")
        .collect()
    )
    row = found[0]
    return np.frombuffer(row["model"], "<f4"), row["floor"], row["slope"], row["offset"]


def score_quality(docs: DataFrame, labels: DataFrame, sample_per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """Add ``score``, the probability that a document's label is 1, to every row of ``docs``.

    ``docs`` has doc_id and text; ``labels`` has doc_id and label (0 or 1), of which the fit reads
    about ``sample_per_class`` documents a class. Labels that are null or without a document, and
    rows with null ids, teach nothing; a document with both labels counts as 0. Null texts are
    empty, and an empty text has the score of the bias. With one class only, or no labels, the score is
    the same for all: the share of label 1, smoothed. Repeated rows are scored each, other columns kept,
    except ``score``, which is replaced.
    """
    known = (
        labels.filter("label IN (0, 1) AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("label").cast("int").alias("label"))
    )
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    constant = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    base = docs.drop("score")
    if len(counts) < 2:
        return base.withColumn("score", F.lit(constant))
    shares = {k: min(1.0, sample_per_class / n) for k, n in counts.items()}
    limit = F.when(F.col("label") == 1, int(shares[1] * 2**30)).otherwise(int(shares[0] * 2**30))
    chosen = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(2**30)) < limit)
    # About twice ``sample_per_class`` ids, whatever the size of the tables.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    if sample.select("label").distinct().count() < 2:
        return base.withColumn("score", F.lit(constant))
    packed, floor, slope, offset = fit(sample, shares)
    ratio, weights = packed[:WIDTH], packed[WIDTH:]
    # Weight of a plain indicator, and what it adds to the squared length.
    model = docs.sparkSession.sparkContext.broadcast(
        (np.append(ratio * weights[:-1], weights[-1]), ratio**2)
    )

    @tidy
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, squares = model.value
        bias = float(plain[-1])
        for batch in batches:
            scores = np.zeros(batch.num_rows)
            texts = batch.column("text")
            for at in range(0, batch.num_rows, SLICE):
                for k, text in enumerate(texts.slice(at, SLICE).to_pylist(), at):
                    row = features(text)
                    length = float(np.sqrt(squares[row].sum() + floor))
                    scores[k] = slope * (float(plain[row].sum()) / length + bias) + offset
            yield batch.append_column("score", pa.array(1 / (1 + np.exp(-np.clip(scores, -30, 30)))))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema)
    return base.mapInArrow(score, f"{schema}, score double")
