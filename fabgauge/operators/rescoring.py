"""Scores of rows in which one feature takes another value, from what the change touches.

A model sees a row as an array of prepared values (imputed and scaled, in feature order). Preparation works
on each feature alone, so a prepared value can be replaced as well as a raw one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fabgauge.operators import forest
from fabgauge.operators.evaluate import SCORE
from fabgauge.session import ensure_checkpoint_dir

VALUES, OTHER, MARGIN = "_values", "_other", "_margin"
# Rows that are walked through a tree at a time.
FOREST_ROWS = 4096


class Rescorer(Protocol):
    def inputs(self, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
        """``keep``, the array ``_values`` and whatever of the score is worth keeping."""

    def scores(self, inputs: DataFrame, keep: Sequence[str]) -> DataFrame:
        """``keep`` and the score of the rows as they are."""

    def changed(self, pairs: DataFrame, keep: Sequence[str]) -> DataFrame:
        """``keep``, ``_at`` and the score with the feature number ``_at`` taken from ``_other``, for
        each feature."""


def prepared(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """The rows with the inputs of the classifier as an array."""
    stages = model.preparation if isinstance(model, forest.GrownForest) else model.stages[:-1]
    ready = PipelineModel(stages).transform(rows)
    return ready.withColumn(VALUES, vector_to_array("_features"))


@dataclass(frozen=True)
class LinearRescorer:
    """A sum of weighted values, as a probability if ``logistic``: a replaced value moves the old
    margin by its weight times the difference."""

    features: Sequence[str]
    weights: Sequence[float]
    intercept: float = 0.0
    logistic: bool = False
    model: PipelineModel | None = None

    @classmethod
    def of(cls, model: PipelineModel, features: Sequence[str]) -> LinearRescorer:
        fitted = model.stages[-1]
        return cls(features, fitted.coefficients.toArray().tolist(), float(fitted.intercept), True, model)

    def _weights(self) -> Column:
        return F.lit([float(w) for w in self.weights])

    def _score(self, margin: Column) -> Column:
        return 1 / (1 + F.exp(-margin)) if self.logistic else margin

    def inputs(self, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
        if self.model is not None:
            ready = prepared(self.model, rows)
        else:
            ready = rows.withColumn(VALUES, F.array(*[F.col(f).cast("double") for f in self.features]))
        products = F.zip_with(VALUES, self._weights(), lambda v, w: v * w)
        margin = F.aggregate(products, F.lit(float(self.intercept)), lambda total, p: total + p)
        return ready.select(*keep, VALUES, margin.alias(MARGIN))

    def scores(self, inputs: DataFrame, keep: Sequence[str]) -> DataFrame:
        return inputs.select(*keep, self._score(F.col(MARGIN)).alias(SCORE))

    def changed(self, pairs: DataFrame, keep: Sequence[str]) -> DataFrame:
        moves = F.zip_with(
            F.zip_with(VALUES, OTHER, lambda old, new: new - old), self._weights(), lambda d, w: d * w
        )
        scores = F.transform(moves, lambda move: self._score(F.col(MARGIN) + move))
        return pairs.select(*keep, F.posexplode(scores).alias("_at", SCORE))


@dataclass(frozen=True)
class ForestRescorer:
    """A random forest, whose trees are read from its saved nodes, some at a time."""

    groups: Sequence[Broadcast]
    model: PipelineModel

    @classmethod
    def of(cls, model: PipelineModel) -> ForestRescorer:
        if isinstance(model, forest.GrownForest):
            return cls(model.groups(), model)
        spark = SparkSession.active()
        ensure_checkpoint_dir(spark)
        folder = f"{spark.sparkContext.getCheckpointDir()}/forest-{uuid.uuid4().hex}"
        model.stages[-1].write().save(folder)
        return cls(forest.tree_groups(spark.read.parquet(f"{folder}/data")), model)

    def inputs(self, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
        return prepared(self.model, rows).select(*keep, VALUES)

    def scores(self, inputs: DataFrame, keep: Sequence[str]) -> DataFrame:
        scored = self._mapped(inputs.select(*keep, VALUES), keep, 1)
        return scored.select(*keep, scored["_scores"][0].alias(SCORE))

    def changed(self, pairs: DataFrame, keep: Sequence[str]) -> DataFrame:
        scored = self._mapped(pairs.select(*keep, VALUES, OTHER), keep, 2)
        return scored.select(*keep, F.posexplode("_scores").alias("_at", SCORE))

    def _mapped(self, rows: DataFrame, keep: Sequence[str], arrays: int) -> DataFrame:
        groups, kept = self.groups, len(keep)

        def matrix(column: pa.Array, count: int) -> np.ndarray:
            return column.flatten().to_numpy(zero_copy_only=False).reshape(count, -1)

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, batch.num_rows, FOREST_ROWS):
                    part = batch.slice(start, FOREST_ROWS)
                    values = [matrix(c, part.num_rows) for c in part.columns[kept:]]
                    if arrays == 1:
                        scores = forest.scores(groups, values[0])[:, None]
                    else:
                        scores = forest.changed_scores(groups, *values)
                    offsets = np.arange(part.num_rows + 1, dtype=np.int32) * scores.shape[1]
                    column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(scores.ravel()))
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns[:kept], column], names=[*part.schema.names[:kept], "_scores"]
                    )

        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:kept])
        return rows.mapInArrow(score, f"{schema}, _scores array<double>")
