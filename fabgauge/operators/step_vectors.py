"""Step means as one sparse vector per material, for any number of steps.

``materials.step_means`` makes a column per feature and step, so its steps must fit a schema. Here a
pair of feature and step is a row of a table of positions, and a material holds only the means it has.
A mean is stored as its difference from the median over the train materials, divided by the deviation
that the column would have after filling with that median. A pair a material lacks is therefore 0, which
is what filling and scaling a column gives up to a constant that a model's intercept takes over.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabgauge.functions.columns import EVENT_REQUIRED_COLUMNS, event_features, require_columns
from fabgauge.functions.rules import official_split
from fabgauge.operators.materials import (
    MATERIAL_LINEAGE,
    means_by_step,
    stamped_master,
    statistics_by_material,
)
from fabgauge.operators.ordered import exact_median, with_rank
from fabgauge.session import pin

STEP_VECTOR = "step_means"


@dataclass
class SparseMaster:
    """A material master with a vector column, and what its positions mean."""

    table: DataFrame
    positions: DataFrame


def step_entries(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Means as rows: ``material_id, official_split, StepID, feature, value``.

    Rows without material or step and means without any value are left out. The split comes from the
    rows of the step, so it must be constant per material, as ``readers.check_events`` demands.
    """
    keys = ["material_id", "official_split", "StepID"]
    rows = means_by_step(df, features, official_split(F.max("is_test")).alias("official_split"))
    rows = rows.where("StepID IS NOT NULL")
    if not features:
        return rows.selectExpr(*keys, "'' AS feature", "0D AS value").where("false")
    cells = [
        F.struct(F.lit(f).alias("feature"), F.col(f"`{f}`").cast("double").alias("value"))
        for f in features
    ]
    return rows.select(*keys, F.inline(F.array(*cells))).where("value IS NOT NULL")


def fit_positions(entries: DataFrame, train_materials: int, features: Sequence[str]) -> DataFrame:
    """``feature, StepID, position, median, scale`` of each pair with a train value, as a pinned table.

    Positions count from 0 by the order of the features, then by step. The scale is the population
    deviation over all train materials, those without the pair counted at its median; 1 where it is 0.
    """
    pair = ["feature", "StepID"]
    train = entries.where(F.col("official_split") == "train").select(*pair, "value")
    medians = exact_median(train, pair, "value").select(*pair, "median")
    away = train.join(medians, pair).withColumn("_away", F.col("value") - F.col("median"))
    mean = F.sum("_away") / train_materials
    variance = F.sum(F.col("_away") * F.col("_away")) / train_materials - mean * mean
    order = F.array_position(F.lit(list(features) or [""]), F.col("feature"))
    fitted = pin(
        away.groupBy(*pair, "median")
        .agg(F.when(variance > 0, F.sqrt(variance)).otherwise(1.0).alias("scale"))
        .withColumn("_feature", order)
    )
    ranked = with_rank(fitted, [], "_feature", "StepID", descending=False, name="_rank")
    position = (F.col("_rank") - 1).cast("int").alias("position")
    return pin(ranked.select(*pair, position, "median", "scale"))


def step_cells(entries: DataFrame, positions: DataFrame) -> DataFrame:
    """``material_id, positions, values``: the scaled means of a material by ascending position.

    Pairs without a train value have no position and are left out, as a column without one would be.
    """
    value = ((F.col("value") - F.col("median")) / F.col("scale")).alias("value")
    placed = entries.join(positions, ["feature", "StepID"]).select("material_id", "position", value)
    cells = F.sort_array(F.collect_list(F.struct("position", "value")))
    grouped = placed.groupBy("material_id").agg(cells.alias("_cells"))
    return grouped.select(
        "material_id",
        F.col("_cells.position").alias("positions"),
        F.col("_cells.value").alias("values"),
    )


def sparse_vector(size: int):
    """A function of positions and values; NULL lists give the vector without entries."""

    @F.udf(VectorUDT())
    def vector(positions, values):
        return SparseVector(size, positions or [], values or [])

    return vector


def fitted_steps(df: DataFrame, features: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The entries of an event table and the positions fitted on its train materials, both pinned."""
    entries = pin(step_entries(df, features))
    material = F.col("MaterialID")
    train = df.where(material.isNotNull()).groupBy(material).agg(F.max("is_test").alias("is_test"))
    count = train.where(official_split(F.col("is_test")) == "train").count()
    return entries, fit_positions(entries, count, features)


def sparse_material_master(
    df: DataFrame,
    dataset_id: str,
    sequence_manifest_path: str,
    lineage: Mapping[str, str] = MATERIAL_LINEAGE,
) -> SparseMaster:
    """One row per material with its metadata, duration and feature columns and one vector of step means.

    Steps are never columns and never on the driver, only the number of positions is. Train with
    ``models.train_and_evaluate(master.table, vectors=[STEP_VECTOR])``.
    """
    require_columns(df, EVENT_REQUIRED_COLUMNS, "Event table")
    features = event_features(df)
    entries, positions = fitted_steps(df, features)
    vector = sparse_vector(positions.count())("positions", "values").alias(STEP_VECTOR)
    rows = statistics_by_material(df, features).join(
        step_cells(entries, positions), "material_id", "left"
    )
    master = rows.select(*[c for c in rows.columns if c not in ("positions", "values")], vector)
    return SparseMaster(
        stamped_master(master, features, [STEP_VECTOR], dataset_id, sequence_manifest_path, lineage),
        positions,
    )
