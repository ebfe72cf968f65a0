"""From step events to one row per material."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabgauge.functions.columns import (
    EVENT_REQUIRED_COLUMNS,
    MATERIAL_METADATA_COLUMNS,
    event_features,
    require_columns,
    statistic_columns,
)
from fabgauge.functions.rules import official_split

# Lineage of the material master.
MATERIAL_LINEAGE = {
    "feature_set_version": "st_awfd_material_retrospective_v1",
    "preprocessing_version": "m11_material_aggregation_v1",
    "aggregation_strategy": "retrospective_material_level_summary",
}
STATISTICS = ["mean", "std", "min", "max"]
# Aggregates per grouping that Spark still turns into code the JVM compiles well.
AGGREGATES_PER_GROUPING = 60


def _known(df: DataFrame) -> DataFrame:
    return df.where(F.col("MaterialID").isNotNull())


def distinct_steps(df: DataFrame) -> DataFrame:
    """The distinct steps in order: ``StepID``."""
    return df.select("StepID").where("StepID IS NOT NULL").distinct().orderBy("StepID")


def observed_steps(df: DataFrame) -> list:
    """Sorted distinct steps on the driver. They become columns, so they must fit a schema."""
    return [r.StepID for r in distinct_steps(df).collect()]


def base_aggregates() -> list[Column]:
    """Label, split and record count. Label and split are constant per material."""
    return [
        F.max("target").cast("int").alias("label_original"),
        F.max("target").cast("int").alias("label_binary"),
        official_split(F.max("is_test")).alias("official_split"),
        F.count(F.lit(1)).alias("source_record_count"),
    ]


def missing_share(column: str) -> Column:
    return (F.count(F.lit(1)) - F.count(column)) / F.count(F.lit(1))


def statistic(column: str, name: str) -> Column:
    functions = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    return functions[name](column).alias(f"{column}_{name}")


def duration_aggregates() -> list[Column]:
    return [
        *[statistic("duration_ms", s) for s in ("min", "max", "mean", "std")],
        missing_share("duration_ms").alias("duration_ms_missing_ratio"),
    ]


def feature_aggregates(features: Sequence[str]) -> list[Column]:
    return [
        *[statistic(f, s) for f in sorted(features) for s in STATISTICS],
        *[missing_share(f).alias(f"{f}_missing_ratio") for f in features],
    ]


def step_column(feature: str, step: object) -> str:
    return f"{feature}_step_{step}_mean"


def _by_step(df: DataFrame, aggregates: Sequence[Column]) -> DataFrame:
    """One row per material and step; steps stay rows, however many there are."""
    return _known(df).groupBy(F.col("MaterialID").alias("material_id"), "StepID").agg(*aggregates)


def _steps_by_material(df: DataFrame) -> DataFrame:
    """Base columns, the list of steps and the duration range, merged from the rows per step."""
    flags = [F.max(c).alias(c) for c in ("target", "is_test")]
    ends = [statistic("duration_ms", s) for s in ("min", "max")]
    per_step = _by_step(df, [*flags, F.count(F.lit(1)).alias("_records"), *ends])
    return per_step.groupBy("material_id").agg(
        *base_aggregates()[:-1],
        F.sum("_records").alias("source_record_count"),
        F.count("StepID").alias("step_count"),
        F.sort_array(F.collect_list("StepID")).alias("observed_step_ids"),
        F.min("duration_ms_min").alias("duration_ms_min"),
        F.max("duration_ms_max").alias("duration_ms_max"),
    )


def material_base(df: DataFrame) -> DataFrame:
    """Label, split, records and distinct steps per material."""
    return _steps_by_material(df).drop("observed_step_ids", "duration_ms_min", "duration_ms_max")


def material_duration_stats(df: DataFrame) -> DataFrame:
    return _by_material(df, duration_aggregates())


def material_feature_stats(df: DataFrame) -> DataFrame:
    return _by_material_packed(df, [feature_aggregates([f]) for f in event_features(df)])


def _by_material(df: DataFrame, aggregates: Sequence[Column]) -> DataFrame:
    grouped = _known(df).groupBy(F.col("MaterialID").alias("material_id"))
    return grouped.agg(*aggregates)


def _by_material_packed(df: DataFrame, blocks: Sequence[Sequence[Column]]) -> DataFrame:
    """Aggregate blocks of columns by material, several blocks per grouping while they fit.

    Each grouping reads its own columns and combines before its shuffle. The results are
    partitioned by material already, so laying them side by side adds no shuffle.
    """
    groupings: list[list[Column]] = []
    for block in blocks:
        if not groupings or len(groupings[-1]) + len(block) > AGGREGATES_PER_GROUPING:
            groupings.append([])
        groupings[-1] += block
    if not groupings:
        return _known(df).select(F.col("MaterialID").alias("material_id")).distinct()
    parts = [_by_material(df, aggregates) for aggregates in groupings]
    return reduce(lambda left, right: left.join(right, "material_id"), parts)


def means_by_step(df: DataFrame, features: Sequence[str], *others: Column) -> DataFrame:
    """The mean of each feature per material and step, with further aggregates first."""
    return _by_step(df, [*others, *[F.avg(f).alias(f) for f in features]])


def step_means(df: DataFrame, features: Sequence[str], steps: Sequence) -> DataFrame:
    """One column per feature and step with the mean; no value where a step did not occur.

    Means are taken per material and step and then turned with the known list of steps. They are dealt out by
    material first, so that no task holds its means and half-turned rows of nearly as many materials at once.
    """
    if not features or not steps:
        return _known(df).select(F.col("MaterialID").alias("material_id")).distinct()
    per_step = means_by_step(df, features).repartition("material_id").groupBy("material_id")
    columns = [(f, s) for f in features for s in steps]
    if len(columns) <= AGGREGATES_PER_GROUPING:
        # There is one mean at most, and a pivot would group by material and step again before it turns.
        return per_step.agg(
            *[F.max(F.when(F.col("StepID") == F.lit(s), F.col(f"`{f}`"))).alias(step_column(f, s)) for f, s in columns]
        )
    wide = per_step.pivot("StepID", list(steps)).agg(*[F.first(f).alias(f) for f in features])
    # Spark names a pivoted column by its step alone when there is one aggregate.
    name = (lambda s, f: str(s)) if len(features) == 1 else (lambda s, f: f"{s}_{f}")
    return wide.select("material_id", *[F.col(f"`{name(s, f)}`").alias(step_column(f, s)) for f, s in columns])


def material_master(
    df: DataFrame,
    dataset_id: str,
    sequence_manifest_path: str,
    lineage: Mapping[str, str] = MATERIAL_LINEAGE,
    steps: Sequence | None = None,
) -> DataFrame:
    """One row per material: metadata first, then duration, feature and step columns.

    The rows are read once for the steps, once for their means and once per grouping of
    feature statistics, so give it a columnar table.
    """
    require_columns(df, EVENT_REQUIRED_COLUMNS, "Event table")
    features = event_features(df)
    steps = observed_steps(df) if steps is None else list(steps)
    master = statistics_by_material(df, features).join(step_means(df, features, steps), "material_id")
    columns = [step_column(f, s) for f in features for s in steps]
    return stamped_master(master, features, columns, dataset_id, sequence_manifest_path, lineage)


def statistics_by_material(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Base, duration and feature columns of a material master, without its lineage."""
    blocks = [[*base_aggregates(), *duration_aggregates()]]
    blocks += [feature_aggregates([f]) for f in features]
    counts = material_base(df).select("material_id", "step_count")
    return _by_material_packed(df, blocks).join(counts, "material_id")


def stamped_master(
    master: DataFrame,
    features: Sequence[str],
    step_columns: Sequence[str],
    dataset_id: str,
    sequence_manifest_path: str,
    lineage: Mapping[str, str],
) -> DataFrame:
    """Add the lineage and put the columns in order: metadata, duration, features, steps."""
    stamped = master.withColumns(
        {
            "dataset_id": F.lit(dataset_id),
            **{name: F.lit(value) for name, value in lineage.items()},
            "sequence_manifest_path": F.lit(sequence_manifest_path),
        }
    )
    return stamped.select(
        *MATERIAL_METADATA_COLUMNS,
        *statistic_columns(["duration_ms"], ["min", "max", "mean", "std", "missing_ratio"]),
        *statistic_columns(features, STATISTICS),
        *[f"{f}_missing_ratio" for f in features],
        *step_columns,
    )


def sequence_manifest(df: DataFrame, dataset_id: str, raw_event_file_path: str) -> DataFrame:
    """One row per material with its sorted list of distinct steps."""
    manifest = _steps_by_material(df)
    return manifest.select(
        F.lit(dataset_id).alias("dataset_id"),
        *manifest.columns,
        F.to_json("observed_step_ids").alias("observed_step_ids_json"),
        F.lit(raw_event_file_path).alias("raw_event_file_path"),
        F.lit(True).alias("sequence_available"),
    )


def material_metadata(
    master: DataFrame, features: Sequence[str], steps: Sequence
) -> DataFrame:
    """Counts that describe a material master, one row per dataset."""
    split, label = F.col("official_split"), F.col("label_binary")
    return master.groupBy("dataset_id").agg(
        F.count(F.lit(1)).alias("material_master_row_count"),
        F.sum("source_record_count").alias("source_record_count"),
        F.lit(len(features)).cast("long").alias("numeric_feature_count"),
        F.lit(len(steps)).cast("long").alias("observed_step_count"),
        F.count_if(split == "train").alias("train_material_count"),
        F.count_if(split == "test").alias("test_material_count"),
        F.count_if(label == 0).alias("label_0_count"),
        F.count_if(label == 1).alias("label_1_count"),
    )
