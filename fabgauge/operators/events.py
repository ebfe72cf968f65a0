"""Profiles of an event table with many rows per material."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabgauge.functions.columns import (
    EVENT_REQUIRED_COLUMNS,
    column_catalog,
    require_columns,
    sequence_features,
)
from fabgauge.functions.rules import coerce_numeric, missing_as_label
from fabgauge.operators.contracts import several_values
from fabgauge.operators.profile import duplicate_rows


def missing_counts(df: DataFrame) -> DataFrame:
    """Missing values of every column: ``column_name, missing_count``."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return row.unpivot([], list(df.columns), "column_name", "missing_count")


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """``value, count`` with values as text and missing ones named."""
    return df.groupBy(missing_as_label(F.col(column)).alias("value")).agg(
        F.count(F.lit(1)).alias("count")
    )


def _per_material(df: DataFrame) -> DataFrame:
    """One row per material; rows without an id count as one more material.

    Every aggregate combines before the shuffle, so a material with most of the rows is
    no heavier there than any other.
    """
    return df.groupBy("MaterialID").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(several_values(F.col("target")), F.lit(False)).alias("mixed_target"),
        F.coalesce(several_values(F.col("is_test")), F.lit(False)).alias("mixed_is_test"),
    )


def row_count_statistics(rows: Column, materials: Column) -> list[Column]:
    # n different row counts need at least n * (n + 1) / 2 rows, so the percentile buffer
    # over (row count, number of materials) stays small for any table.
    def quantile(share: float) -> Column:
        return F.coalesce(F.percentile(rows, share, materials), F.lit(0.0))

    total = F.sum(rows * materials).cast("double")
    return [
        F.coalesce(F.min(rows).cast("double"), F.lit(0.0)).alias("min"),
        F.coalesce(F.max(rows).cast("double"), F.lit(0.0)).alias("max"),
        F.coalesce(F.try_divide(total, F.sum(materials)), F.lit(0.0)).alias("mean"),
        quantile(0.5).alias("median"),
        quantile(0.25).alias("p25"),
        quantile(0.75).alias("p75"),
    ]


def rows_per_material(df: DataFrame) -> DataFrame:
    """Distribution of rows per material: ``min, max, mean, median, p25, p75``."""
    materials = df.groupBy("MaterialID").agg(F.count(F.lit(1)).alias("rows"))
    histogram = materials.groupBy("rows").agg(F.count(F.lit(1)).alias("materials"))
    return histogram.agg(*row_count_statistics(F.col("rows"), F.col("materials")))


def material_count(df: DataFrame) -> DataFrame:
    """``row_count, column_count, unique_material_id_count``."""
    materials = df.groupBy("MaterialID").agg(F.count(F.lit(1)).alias("n"))
    return materials.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.lit(len(df.columns)).cast("long").alias("column_count"),
        F.count(F.lit(1)).alias("unique_material_id_count"),
    )


def mixed_material_counts(df: DataFrame) -> DataFrame:
    """Materials whose target or split flag changes between rows, and whether none does."""
    return _per_material(df).agg(
        F.count_if("mixed_target").alias("mixed_target_material_id_count"),
        F.count_if("mixed_is_test").alias("mixed_is_test_material_id_count"),
        (F.count_if("mixed_target") == 0).alias("target_consistent_by_material_id"),
        (F.count_if("mixed_is_test") == 0).alias("is_test_consistent_by_material_id"),
    )


def duration_range(df: DataFrame) -> DataFrame:
    """``min, max, missing_count`` of the duration read as a number."""
    duration = coerce_numeric(F.col("duration_ms"))
    return df.agg(
        F.min(duration).alias("min"),
        F.max(duration).alias("max"),
        F.count_if(duration.isNull()).alias("missing_count"),
    )


def event_duplicates(df: DataFrame) -> DataFrame:
    return duplicate_rows(df, ignore=())


def _as_map(counts: DataFrame, key: str, value: str) -> Column:
    entries = F.sort_array(F.collect_list(F.struct(key, value)))
    return counts.agg(F.map_from_entries(entries)).scalar()


def event_profile(df: DataFrame, dataset_id: str, file_path: str) -> DataFrame:
    """The whole profile as one row of 19 fields, with maps and structs for the distributions."""
    require_columns(df, EVENT_REQUIRED_COLUMNS, "Event table")
    types = F.create_map(*[F.lit(part) for pair in column_catalog(df) for part in pair])
    materials = _per_material(df)
    by_size = materials.groupBy(F.col("row_count").alias("rows")).agg(
        F.count(F.lit(1)).alias("materials"),
        F.count_if("mixed_target").alias("mixed_target"),
        F.count_if("mixed_is_test").alias("mixed_is_test"),
    )
    sizes = by_size.agg(
        F.struct(*row_count_statistics(F.col("rows"), F.col("materials"))).alias("sizes"),
        F.coalesce(F.sum(F.col("rows") * F.col("materials")), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum("materials"), F.lit(0)).alias("materials"),
        F.coalesce(F.sum("mixed_target"), F.lit(0)).alias("mixed_target"),
        F.coalesce(F.sum("mixed_is_test"), F.lit(0)).alias("mixed_is_test"),
    )
    duration = duration_range(df)
    return sizes.select(
        F.lit(dataset_id).alias("dataset_id"),
        F.lit(file_path).alias("file_path"),
        "row_count",
        F.lit(len(df.columns)).cast("long").alias("column_count"),
        F.lit(list(df.columns)).alias("column_names"),
        types.alias("dtypes"),
        F.lit(EVENT_REQUIRED_COLUMNS).alias("required_reference_columns"),
        F.lit(sequence_features(df.columns)).alias("feature_columns"),
        F.col("materials").alias("unique_material_id_count"),
        _as_map(value_counts(df, "target"), "value", "count").alias("target_distribution"),
        (F.col("mixed_target") == 0).alias("target_consistent_by_material_id"),
        (F.col("mixed_is_test") == 0).alias("is_test_consistent_by_material_id"),
        _as_map(value_counts(df, "StepID"), "value", "count").alias("step_id_distribution"),
        F.col("sizes").alias("material_id_row_count_distribution"),
        duration.select(F.struct(*duration.columns)).scalar().alias("duration_ms"),
        _as_map(missing_counts(df), "column_name", "missing_count").alias("missing_value_counts"),
        event_duplicates(df).scalar().alias("duplicate_full_row_count"),
        F.col("mixed_target").alias("mixed_target_material_id_count"),
        F.col("mixed_is_test").alias("mixed_is_test_material_id_count"),
    )


def top_missing_columns(counts: DataFrame, n: int = 20) -> DataFrame:
    return counts.orderBy(F.desc("missing_count"), "column_name").limit(n)


def top_steps(counts: DataFrame, n: int = 20) -> DataFrame:
    return counts.orderBy(F.desc("count"), "value").limit(n)


def feature_union(*tables: DataFrame) -> list[str]:
    """Sorted names of the measurement columns found in any of the event tables."""
    return sorted({name for t in tables for name in sequence_features(t.columns)})


def design_decision(profiles: DataFrame) -> DataFrame:
    """May target and split be set per material? One row over all dataset profiles."""
    counts = F.sort_array(
        F.collect_list(
            F.struct(
                "dataset_id",
                "mixed_target_material_id_count",
                "mixed_is_test_material_id_count",
            )
        )
    )
    names = F.array_sort(F.array_distinct(F.flatten(F.collect_list("feature_columns"))))
    return profiles.agg(
        F.bool_and("target_consistent_by_material_id").alias("target_safe"),
        F.bool_and("is_test_consistent_by_material_id").alias("is_test_safe"),
        F.sum("mixed_target_material_id_count").alias("mixed_target_materials"),
        F.sum("mixed_is_test_material_id_count").alias("mixed_is_test_materials"),
        counts.alias("per_dataset"),
        names.alias("feature_columns"),
    )
