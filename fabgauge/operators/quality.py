"""Feature grades: keep, review or drop."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabgauge.functions.columns import require_columns, sensor_columns
from fabgauge.functions.rules import (
    MISSING_BUCKETS,
    RECOMMENDED_ACTIONS,
    SELECTED_ACTIONS,
    missing_bucket,
    recommended_action,
    safe_ratio,
)
from fabgauge.operators.profile import column_facts, melt, per_feature
from fabgauge.session import pin


def _graded(counts: DataFrame, constant: Column, *more: str) -> DataFrame:
    missing = F.col("rows") - F.col("non_null_count")
    ratio = safe_ratio(missing, F.col("rows"))
    return counts.select(
        "feature",
        missing.alias("missing_count"),
        ratio.alias("missing_ratio"),
        "non_null_count",
        *more,
        constant.alias("is_constant"),
        missing_bucket(ratio).alias("missing_bucket"),
        recommended_action(constant, ratio).alias("recommended_action"),
    )


def feature_grades(df: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """Missing counts, constancy, bucket and action per sensor, without counting distinct values.

    A sensor is constant if its least value is its greatest, so one row per task is all that moves.
    """
    names = sensor_columns(df) if features is None else list(features)
    facts = {"non_null_count": F.count, "one_value": lambda c: F.min(c) == F.max(c)}
    counts = column_facts(df, names, facts)
    return _graded(counts, F.coalesce("one_value", F.lit(True)))


def feature_quality(df: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """The grades with the exact number of distinct values per sensor.

    The first grouping is by feature and value and combines before its shuffle, so it spreads
    over all tasks even with few sensors; the second one adds up one row per feature and task. Where
    only grades are needed, ``feature_grades`` does without both.
    """
    names = sensor_columns(df) if features is None else list(features)
    values = melt(df, names).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    present = F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0))
    counts = values.groupBy("feature").agg(
        F.sum("n").alias("rows"),
        present.alias("non_null_count"),
        F.count("value").alias("unique_non_null_count"),
    )
    counts = per_feature(df, names, counts).fillna(0)
    return _graded(counts, F.col("unique_non_null_count") <= 1, "unique_non_null_count")


def counts_on_domain(df: DataFrame, column: str, domain: Sequence[str]) -> DataFrame:
    """``column, feature_count`` for every value of a fixed list, 0 where none occurs."""
    totals = df.agg(*[F.count_if(F.col(column) == v).alias(v) for v in domain])
    return totals.unpivot([], list(domain), column, "feature_count")


def action_counts(quality: DataFrame) -> DataFrame:
    return counts_on_domain(quality, "recommended_action", RECOMMENDED_ACTIONS)


def bucket_counts(quality: DataFrame) -> DataFrame:
    return counts_on_domain(quality, "missing_bucket", MISSING_BUCKETS)


def quality_counts(quality: DataFrame, selected: Sequence[str] | None = None) -> DataFrame:
    """One row of totals; review features count only if they were selected."""
    action = F.col("recommended_action")
    review = action == "review"
    if selected is not None:
        review = review & F.col("feature").isin(list(selected))
    return quality.agg(
        F.count(F.lit(1)).alias("original_feature_count"),
        F.count_if(action == "drop_candidate").alias("drop_candidate_feature_count"),
        F.count_if(action == "keep").alias("kept_feature_count"),
        F.count_if(review).alias("review_feature_count_included"),
    )


def constant_drops(quality: DataFrame) -> DataFrame:
    """How many features are dropped for being constant: ``constant_drop_candidates``."""
    return quality.agg(
        F.count_if(
            F.col("is_constant") & (F.col("recommended_action") == "drop_candidate")
        ).alias("constant_drop_candidates")
    )


def drop_candidates(quality: DataFrame, n: int = 20) -> DataFrame:
    return (
        quality.where(F.col("recommended_action") == "drop_candidate")
        .orderBy(F.desc("is_constant"), F.desc("missing_ratio"), "feature")
        .limit(n)
    )


def review_candidates(quality: DataFrame, n: int = 20) -> DataFrame:
    return (
        quality.where(F.col("recommended_action") == "review")
        .orderBy(F.desc("missing_ratio"), "feature")
        .limit(n)
    )


def selected_features(df: DataFrame, quality: DataFrame) -> list[str]:
    """Sensors graded keep or review, in table order; at most one name per column."""
    require_columns(quality, ["feature", "recommended_action"], "Feature quality summary")
    chosen = {
        r.feature
        for r in quality.where(F.col("recommended_action").isin(SELECTED_ACTIONS))
        .select("feature")
        .where(F.col("feature").isin(sensor_columns(df)))
        .collect()
    }
    return [c for c in sensor_columns(df) if c in chosen]


def selected_values(long: DataFrame, quality: DataFrame) -> DataFrame:
    """Long-form rows of the features graded keep or review."""
    wanted = quality.where(F.col("recommended_action").isin(SELECTED_ACTIONS))
    return long.join(pin(wanted.select("feature")), "feature", "left_semi")
