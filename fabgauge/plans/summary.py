"""Summary tables over the results of all stages.

Small tables come as ``item, name, value`` rows, so that one shape holds counts, ratios and
distributions; the integrated document nests them in one row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabgauge.operators.evaluate import (
    best_f2,
    best_model,
    false_negative_counts,
    operating_point,
)
from fabgauge.operators.explain import consistent_features
from fabgauge.operators.profile import top_missing


def _items(df: DataFrame, item: str, name: Column, value: Column) -> DataFrame:
    return df.select(
        F.lit(item).alias("item"), name.cast("string").alias("name"), value.cast("double").alias("value")
    )


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def columns_as_items(row: DataFrame, item: str) -> DataFrame:
    """A one-row table turned into one item per column."""
    cells = [
        F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value"))
        for c in row.columns
    ]
    return row.select(F.lit(item).alias("item"), F.inline(F.array(*cells)))


def rows_as_items(table: DataFrame, item: str, key: str) -> DataFrame:
    """Whole rows as items: one per column, named after the row's key and the column."""
    cells = [
        F.struct(F.lit(c).alias("_column"), F.col(c).cast("double").alias("value"))
        for c in table.columns
        if c != key
    ]
    long = table.select(key, F.inline(F.array(*cells)))
    return _items(long, item, F.concat_ws(".", key, "_column"), F.col("value"))


def summary_profile(missing: DataFrame, labels: DataFrame, n: int = 10) -> DataFrame:
    """Label counts, feature and missing totals, and the features with most missing values."""
    totals = missing.agg(
        F.count(F.lit(1)).alias("feature_count"),
        F.coalesce(F.sum("missing_count"), F.lit(0)).alias("total_missing_values"),
    )
    return _union(
        [
            _items(labels, "label_distribution", F.col("label"), F.col("count")),
            columns_as_items(totals, "totals"),
            _items(
                top_missing(missing, n),
                "top_missing_features",
                F.col("feature"),
                F.col("missing_ratio"),
            ),
        ]
    )


def summary_quality(quality: DataFrame) -> DataFrame:
    """Features per action and per bucket that occur, all features, dropped constants."""

    def counts(column: str) -> DataFrame:
        groups = quality.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        return _items(groups, f"{column}_counts", F.col(column), F.col("n"))

    totals = quality.agg(
        F.count(F.lit(1)).alias("feature_count"),
        F.count_if(
            F.col("is_constant") & (F.col("recommended_action") == "drop_candidate")
        ).alias("constant_drop_candidates"),
    )
    return _union(
        [counts("recommended_action"), counts("missing_bucket"), columns_as_items(totals, "totals")]
    )


def summary_features(metadata: DataFrame) -> DataFrame:
    """Feature counts, split sizes and strategy from the feature-set document."""
    return metadata.select(
        "original_feature_count",
        "drop_candidate_feature_count",
        "kept_feature_count",
        "review_feature_count_included",
        "final_feature_count",
        "split.train_row_count",
        "split.test_row_count",
        F.col("imputation.strategy").alias("imputation_strategy"),
        "leakage_prevention_note",
    )


def summary_master(table: DataFrame, selected_feature_count: int) -> DataFrame:
    """One row per version stamp with sizes and label counts per split."""
    versions = [
        "feature_set_version",
        "quality_rule_version",
        "preprocessing_version",
        "imputation_strategy",
    ]
    split, label = F.col("split"), F.col("label_binary")
    cells = {
        f"{part}_label_{value}_count": F.count_if((split == part) & (label == value))
        for part in ("train", "test")
        for value in (0, 1)
    }
    return table.groupBy(*versions).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.lit(selected_feature_count).cast("long").alias("selected_feature_count"),
        F.count_if(split == "train").alias("train_row_count"),
        F.count_if(split == "test").alias("test_row_count"),
        *[e.alias(n) for n, e in cells.items()],
    )


def summary_models(metrics: DataFrame) -> DataFrame:
    """Metrics and counts per model, the best by average precision marked."""
    best = best_model(metrics).select("model_name", F.lit(True).alias("is_best"))
    return metrics.join(best, "model_name", "left").withColumn(
        "is_best", F.coalesce("is_best", F.lit(False))
    )


def summary_thresholds(
    metrics: DataFrame, top_risk_count: DataFrame, missed: DataFrame
) -> DataFrame:
    """Grid size, each model's whole row at 0.5 and at the best F2, missed defects at both, row counts."""
    totals = metrics.agg(F.count_distinct("threshold").alias("threshold_count")).select(
        "threshold_count",
        top_risk_count.scalar().alias("top_risk_sample_count"),
        missed.agg(F.count(F.lit(1))).scalar().alias("false_negative_rows"),
    )
    kind = F.concat_ws(".", "model_name", "threshold_type")
    return _union(
        [
            columns_as_items(totals, "totals"),
            _items(operating_point(metrics), "default_f2", F.col("model_name"), F.col("f2")),
            rows_as_items(operating_point(metrics), "default_row", "model_name"),
            rows_as_items(best_f2(metrics), "best_row", "model_name"),
            _items(best_f2(metrics), "best_f2", F.col("model_name"), F.col("f2")),
            _items(best_f2(metrics), "best_threshold", F.col("model_name"), F.col("threshold")),
            _items(false_negative_counts(missed), "false_negatives", kind, F.col("count")),
        ]
    )


def summary_explain(
    importance: DataFrame, top: DataFrame, profile: DataFrame, n: int = 20
) -> DataFrame:
    """Row counts, importance types, profiled groups, the top lists and the features they share.

    A row of a top list has its place as value, the same row in ``top_importance`` its importance.
    """

    def counts(table: DataFrame, column: str, item: str) -> DataFrame:
        groups = table.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
        return _items(groups, item, F.col(column), F.col("n"))

    shared = consistent_features(top, more_than=0).limit(n)
    listed = top.where(F.col("rank") <= n)
    place = F.concat_ws(".", "model_name", "importance_type", "feature")
    return _union(
        [
            columns_as_items(
                importance.agg(F.count(F.lit(1)).alias("importance_row_count")), "totals"
            ),
            columns_as_items(profile.agg(F.count(F.lit(1)).alias("profile_row_count")), "totals"),
            counts(importance, "importance_type", "importance_types"),
            counts(profile, "group_name", "error_profile_groups"),
            _items(listed, "top_features", place, F.col("rank")),
            _items(listed, "top_importance", place, F.col("importance")),
            _items(shared, "consistent_top_features", F.col("feature"), F.col("top_list_count")),
        ]
    )


def _rows(df: DataFrame) -> Column:
    """A small table as one sorted array of structs."""
    return df.agg(F.sort_array(F.collect_list(F.struct(*df.columns)))).scalar()


def quality_summary(
    sections: Mapping[str, DataFrame], project_name: str, dataset_name: str
) -> DataFrame:
    """All summary tables in one document, one array per section."""
    spark = next(iter(sections.values())).sparkSession
    return spark.range(1).select(
        F.lit(project_name).alias("project_name"),
        F.lit(dataset_name).alias("dataset_name"),
        F.date_trunc("second", F.current_timestamp()).alias("generated_at_utc"),
        *[_rows(table).alias(name) for name, table in sections.items()],
    )


def material_comparison(metadata: Sequence[DataFrame]) -> DataFrame:
    """Material counts of separately built masters side by side."""
    return _union(list(metadata))


def model_comparison(metrics: Sequence[DataFrame]) -> DataFrame:
    """Model metrics of separately trained datasets side by side."""
    columns = [
        "dataset_id",
        "model_name",
        "accuracy",
        "precision",
        "recall",
        "f1",
        "f2",
        "average_precision",
        "roc_auc",
        "false_negative",
        "false_positive",
    ]
    return _union([m.select(*columns) for m in metrics])


def baseline_feature_metadata(
    master: DataFrame, features: Sequence[str], threshold: float = 0.5
) -> DataFrame:
    """Features, split sizes, label counts and strategies, one row per dataset."""
    split, label = F.col("official_split"), F.col("label_binary")
    sizes = master.groupBy("dataset_id").agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.count_if(split == part).alias(f"{part}_row_count") for part in ("train", "test")],
        *[
            F.count_if((split == part) & (label == value)).alias(f"{part}_label_{value}_count")
            for part in ("train", "test")
            for value in (0, 1)
        ],
        F.count_distinct(F.when(split == "train", label)).alias("train_class_count"),
    )
    # Names of the strategies.
    strategies = {
        "imputation_strategy": "median_fit_on_official_train_only",
        "scaling_strategy": (
            "standard_scaler_fit_on_official_train_only_for_logistic_regression"
        ),
        "random_forest_scaling": "not_applied",
    }
    return sizes.select(
        "dataset_id",
        F.lit(len(features)).cast("long").alias("selected_feature_count"),
        F.lit(list(features)).alias("selected_feature_columns"),
        *sizes.columns[1:],
        *[F.lit(v).alias(k) for k, v in strategies.items()],
        F.lit(float(threshold)).alias("default_threshold"),
    )
