"""Wide branch: from graded sensors to the modeling master table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabgauge.functions.columns import WIDE_LINEAGE_COLUMNS, require_columns
from fabgauge.functions.rules import binary_label
from fabgauge.operators.contracts import assert_labels
from fabgauge.operators.impute import fill, fit_medians
from fabgauge.operators.quality import quality_counts, selected_features
from fabgauge.operators.split import stratified_split
from fabgauge.session import together

# Lineage of the modeling master table.
WIDE_LINEAGE = {
    "feature_set_version": "m3_5_feature_set_v1",
    "quality_rule_version": "m2_quality_rules_v1",
    "preprocessing_version": "m3_5_preprocessing_v1",
    "imputation_strategy": "median_train_only",
}
FEATURE_SET_IMPUTATION = "median"
LEAKAGE_NOTE = "Test rows are filled with the medians of the training rows; no median has seen a test row."
SPLIT_METHOD = "stratified_train_test_split"


@dataclass
class Master:
    """A master table with what was fitted to build it."""

    table: DataFrame
    features: list[str]
    medians: dict[str, float]


def stamp_lineage(df: DataFrame, lineage: Mapping[str, str] = WIDE_LINEAGE) -> DataFrame:
    """Add the version columns and put all lineage columns first."""
    stamped = df.withColumns({name: F.lit(value) for name, value in lineage.items()})
    rest = [c for c in stamped.columns if c not in WIDE_LINEAGE_COLUMNS]
    return stamped.select(*WIDE_LINEAGE_COLUMNS, *rest)


def label_rows(df: DataFrame, accept_zero: bool = False) -> DataFrame:
    """Replace ``label`` by ``label_original`` and its 0/1 form ``label_binary``."""
    label = F.col("label")
    return df.withColumns(
        {"label_original": label, "label_binary": binary_label(label, accept_zero)}
    ).drop("label")


def build_master(
    df: DataFrame,
    quality: DataFrame,
    test_size: float = 0.2,
    seed: int = 42,
    lineage: Mapping[str, str] = WIDE_LINEAGE,
) -> Master:
    """Select graded sensors, normalize labels, split, impute with train medians, add lineage.

    The wide rows are never shuffled: grades, split limits and medians come from narrow or
    pre-aggregated passes, and the table itself is one map over the input.
    """
    require_columns(df, ["sample_id", "label"], "Sensor table")
    assert_labels(df, "label")
    labelled = label_rows(df)
    if "timestamp" not in labelled.columns:
        labelled = labelled.withColumn("timestamp", F.lit(None).cast("string"))
    features, split = together(
        lambda: selected_features(df, quality),
        lambda: stratified_split(labelled, "label_binary", "sample_id", test_size, seed),
    )
    medians = fit_medians(split, features)
    keys = ["sample_id", "timestamp", "label_original", "label_binary", "split"]
    table = fill(split.select(*keys, *features), medians)
    return Master(stamp_lineage(table, lineage), features, medians)


def build_feature_set(
    df: DataFrame, quality: DataFrame, test_size: float = 0.2, seed: int = 42
) -> Master:
    """Split by the raw label and impute: ``sample_id, label, split`` and the features.

    One table with a split column takes the place of separate train and test files.
    """
    require_columns(df, ["sample_id", "label"], "Sensor table")
    features, split = together(
        lambda: selected_features(df, quality),
        lambda: stratified_split(df, "label", "sample_id", test_size, seed),
    )
    medians = fit_medians(split, features)
    return Master(fill(split.select("sample_id", "label", "split", *features), medians), features, medians)


def _text_map(values: Mapping[str, float]):
    entries = [F.lit(part) for name, value in values.items() for part in (name, float(value))]
    return F.create_map(*entries) if entries else F.map_from_arrays(F.array(), F.array())


def label_map(table: DataFrame, split: str, label: str, part: str | None = None):
    """Label counts of one split as a map column (a scalar of one small aggregation)."""
    rows = table if part is None else table.where(F.col(split) == part)
    counts = rows.groupBy(F.col(label).cast("string").alias("label")).agg(
        F.count(F.lit(1)).alias("n")
    )
    entries = F.sort_array(F.collect_list(F.struct("label", "n")))
    return counts.agg(F.map_from_entries(entries)).scalar()


def split_document(
    table: DataFrame, label: str, test_size: float, seed: int, split: str = "split"
):
    """Split settings, sizes and label counts as one struct column."""
    rows = table.agg(
        F.count_if(F.col(split) == "train").alias("train"),
        F.count_if(F.col(split) == "test").alias("test"),
    )
    return F.struct(
        F.lit(SPLIT_METHOD).alias("method"),
        F.lit(label).alias("stratify_by"),
        F.lit(float(test_size)).alias("test_size"),
        F.lit(seed).alias("random_state"),
        rows.select("train").scalar().alias("train_row_count"),
        rows.select("test").scalar().alias("test_row_count"),
        label_map(table, split, label, "train").alias("train_label_distribution"),
        label_map(table, split, label, "test").alias("test_label_distribution"),
    )


def master_metadata(
    master: Master, quality: DataFrame, test_size: float = 0.2, seed: int = 42
) -> DataFrame:
    """Everything needed to rebuild the master table, as a one-row document."""
    counts = quality_counts(quality)
    split = split_document(master.table, "label_binary", test_size, seed)
    rows = master.table.agg(F.count(F.lit(1)).alias("row_count"))
    return counts.select(
        rows.scalar().alias("row_count"),
        "original_feature_count",
        F.lit(len(master.features)).cast("long").alias("selected_feature_count"),
        "drop_candidate_feature_count",
        F.col("kept_feature_count").alias("keep_feature_count"),
        F.col("review_feature_count_included").alias("review_feature_count"),
        split.alias("split"),
        F.lit(master.features).alias("feature_columns"),
        F.lit(WIDE_LINEAGE_COLUMNS).alias("lineage_columns"),
        *[F.lit(v).alias(k) for k, v in WIDE_LINEAGE.items()],
        F.lit("train rows only").alias("imputation_fit_on"),
        F.create_map(
            F.lit("-1"), F.lit("0 normal"), F.lit("1"), F.lit("1 defect")
        ).alias("label_mapping"),
        _text_map(master.medians).alias("train_median_imputation_values"),
    )


def feature_set_metadata(
    feature_set: Master, quality: DataFrame, test_size: float = 0.2, seed: int = 42
) -> DataFrame:
    """The same for the feature set: counts, split, imputation values."""
    counts = quality_counts(quality, feature_set.features)
    imputation = F.struct(
        F.lit(FEATURE_SET_IMPUTATION).alias("strategy"),
        F.lit("X_train").alias("fit_on"),
        F.lit(["X_train", "X_test"]).alias("transformed"),
        _text_map(feature_set.medians).alias("median_values"),
    )
    return counts.select(
        "*",
        F.lit(len(feature_set.features)).cast("long").alias("final_feature_count"),
        F.lit(feature_set.features).alias("feature_columns"),
        split_document(feature_set.table, "label", test_size, seed).alias("split"),
        imputation.alias("imputation"),
        F.lit(LEAKAGE_NOTE).alias("leakage_prevention_note"),
    )


