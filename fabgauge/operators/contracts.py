"""Data checks. Each returns the violations as a DataFrame; an empty one means the check passed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabgauge.functions.columns import MATERIAL_REQUIRED_COLUMNS, require_columns
from fabgauge.operators.profile import missing_values


def assert_empty(violations: DataFrame, message: str) -> None:
    """Raise with a few of the violations if there are any."""
    found = violations.take(5)
    if found:
        raise ValueError(f"{message}: {[row.asDict() for row in found]}")


def binary_violations(df: DataFrame, column: str) -> DataFrame:
    """Values of a flag column other than 0 and 1, NULL included: ``value, row_count``."""
    value = F.col(column)
    return (
        df.where(value.isNull() | ~value.isin(0, 1))
        .groupBy(value.cast("string").alias("value"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def assert_binary(df: DataFrame, column: str) -> None:
    assert_empty(
        binary_violations(df, column), f"{column} must contain only binary values 0/1"
    )


def several_values(column: Column) -> Column:
    """Aggregate: does the group hold more than one value, NULL counted as a value?"""
    nulls = F.count(F.lit(1)) - F.count(column)
    return (F.min(column) != F.max(column)) | ((nulls > 0) & (F.count(column) > 0))


def mixed_groups(df: DataFrame, key: str, column: str) -> DataFrame:
    """Keys with more than one value of ``column``.

    Minimum, maximum and counts combine before the shuffle, so a key with most of the rows
    costs one small record per task. NULL keys are left out, as in the feature table.
    """
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(several_values(F.col(column)).alias("mixed"), F.count(F.lit(1)).alias("row_count"))
        .where(F.coalesce("mixed", F.lit(False)))
        .select(key, "row_count")
    )


def assert_constant_in_group(df: DataFrame, key: str, column: str) -> None:
    assert_empty(mixed_groups(df, key, column), f"{column} varies within {key}")


def label_violations(
    df: DataFrame, column: str = "label", allowed: Sequence[int] = (-1, 1)
) -> DataFrame:
    """Labels outside the allowed ones, missing ones included: ``label, row_count``."""
    value = F.col(column)
    return (
        df.where(~F.coalesce(value.isin(*allowed), F.lit(False)))
        .groupBy(value.alias("label"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def assert_labels(df: DataFrame, column: str, allowed: Sequence[int] = (-1, 1)) -> None:
    assert_empty(label_violations(df, column, allowed), f"Unexpected values of {column}")


def material_master_violations(df: DataFrame) -> DataFrame:
    """Broken rules of a material master: ``rule, violation_count``.

    Rules: unique id, labels 0/1, splits train/test, rows in both splits, no id in both.
    """
    require_columns(df, MATERIAL_REQUIRED_COLUMNS, "Material master")
    label, split = F.col("label_binary"), F.col("official_split")

    ids = df.groupBy("material_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(label.isNull() | ~label.isin(0, 1)).alias("bad_label"),
        F.count_if(split.isNull() | ~split.isin("train", "test")).alias("bad_split"),
        F.count_if(split == "train").alias("train"),
        F.count_if(split == "test").alias("test"),
    )
    totals = ids.agg(
        F.sum((F.col("n") > 1).cast("long")).alias("duplicate_material_id"),
        F.sum("bad_label").alias("label_outside_domain"),
        F.sum("bad_split").alias("split_outside_domain"),
        (F.sum("train") == 0).cast("long").alias("no_train_rows"),
        (F.sum("test") == 0).cast("long").alias("no_test_rows"),
        F.sum(((F.col("train") > 0) & (F.col("test") > 0)).cast("long")).alias(
            "material_in_both_splits"
        ),
    )
    rules = [
        F.struct(F.lit(c).alias("rule"), F.coalesce(F.col(c), F.lit(1)).alias("violation_count"))
        for c in totals.columns
    ]
    return totals.select(F.inline(F.array(*rules))).where("violation_count > 0")


def assert_material_master(df: DataFrame) -> None:
    assert_empty(material_master_violations(df), "Material master breaks its contract")


def split_overlap(
    df: DataFrame, key: str = "material_id", split: str = "official_split"
) -> DataFrame:
    """Keys found both in train and in test."""
    seen = df.groupBy(key).agg(
        F.max((F.col(split) == "train").cast("int")).alias("train"),
        F.max((F.col(split) == "test").cast("int")).alias("test"),
    )
    return seen.where("train = 1 AND test = 1").select(key)


def assert_same_count(left: int, right: int, what: str) -> int:
    if left != right:
        raise ValueError(f"{what} row counts do not match: {left} vs {right}")
    return left


def assert_row_counts_match(left: DataFrame, right: DataFrame, what: str) -> int:
    return assert_same_count(left.count(), right.count(), what)


def class_presence(df: DataFrame, label: str = "label_binary", split: str = "split") -> DataFrame:
    """Per split: how many classes it holds and what that means for training or testing."""
    classes = df.groupBy(split, label).agg(F.count(F.lit(1)).alias("n"))
    return classes.groupBy(split).agg(
        F.count(label).alias("class_count"),
        F.sum("n").alias("row_count"),
        (F.count(label) >= 2).alias("has_both_classes"),
    )


def assert_both_classes(df: DataFrame, label: str = "label_binary") -> None:
    seen = [r[0] for r in df.select(label).distinct().limit(3).collect()]
    if set(seen) != {0, 1}:
        raise ValueError(f"Evaluation needs both classes 0 and 1, found {seen}")


def unimputable_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Features without a single value in the given (train) rows."""
    report = missing_values(df, features)
    rows = df.agg(F.count(F.lit(1))).scalar()
    return report.where(F.col("missing_count") == rows).select("feature")
