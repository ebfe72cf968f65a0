"""Column expressions for labels, quality grades and scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Limits and names of the quality rules.
HIGH_MISSING_RATIO = 0.80
MEDIUM_MISSING_RATIO = 0.30
MISSING_BUCKETS = [
    "high_missing_drop_candidate",
    "medium_missing_review",
    "low_missing_keep",
]
RECOMMENDED_ACTIONS = ["drop_candidate", "review", "keep"]
SELECTED_ACTIONS = ["keep", "review"]
MISSING_LABEL = "<MISSING>"


def binary_label(label: Column, accept_zero: bool = False) -> Column:
    """-1 becomes 0 and 1 stays 1; with ``accept_zero`` 0 stays 0. Anything else becomes NULL."""
    expr = F.when(label == -1, 0).when(label == 1, 1)
    return expr.when(label == 0, 0) if accept_zero else expr


def official_split(is_test: Column) -> Column:
    return F.when(is_test == 1, "test").otherwise("train")


def missing_bucket(ratio: Column) -> Column:
    high, medium, low = MISSING_BUCKETS
    return (
        F.when(ratio >= HIGH_MISSING_RATIO, high)
        .when(ratio >= MEDIUM_MISSING_RATIO, medium)
        .otherwise(low)
    )


def recommended_action(is_constant: Column, ratio: Column) -> Column:
    drop, review, keep = RECOMMENDED_ACTIONS
    return (
        F.when(is_constant | (ratio >= HIGH_MISSING_RATIO), drop)
        .when(ratio >= MEDIUM_MISSING_RATIO, review)
        .otherwise(keep)
    )


def predicted_label(score: Column, threshold: float | Column) -> Column:
    """1 from the threshold upwards, the threshold itself included; 0 without a score."""
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return F.coalesce(score >= limit, F.lit(False)).cast("int")


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as a double; 0 for an empty denominator."""
    quotient = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    return F.coalesce(quotient, F.lit(0.0))


def f_beta(tp: Column, fp: Column, fn: Column, beta: float = 2.0) -> Column:
    weight = float(beta) ** 2
    hits = tp * F.lit(1.0 + weight)
    return safe_ratio(hits, hits + fn * F.lit(weight) + fp)


def missing_as_label(column: Column) -> Column:
    return F.coalesce(column.cast("string"), F.lit(MISSING_LABEL))


def coerce_numeric(column: Column) -> Column:
    """Number as a double; text that is no number, and NaN, become NULL."""
    number = column.try_cast("double")
    return F.nanvl(number, F.lit(None).cast("double"))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating column, so aggregates skip it."""
    floating = [
        f for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))
    ]
    return df.withColumns(
        {f.name: F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)) for f in floating}
    )


def check_open_unit(name: str, value: float) -> None:
    if not 0 < value < 1:
        raise ValueError(f"{name} must be between 0 and 1, got {value}")
