"""Schema-level helpers: which columns are sensors, features or metadata."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Column names and lineage values of the data model.
SENSOR_PREFIX = "sensor_"
WIDE_LINEAGE_COLUMNS = [
    "sample_id",
    "timestamp",
    "label_original",
    "label_binary",
    "split",
    "feature_set_version",
    "quality_rule_version",
    "preprocessing_version",
    "imputation_strategy",
]
EVENT_REQUIRED_COLUMNS = ["MaterialID", "StepID", "duration_ms", "target", "is_test"]
MATERIAL_METADATA_COLUMNS = [
    "dataset_id",
    "material_id",
    "label_original",
    "label_binary",
    "official_split",
    "source_record_count",
    "step_count",
    "feature_set_version",
    "preprocessing_version",
    "aggregation_strategy",
    "sequence_manifest_path",
]
MATERIAL_REQUIRED_COLUMNS = [
    "dataset_id",
    "material_id",
    "label_original",
    "label_binary",
    "official_split",
]


def sensor_columns(df: DataFrame) -> list[str]:
    """Sensor columns in table order, lineage columns left out."""
    return [
        c for c in df.columns if c.startswith(SENSOR_PREFIX) and c not in WIDE_LINEAGE_COLUMNS
    ]


def numeric_features(df: DataFrame, reserved: Iterable[str]) -> list[str]:
    """Numeric columns in table order, minus the reserved ones."""
    skip = set(reserved)
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in skip
    ]


def event_features(df: DataFrame) -> list[str]:
    """Numeric measurement columns of an event table."""
    return numeric_features(df, EVENT_REQUIRED_COLUMNS)


def material_features(df: DataFrame) -> list[str]:
    """Model input columns of a material master table."""
    return numeric_features(df, [*MATERIAL_METADATA_COLUMNS, "observed_step_ids_json"])


def sequence_features(columns: Sequence[str]) -> list[str]:
    """Columns of an event table that are not reference columns, of any type."""
    return [c for c in columns if c not in EVENT_REQUIRED_COLUMNS]


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    """Required column names the table does not have, in the order asked for."""
    present = set(df.columns)
    return [c for c in required if c not in present]


def require_columns(df: DataFrame, required: Iterable[str], what: str = "table") -> None:
    absent = missing_columns(df, required)
    if absent:
        raise ValueError(f"{what} is missing required columns: {absent}")


def reject_metadata_features(features: Iterable[str], metadata: Iterable[str]) -> None:
    wrong = [f for f in features if f in set(metadata)]
    if wrong:
        raise ValueError(f"Metadata columns cannot be used as features: {wrong}")


def statistic_columns(features: Iterable[str], statistics: Sequence[str]) -> list[str]:
    """``feature_statistic`` names: features in text order, statistics in the given order."""
    return [f"{feature}_{stat}" for feature in sorted(features) for stat in statistics]


def column_catalog(df: DataFrame) -> list[tuple[str, str]]:
    """Column names with their Spark types."""
    return list(df.dtypes)
