"""Train-fitted medians and scaling."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabgauge.operators.contracts import unimputable_features
from fabgauge.operators.ordered import exact_median
from fabgauge.operators.profile import melt
from fabgauge.session import pin


def train_medians(df: DataFrame, features: Sequence[str], split: str = "split") -> DataFrame:
    """Exact median per feature over the train rows: ``feature, median``."""
    return column_medians(df.where(F.col(split) == "train"), features)


def column_medians(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Exact median of each column that has a value: ``feature, median``."""
    return exact_median(melt(df, features), ["feature"], "value").select("feature", "median")


def fit_medians(
    df: DataFrame, features: Sequence[str], split: str = "split", on_empty: str = "error"
) -> dict[str, float]:
    """Medians as a map with one entry per column.

    A feature without train values is an error, or left out with ``on_empty='drop'``.
    """
    found = {r.feature: r.median for r in train_medians(df, features, split).collect()}
    empty = [f for f in features if f not in found]
    if empty and on_empty == "error":
        raise ValueError(f"Cannot median-impute columns with no non-null train values: {empty}")
    return {f: float(found[f]) for f in features if f in found}


def fill(df: DataFrame, values: Mapping[str, float]) -> DataFrame:
    """Replace missing values column by column."""
    return df.fillna(dict(values))


def fill_long(long: DataFrame, medians: DataFrame) -> DataFrame:
    """Long form: each missing value becomes its feature's median."""
    filled = long.join(pin(medians), "feature").withColumn("value", F.coalesce("value", "median"))
    return filled.drop("median")


def scaler_params(train: DataFrame, features: Sequence[str]) -> DataFrame:
    """``feature, mean, scale``: mean and population deviation, 1 where that is 0."""
    deviation = F.stddev_pop("value")
    return (
        melt(train, features)
        .groupBy("feature")
        .agg(
            F.avg("value").alias("mean"),
            F.when(deviation == 0, 1.0).otherwise(deviation).alias("scale"),
        )
    )


def fit_scaler(train: DataFrame, features: Sequence[str]) -> dict[str, tuple[float, float]]:
    return {r.feature: (r.mean, r.scale) for r in scaler_params(train, features).collect()}


def standardize(df: DataFrame, scaler: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Centre and scale the columns with fitted values."""
    return df.withColumns({c: (F.col(c) - m) / s for c, (m, s) in scaler.items()})


def assert_imputable(train: DataFrame, features: Sequence[str]) -> None:
    names = [r.feature for r in unimputable_features(train, features).collect()]
    if names:
        raise ValueError(f"Cannot median-impute columns with no non-null train values: {names}")
