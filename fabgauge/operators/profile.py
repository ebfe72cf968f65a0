"""Profiles of a wide sensor table: missing values, labels, duplicates."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabgauge.functions.columns import sensor_columns
from fabgauge.functions.rules import safe_ratio
from fabgauge.session import fix

MELT_BATCH = 64
# Columns whose aggregates are computed together, few enough for generated code.
FACT_BATCH = 16


def melt(df: DataFrame, features: Sequence[str], ids: Sequence[str] = ()) -> DataFrame:
    """Long form ``ids..., feature, value``; missing values stay as NULL rows.

    Spark gives up generated code and columnar scans above 100 columns, so wide tables are
    turned in batches of columns. Each batch scans only its own columns; give it a stored
    table or a plain projection of one, since what lies upstream runs once per batch.
    """
    starts = range(0, len(features), MELT_BATCH)
    parts = [
        df.unpivot(list(ids), list(features[i : i + MELT_BATCH]), "feature", "value")
        for i in starts
    ]
    return reduce(DataFrame.unionByName, parts)


def per_feature(df: DataFrame, features: Sequence[str], counts: DataFrame) -> DataFrame:
    """One row per feature even if the table is empty; ``counts`` has at most that many."""
    names = df.sparkSession.range(1).select(F.explode(F.lit(list(features))).alias("feature"))
    return names.join(F.broadcast(counts), "feature", "left")


def column_facts(
    df: DataFrame, features: Sequence[str], facts: Mapping[str, Callable[[str], Column]]
) -> DataFrame:
    """``feature, rows`` and an aggregate of each column per fact, also for an empty table.

    Every row is read once per batch of columns, of which a scan takes no others, and only one
    row per task is shuffled: nothing is melted or grouped by value.
    """
    parts = []
    for start in range(0, max(1, len(features)), FACT_BATCH):
        batch = list(enumerate(features[start : start + FACT_BATCH]))
        cells = [e(name).alias(f"{fact}_{i}") for i, name in batch for fact, e in facts.items()]
        totals = df.agg(F.count(F.lit(1)).alias("rows"), *cells)
        rows = [
            F.struct(F.lit(name).alias("feature"), "rows", *[F.col(f"{fact}_{i}").alias(fact) for fact in facts])
            for i, name in batch
        ]
        if rows:
            parts.append(totals.select(F.inline(F.array(*rows))))
    if not parts:
        raise ValueError("no features to look at")
    return reduce(DataFrame.unionByName, parts)


def missing_values(df: DataFrame, features: Sequence[str] | None = None) -> DataFrame:
    """Per sensor: ``feature, missing_count, missing_ratio``."""
    names = sensor_columns(df) if features is None else list(features)
    counts = column_facts(df, names, {"present": F.count})
    missing = F.col("rows") - F.col("present")
    return counts.select(
        "feature", missing.alias("missing_count"), safe_ratio(missing, F.col("rows")).alias("missing_ratio")
    )


def label_distribution(df: DataFrame, label: str = "label") -> DataFrame:
    """``label, count`` in label order, missing labels included."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy("label")


def duplicate_rows(df: DataFrame, ignore: Sequence[str] = ("sample_id",)) -> DataFrame:
    """Number of rows equal to an earlier row: ``duplicate_row_count``.

    First only a 64-bit hash per row is counted. The rows whose hash repeats are picked out and
    compared column by column, so unequal rows with one hash do not count; equal ones combine
    before the shuffle, however many there are.
    """
    columns = [c for c in df.columns if c not in ignore]
    hashed = df.select(*columns).withColumn("_hash", F.xxhash64(*columns))
    counted = hashed.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n"))
    repeated = fix(counted.where("_n > 1").select("_hash"))
    suspects = hashed.join(repeated, "_hash", "left_semi")
    groups = suspects.groupBy("_hash", *columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_row_count")
    )


def dataset_profile(df: DataFrame) -> DataFrame:
    """One row: rows, features, missing cells and their share, duplicate rows."""
    names = sensor_columns(df)
    missing = missing_values(df, names).agg(F.sum("missing_count").alias("n")).scalar()
    rows = df.agg(F.count(F.lit(1)).alias("row_count"))
    return rows.select(
        "row_count",
        F.lit(len(names)).cast("long").alias("feature_count"),
        missing.alias("total_missing_values"),
        safe_ratio(missing, F.col("row_count") * len(names)).alias("overall_missing_value_ratio"),
        duplicate_rows(df).scalar().alias("duplicate_row_count"),
    )


def top_missing(report: DataFrame, n: int = 20) -> DataFrame:
    return report.orderBy(
        F.desc("missing_ratio"), F.desc("missing_count"), F.asc("feature")
    ).limit(n)
