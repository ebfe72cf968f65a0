"""Train/test assignment and what it yields."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fabgauge.functions.columns import require_columns
from fabgauge.functions.rules import check_open_unit
from fabgauge.operators.ordered import hash_key
from fabgauge.session import pin


def stratified_split(
    df: DataFrame,
    label: str,
    key: str,
    test_size: float = 0.2,
    seed: int = 42,
    name: str = "split",
) -> DataFrame:
    """Add a ``train``/``test`` column: per class, a seeded share of the keys goes to test.

    The share is ``n * test_size`` rounded half to even, at least 1 and at most n - 1; a class
    of one row stays in train. Rows are taken in the order of md5(key|seed). Two narrow passes
    find the last test key of each class; the table itself is only mapped, never shuffled.
    """
    check_open_unit("test_size", test_size)
    order = hash_key(F.col(key), seed)
    keys = df.select(
        F.col(label).alias("_class"), F.col(key).alias("_id"), order.alias("_order")
    ).where("_class IS NOT NULL")
    keys = keys.withColumn("_cell", F.substring("_order", 1, 3))

    counted = keys.groupBy("_class", "_cell").agg(F.count(F.lit(1)).alias("_c"))
    every = Window.partitionBy("_class")
    earlier = every.orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    wanted = F.bround(F.col("_n") * F.lit(float(test_size))).cast("long")
    last_cell = (
        counted.withColumns(
            {
                "_n": F.sum("_c").over(every),
                "_before": F.coalesce(F.sum("_c").over(earlier), F.lit(0)),
            }
        )
        .where("_n > 1")
        .withColumn("_quota", F.greatest(F.lit(1), F.least(wanted, F.col("_n") - 1)))
        .where("_before < _quota")
        .groupBy("_class", "_quota")
        .agg(F.max_by("_cell", "_before").alias("_cell"), F.max("_before").alias("_before"))
    )
    in_cell = Window.partitionBy("_class").orderBy("_order", "_id")
    last_key = pin(
        keys.join(pin(last_cell), ["_class", "_cell"])
        .withColumn("_at", F.row_number().over(in_cell) + F.col("_before"))
        .where("_at = _quota")
        .select("_class", F.struct("_order", "_id").alias("_last"))
    )
    in_test = F.struct(order.alias("_order"), F.col(key).alias("_id")) <= F.col("_last")
    return (
        df.join(last_key, F.col(label) == F.col("_class"), "left")
        .withColumn(name, F.when(in_test, "test").otherwise("train"))
        .drop("_class", "_last")
    )


def train_test(
    df: DataFrame, split: str = "split", label: str = "label_binary"
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; both must exist."""
    require_columns(df, [label, split], "Master table")
    parts = tuple(df.where(F.col(split) == part) for part in ("train", "test"))
    if any(part.isEmpty() for part in parts):
        raise ValueError("Master table must contain train and test rows")
    return parts


def split_label_counts(
    df: DataFrame, split: str = "split", label: str = "label_binary"
) -> DataFrame:
    """``split, label, row_count``."""
    return df.groupBy(F.col(split).alias("split"), F.col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
