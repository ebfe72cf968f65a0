"""Writers for tables, documents and models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabgauge.operators.evaluate import LABEL
from fabgauge.operators.models import ONE_CLASS_TRAIN_WARNING


def write_table(df: DataFrame, path: str, file_format: str = "parquet") -> None:
    writer = df.write.mode("overwrite")
    if file_format == "csv":
        writer = writer.option("header", True)
    writer.format(file_format).save(path)


def write_train_test(df: DataFrame, path: str, split: str = "split") -> None:
    """One table with a folder per split, so reading one split skips the other's files."""
    df.write.mode("overwrite").partitionBy(split).parquet(path)


def write_document(df: DataFrame, path: str) -> None:
    """A one-row table of nested fields as JSON, NULL fields kept."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def skipped_model_record(
    train: DataFrame, model_name: str, warning: str = ONE_CLASS_TRAIN_WARNING
) -> DataFrame:
    """Registry row that stands in for a model that could not be trained."""
    counts = train.groupBy(F.col(LABEL).cast("string").alias("label")).agg(
        F.count(F.lit(1)).alias("n")
    )
    entries = F.sort_array(F.collect_list(F.struct("label", "n")))
    return counts.agg(
        F.lit(model_name).alias("model_name"),
        F.lit(False).alias("training_completed"),
        F.lit(warning).alias("warning"),
        F.map_from_entries(entries).alias("train_label_distribution"),
    )


def register_model(record: DataFrame, path: str) -> None:
    """Append a row to the model registry table."""
    record.write.mode("append").parquet(path)
