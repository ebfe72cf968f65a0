"""The dataset catalog, its rules and the files behind it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fabgauge.functions.columns import require_columns
from fabgauge.operators.contracts import assert_empty
from fabgauge.session import pin

# Fields of a catalog entry and the values two of them may take.
CATALOG_FIELDS = [
    "dataset_id",
    "display_name",
    "source_url",
    "source_type",
    "domain",
    "modality",
    "task_type",
    "label_column",
    "split_column",
    "local_raw_path",
    "local_processed_path",
    "expected_pipeline_branch",
    "license_note",
    "download_status",
    "use_in_project",
    "notes",
]
MODALITIES = ["tabular_sensor", "wafer_timeseries", "wafer_map_image"]
USES = ["current", "next", "phase_2", "hold"]
PLAN_FIELDS = [
    "dataset_id",
    "display_name",
    "modality",
    "task_type",
    "download_status",
    "use_in_project",
    "expected_pipeline_branch",
]


def catalog_violations(catalog: DataFrame) -> DataFrame:
    """Broken rules: ``dataset_id, rule``, one row per entry and rule."""
    require_columns(catalog, CATALOG_FIELDS, "Dataset catalog")
    entries = catalog.groupBy("dataset_id").agg(F.count(F.lit(1)).alias("n"))
    repeated = entries.where("n > 1").select(
        "dataset_id", F.lit("duplicate_dataset_id").alias("rule")
    )
    url, modality, use = (F.col(c) for c in ("source_url", "modality", "use_in_project"))
    broken = F.array_compact(
        F.array(
            F.when(url.isNull() | (F.trim(url) == ""), "empty_source_url"),
            F.when(modality.isNull() | ~modality.isin(MODALITIES), "unsupported_modality"),
            F.when(use.isNull() | ~use.isin(USES), "unsupported_use_in_project"),
        )
    )
    return catalog.select("dataset_id", F.explode(broken).alias("rule")).unionByName(repeated)


def dataset_catalog(catalog: DataFrame) -> DataFrame:
    """The 16 catalog fields in order."""
    require_columns(catalog, CATALOG_FIELDS, "Dataset catalog")
    return catalog.select(*CATALOG_FIELDS)


def read_catalog(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """A checked catalog from a JSON array, or from JSON lines."""
    schema = ", ".join(f"{f} string" for f in CATALOG_FIELDS)
    catalog = spark.read.json(path, schema=schema, multiLine=not lines)
    assert_empty(catalog_violations(catalog), "Dataset catalog breaks its rules")
    return dataset_catalog(catalog)


def catalog_plan(catalog: DataFrame) -> DataFrame:
    return catalog.select(*PLAN_FIELDS)


def source_files(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Files below the paths: ``path, length, modificationTime``; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return reader.load(paths).select("path", "length", "modificationTime")


def _totals() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("file_count"),
        F.sum("length").alias("size_bytes"),
        F.max("modificationTime").alias("modified_at"),
    ]


def source_inventory(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Files per name without extension, with count, bytes and newest time."""
    name = F.regexp_extract("path", r"([^/]+?)(\.[A-Za-z0-9]+)?$", 1)
    files = source_files(spark, paths).withColumn("dataset_id", name)
    return files.groupBy("dataset_id").agg(*_totals())


def _plain_path(path: Column) -> Column:
    """The path without scheme, host, doubled and last slashes."""
    local = F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    return F.regexp_replace(F.regexp_replace(local, "/+", "/"), "/$", "")


def dataset_inventory(catalog: DataFrame, files: DataFrame, root: str = "") -> DataFrame:
    """Catalog entries with the files of their ``local_raw_path``: count, bytes and newest time.

    The path is a folder or a file; one that does not start with a slash or a scheme lies below ``root``.
    A file belongs to the entry with the longest path above it, and to each of them if several have the
    same path. Entries without files, or without a path, stay with NULLs; files below no entry are left out.
    """
    fields = ["dataset_id", "source_url", "local_raw_path", "license_note"]
    raw = F.col("local_raw_path")
    whole = F.when(raw.rlike(r"^(/|[A-Za-z][A-Za-z0-9+.-]*:)"), raw)
    below = F.concat(F.lit(f"{root}/"), F.regexp_replace(raw, r"^(\./)+", ""))
    place = F.when(F.trim(raw) != "", _plain_path(F.coalesce(whole, below)))
    entries = catalog.select(*fields, place.alias("_folder"))
    folders = pin(entries.select("_folder").where("_folder IS NOT NULL").distinct())
    parts = F.split("_path", "/")
    above = F.transform(
        F.sequence(F.lit(1), F.size(parts)), lambda n: F.concat_ws("/", F.slice(parts, 1, n))
    )
    numbered = files.select(_plain_path(F.col("path")).alias("_path"), "length", "modificationTime")
    # A file met twice in the listing is one file.
    ancestors = numbered.distinct().select("*", F.explode(above).alias("_folder"))
    longest = F.max_by("_folder", F.length("_folder")).alias("_folder")
    owned = (
        ancestors.join(folders, "_folder")
        .groupBy("_path", "length", "modificationTime")
        .agg(longest)
    )
    totals = owned.groupBy("_folder").agg(*_totals())
    return entries.join(totals, "_folder", "left").drop("_folder")


def inventory_of_catalog(catalog: DataFrame, inventory: DataFrame) -> DataFrame:
    """Catalog entries with what was found on disk; entries without files keep NULLs."""
    fields = ["dataset_id", "source_url", "local_raw_path", "license_note"]
    return catalog.select(*fields).join(inventory, "dataset_id", "left")
