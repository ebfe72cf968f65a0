"""The profile of an event table as counts that add up, kept per input file.

A state holds small tables of counts, each row tagged with the source it was counted from. States of
different sources are merged by putting their rows together; a profile sums over the sources. So files that
arrive later are profiled alone, and a file that is delivered again replaces its own counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, fields
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fabgauge.functions.columns import EVENT_REQUIRED_COLUMNS, require_columns
from fabgauge.functions.rules import coerce_numeric, missing_as_label
from fabgauge.operators.events import row_count_statistics
from fabgauge.operators.ordered import shuffle_partitions

SOURCE = "profile_source"
FLAGS = ["target", "is_test"]
DISTRIBUTIONS = ["target", "is_test", "StepID"]


@dataclass
class ProfileState:
    """Counts per source: of columns, of values, per material, of durations and of equal rows."""

    columns: DataFrame
    values: DataFrame
    materials: DataFrame
    durations: DataFrame
    rows: DataFrame


PARTS = [f.name for f in fields(ProfileState)]


def _row_hashes(columns: Sequence[str]) -> list[Column]:
    """Two 64-bit hashes of a whole row, whatever the order of its columns; NULLs are told apart by place."""
    cells = [x for c in sorted(columns) for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return [F.xxhash64(F.lit(seed), *cells).alias(f"hash_{seed}") for seed in (1, 2)]


def profile_state(df: DataFrame, source: Column | str) -> ProfileState:
    """The state of the rows; ``source`` is a name, or an expression such as ``_metadata.file_path``.

    Every table combines before its shuffle. No rows give a state without rows.
    """
    require_columns(df, EVENT_REQUIRED_COLUMNS, "Event table")
    names = list(df.columns)
    if SOURCE in names:
        raise ValueError(f"The column name {SOURCE} is taken by the state")
    tag = F.lit(source) if isinstance(source, str) else source
    rows = df.select("*", tag.cast("string").alias(SOURCE))
    by_source = rows.groupBy(SOURCE)
    missing = by_source.agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in names]
    )
    values = [
        rows.select(SOURCE, F.lit(c).alias("column_name"), missing_as_label(F.col(c)).alias("value"))
        for c in DISTRIBUTIONS
    ]
    flags = [
        e.alias(f"{c}_{n}")
        for c in FLAGS
        for n, e in (("low", F.min(c)), ("high", F.max(c)), ("known", F.count(c)))
    ]
    duration = coerce_numeric(F.col("duration_ms"))
    count = F.count(F.lit(1))
    return ProfileState(
        columns=missing.unpivot([SOURCE, "_n"], names, "column_name", "missing_count").withColumnRenamed(
            "_n", "row_count"
        ),
        values=reduce(DataFrame.unionByName, values)
        .groupBy(SOURCE, "column_name", "value")
        .agg(count.alias("count")),
        materials=rows.groupBy(SOURCE, "MaterialID").agg(count.alias("row_count"), *flags),
        durations=by_source.agg(
            F.min(duration).alias("min"),
            F.max(duration).alias("max"),
            F.count_if(duration.isNull()).alias("missing_count"),
        ),
        rows=rows.select(SOURCE, *_row_hashes(names))
        .groupBy(SOURCE, "hash_1", "hash_2")
        .agg(count.alias("count")),
    )


def merge_states(*states: ProfileState) -> ProfileState:
    """The state of all sources together; a source may be in one of the states only."""
    return ProfileState(
        *[reduce(DataFrame.unionByName, [getattr(s, part) for s in states]) for part in PARTS]
    )


def write_state(state: ProfileState, folder: str) -> None:
    """Add the sources to the stored state; counts stored of the same sources before are replaced.

    A source whose rows are all gone keeps its old counts: there is nothing that names it.
    """
    for part in PARTS:
        writer = getattr(state, part).write.mode("overwrite").partitionBy(SOURCE)
        writer.option("partitionOverwriteMode", "dynamic").parquet(f"{folder}/{part}")


def read_state(spark: SparkSession, folder: str) -> ProfileState:
    def table(part: str) -> DataFrame:
        path = f"{folder}/{part}"
        # Sources are texts, also those that look like numbers or dates.
        found = [f for f in spark.read.parquet(path).schema if f.name != SOURCE]
        schema = T.StructType([*found, T.StructField(SOURCE, T.StringType())])
        return spark.read.schema(schema).parquet(path)

    return ProfileState(*[table(part) for part in PARTS])


def profile_columns(state: ProfileState) -> DataFrame:
    """Missing values over all sources: ``column_name, missing_count``. The columns must be the same in all."""
    sources = state.columns.select(SOURCE).distinct().count()
    counts = state.columns.groupBy("column_name").agg(
        F.sum("missing_count").alias("missing_count"), F.count(F.lit(1)).alias("sources")
    )
    uneven = [r.column_name for r in counts.where(F.col("sources") != sources).take(5)]
    if uneven:
        raise ValueError(f"Columns that not all sources have: {uneven}")
    return counts.drop("sources")


def profile_values(state: ProfileState) -> DataFrame:
    """Distributions of flags and steps as rows: ``column_name, value, count``."""
    return state.values.groupBy("column_name", "value").agg(F.sum("count").alias("count"))


def profile_summary(state: ProfileState) -> DataFrame:
    """One row: rows, materials, mixed materials, rows per material, durations and duplicate rows.

    Rows without a material id count as one more material. Duplicates are rows equal to another one by 128
    bits of hash.
    """

    def mixed(flag: str) -> Column:
        known = F.sum(f"{flag}_known")
        differs = F.min(f"{flag}_low") != F.max(f"{flag}_high")
        return F.coalesce(differs | ((known > 0) & (known < F.sum("row_count"))), F.lit(False))

    materials = state.materials.groupBy("MaterialID").agg(
        F.sum("row_count").alias("rows"), *[mixed(c).alias(f"mixed_{c}") for c in FLAGS]
    )
    # Materials of one size share a row, so that the quantiles need one row per size.
    sizes = materials.groupBy("rows").agg(
        F.count(F.lit(1)).alias("materials"),
        *[F.count_if(f"mixed_{c}").alias(f"mixed_{c}") for c in FLAGS],
    )
    per_material = sizes.agg(
        F.coalesce(F.sum(F.col("rows") * F.col("materials")), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum("materials"), F.lit(0)).alias("unique_material_id_count"),
        *[
            F.coalesce(F.sum(f"mixed_{c}"), F.lit(0)).alias(f"mixed_{c}_material_id_count")
            for c in FLAGS
        ],
        F.struct(*row_count_statistics(F.col("rows"), F.col("materials"))).alias("_sizes"),
    )
    durations = state.durations.agg(
        F.struct(
            F.min("min").alias("duration_min"),
            F.max("max").alias("duration_max"),
            F.coalesce(F.sum("missing_count"), F.lit(0)).alias("duration_missing_count"),
        )
    )
    # Dealt out before they are grouped again, so that no task holds the groups of both at once. The number of
    # partitions is given, as Spark would put so many of these short rows together that their groups are large.
    dealt = state.rows.repartition(shuffle_partitions(state.rows), "hash_1", "hash_2")
    equal = dealt.groupBy("hash_1", "hash_2").agg(F.sum("count").alias("n"))
    duplicates = equal.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)))
    whole = per_material.withColumns(
        {"_durations": durations.scalar(), "duplicate_full_row_count": duplicates.scalar()}
    )
    plain = [c for c in whole.columns if not c.startswith("_")]
    sizes_out = [F.col(f"_sizes.{c}").alias(f"rows_per_material_{c}") for c in ("min", "max", "mean", "median", "p25", "p75")]
    return whole.select(*plain, *sizes_out, "_durations.*")
