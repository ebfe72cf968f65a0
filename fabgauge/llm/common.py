"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator, Sequence
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fabgauge.session import ensure_checkpoint_dir

# Rows of an Arrow batch that are turned into Python strings at a time.
SLICE = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name below the checkpoint folder, which all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the rows once to the shared folder and read them back: later steps neither
    compute them again nor depend on executors that held them."""
    folder = scratch(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, changed where the table has them already (Spark does not tell upper from lower case)."""
    taken, chosen = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        chosen.append(name)
    return chosen


def slices(batch: pa.RecordBatch) -> Iterator[list[list]]:
    """The columns of a batch as Python lists, a few rows at a time."""
    for at in range(0, batch.num_rows, SLICE):
        part = batch.slice(at, SLICE)
        yield [column.to_pylist() for column in part.columns]


def tidy(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The task of an Arrow function, which gives free memory back to the system at its end: its worker lives on
    for other tasks, and else keeps all that one of them once used."""

    @wraps(task)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it, and only it needs it
        if trim is not None:
            trim(0)

    return run


def numbered(df: DataFrame, group: Sequence[str], order: Sequence[str], name: str) -> DataFrame:
    """Number the rows of each group without gaps from 0, for groups of any size.

    Rows are dealt into buckets by a hash of the ``order`` columns, numbered inside each bucket and
    shifted by the totals of earlier buckets, so no task needs a whole group. Rows equal in all
    ``order`` columns share a bucket and take neighbouring numbers. ``df`` is read twice; give a
    stored table.
    """
    spark = df.sparkSession
    buckets = max(4 * partitions(spark), df.count() // 50_000)
    bucket, own, rows, base = fresh(df, "_bucket", "_inside", "_rows", "_base")
    keys = [*group, bucket]
    dealt = df.withColumn(bucket, F.pmod(F.xxhash64(*order), F.lit(buckets)))
    earlier = Window.partitionBy(*group).orderBy(bucket).rowsBetween(
        Window.unboundedPreceding, -1
    )
    totals = (
        dealt.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias(rows))
        .withColumn(base, F.coalesce(F.sum(rows).over(earlier), F.lit(0)))
        .drop(rows)
    )
    inside = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return (
        dealt.withColumn(own, inside)
        .join(totals, keys)
        .withColumn(name, F.col(base) + F.col(own) - 1)
        .drop(bucket, own, base)
    )


def sorted_unique(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and how often each occurs."""
    values = np.sort(values)
    if not len(values):
        return values, np.zeros(0, np.int64)
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return values[first], np.diff(np.append(first, len(values)))
