"""Session helpers: tables computed once and kept in the shared folder."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named by ``spark.checkpoint.dir``; make one only for a local master."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="fabgauge-checkpoint-")
    context.setCheckpointDir(folder)


def fix(df: DataFrame) -> DataFrame:
    """Write the rows once to the checkpoint folder, so later reads see the same rows."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def pin(df: DataFrame) -> DataFrame:
    """Compute a summary table once: written to the checkpoint folder and read back.

    The files tell Spark the size of the table, by which it chooses how to join it.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pinned-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def release(spark: SparkSession) -> None:
    """Have Spark remove the shuffle files of frames that are gone, which it does when the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def together(*jobs: Callable) -> list:
    """The results of functions that run Spark jobs side by side, as one's small jobs leave cores idle."""
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in [pool.submit(inherit(job)) for job in jobs]]
