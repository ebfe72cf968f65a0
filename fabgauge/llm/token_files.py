"""Token ids in flat binary files with document offsets.

A folder holds, for each range of document ids, three flat little-endian files: ``part-N.ids``
(unsigned 16- or 32-bit token ids), ``part-N.offsets`` (64-bit start of each document in the part,
and the end) and ``part-N.docs`` (64-bit document ids). The table ``manifest`` has one row per part
with the documents and tokens of all parts before it.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fabgauge.llm.common import partitions, slices, stored
from fabgauge.llm.tokens import END_ID, worker_encoder

# Stands for a null document id in the files.
NO_ID = -(2**63)
MANIFEST = "part int, documents long, tokens long, width int, document_base long, token_base long"


def _part(folder: str, part: int, kind: str) -> str:
    return f"{folder}/part-{part:06d}.{kind}"


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    end_id: int = END_ID,
    parts: int | None = None,
) -> DataFrame:
    """Write the ids of all documents in ascending order of document id; return the manifest.

    Rows are sorted by range into ``parts`` parts (default: the shuffle partitions), each written by
    one task that holds one document at a time. A file appears under its name only when complete,
    and a repeated attempt writes the same bytes. Null texts are empty (only ``end_id``); null ids
    come first; rows with the same id are kept, in order of a hash of their text. Other columns are
    ignored. An empty table gives an empty manifest. ``folder`` must be a URI that all
    executors reach.
    """
    spark = docs.sparkSession
    width = worker_encoder(tokenizer).dtype.itemsize

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        part = TaskContext.get().partitionId()
        encoder = worker_encoder(tokenizer)
        attempt = uuid.uuid4().hex[:8]
        kinds = ("ids", "offsets", "docs")
        documents = tokens = 0
        files = None
        for batch in batches:
            for ids, texts, _ in slices(batch):
                if files is None:
                    files = [fs.open_output_stream(_part(root, part, f"{k}.{attempt}")) for k in kinds]
                    files[1].write(np.int64(0).tobytes())
                encoded = list(encoder.documents(texts, end_id))
                ends = tokens + np.cumsum([len(x) for x in encoded], dtype="<i8")
                files[0].write(np.concatenate(encoded).tobytes())
                files[1].write(ends.tobytes())
                files[2].write(np.array([NO_ID if x is None else x for x in ids], "<i8").tobytes())
                documents, tokens = documents + len(ids), int(ends[-1])
        if files is None:
            return
        for kind, file in zip(kinds, files, strict=True):
            file.close()
            fs.move(_part(root, part, f"{kind}.{attempt}"), _part(root, part, kind))
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array([part], pa.int32()),
                "documents": pa.array([documents], pa.int64()),
                "tokens": pa.array([tokens], pa.int64()),
            }
        )

    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).alias("text"),
        F.xxhash64(F.col(text_column)).alias("tie"),
    )
    ordered = rows.repartitionByRange(
        parts or partitions(spark), "doc_id", "tie"
    ).sortWithinPartitions("doc_id", "tie")
    written = stored(
        ordered.mapInArrow(write, "part int, documents long, tokens long"), "token-parts"
    )
    # One row per file: a prefix sum over them gives each part its place in the whole.
    listed = sorted(tuple(r) for r in written.collect())
    bases = zip(
        accumulate((r[1] for r in listed), initial=0),
        accumulate((r[2] for r in listed), initial=0),
        strict=True,
    )
    manifest = [(*row, width, *base) for row, base in zip(listed, bases, strict=False)]
    spark.createDataFrame(manifest, MANIFEST).coalesce(1).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def _mapped(fs: pafs.FileSystem, path: str, dtype: str) -> np.ndarray:
    """A file as an array: mapped into memory where it is local, read from a store otherwise."""
    if not fs.get_file_info(path).size:
        return np.zeros(0, dtype)
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, dtype, "r")
    with fs.open_input_file(path) as file:
        return np.frombuffer(file.read_buffer(), dtype)


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """Documents of a folder: doc_id, start (tokens before it in the whole), n_tokens, the CRC-32 of
    its ids as little-endian unsigned 32-bit integers, and the ids themselves if asked for."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    schema += ", ids array<long>" if with_ids else ""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for row in batch.to_pylist():
                part = row["part"]
                ids = _mapped(fs, _part(root, part, "ids"), f"<u{row['width']}")
                offsets = _mapped(fs, _part(root, part, "offsets"), "<i8")
                names = _mapped(fs, _part(root, part, "docs"), "<i8")
                for at in range(0, len(names), 4096):
                    name = names[at : at + 4096]
                    bounds = offsets[at : at + len(name) + 1]
                    each = [
                        ids[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)
                    ]
                    columns = {
                        "doc_id": pa.array(np.asarray(name), mask=np.asarray(name) == NO_ID),
                        "start": pa.array(row["token_base"] + np.asarray(bounds[:-1])),
                        "n_tokens": pa.array(np.diff(bounds)),
                        "ids_crc32": pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in each], pa.int64()),
                    }
                    if with_ids:
                        columns["ids"] = pa.array([x.astype(np.int64) for x in each], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_pydict(columns)

    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    return manifest.repartition(partitions(spark), "part").mapInArrow(read, schema)
