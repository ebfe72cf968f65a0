"""Readers for sensor files, label files, event tables and stored results."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fabgauge.functions.columns import EVENT_REQUIRED_COLUMNS, require_columns
from fabgauge.functions.rules import coerce_numeric, nan_to_null
from fabgauge.operators import contracts
from fabgauge.session import fix, pin

# Missing-value tokens, raw file names, formats of the label file.
MISSING_TOKENS = ["NaN", "nan", "?"]
SENSOR_FILE, LABEL_FILE = "secom.data", "secom_labels.data"
LABEL_LINE = r"^\s*([+-]?\d+)\s+(.*\S)\s*$"
TIMESTAMP_FORMAT = "dd/MM/yyyy HH:mm:ss"
NOT_BLANK = r"value RLIKE '\\S'"
# Spellings a delimited file may use for a missing number.
EVENT_MISSING_TOKENS = ["", "NaN", "nan", "NA", "N/A", "null", "NULL", "None", "?"]


BLOCK = ["file_path", "file_block_start", "file_block_length"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Non-blank lines with their file block; ``_at`` counts up without gaps inside a block."""
    lines = spark.read.text(path).select("value", *[f"_metadata.{c}" for c in BLOCK])
    return lines.where(NOT_BLANK).withColumn("_at", F.monotonically_increasing_id())


def line_blocks(spark: SparkSession, path: str) -> DataFrame:
    """One pinned row per file block with a line: its key, ``first_at, lines, width, start``.

    ``width`` is the number of values in the block's first line, ``start`` the lines of all blocks before.
    """
    sizes = _lines(spark, path).groupBy(*BLOCK).agg(
        F.min("_at").alias("first_at"),
        F.count(F.lit(1)).alias("lines"),
        F.min_by(F.size(_tokens()), "_at").alias("width"),
    )
    before = Window.orderBy(*BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    return pin(sizes.withColumn("start", F.coalesce(F.sum("lines").over(before), F.lit(0))))


def numbered_lines(spark: SparkSession, path: str, blocks: DataFrame | None = None) -> DataFrame:
    """``line_no, value``: non-blank lines numbered from 0 in file order.

    One pass counts the lines of each file block, a second one adds a line's place inside its block, which
    the scan itself gives; the text is neither copied nor sorted. Should Spark cut the files otherwise the
    second time, because they or the cluster changed in between, the read fails and can be repeated.
    """
    lines = _lines(spark, path)
    blocks = line_blocks(spark, path) if blocks is None else blocks
    place = F.col("_at") - F.col("first_at")
    changed = F.raise_error(F.concat(F.lit("files are not cut as they were counted: "), "file_path"))
    number = F.when((place >= 0) & (place < F.col("lines")), F.col("start") + place)
    placed = lines.join(blocks.drop("width"), BLOCK, "left")
    return placed.select(
        F.coalesce(number, changed.cast("long")).cast("long").alias("line_no"), "value"
    )


def _first_width(blocks: DataFrame) -> int:
    """Values in the very first line, 0 without lines."""
    return blocks.agg(F.coalesce(F.min_by("width", "start"), F.lit(0))).first()[0]


def _line_count(blocks: DataFrame) -> int:
    return blocks.agg(F.coalesce(F.sum("lines"), F.lit(0))).first()[0]


def _tokens():
    return F.split(F.regexp_replace("value", r"^\s+|\s+$", ""), r"\s+")


def parse_sensor_lines(lines: DataFrame, width: int | None = None) -> DataFrame:
    """Split whitespace-separated values into ``sensor_000, sensor_001, ...``.

    The width, unless given, is that of line 0 where lines are numbered and else that of the
    longest line; shorter lines end in NULLs. Missing
    tokens become NULL; any other text that is no number, and a longer line, are errors.
    """
    parts = _tokens()
    if width is None:
        size = F.size(parts)
        if "line_no" in lines.columns:
            size = F.when(F.col("line_no") == 0, size)
        width = lines.agg(F.coalesce(F.max(size), F.lit(0))).first()[0]
    too_long = F.raise_error(F.concat(F.lit(f"more than {width} values in line: "), "value"))
    fitting = F.when(F.size(parts) <= width, parts).otherwise(too_long)
    tokens = lines.withColumn("_parts", fitting)
    others = [c for c in lines.columns if c != "value"]

    def number(i: int):
        token = F.get(F.col("_parts"), F.lit(i))
        return F.when(token.isin(MISSING_TOKENS), None).otherwise(token.cast("double"))

    return tokens.select(*others, *[number(i).alias(f"sensor_{i:03d}") for i in range(width)])


def read_sensor_matrix(spark: SparkSession, path: str) -> DataFrame:
    """The sensor columns; their number is that of the values in the first line."""
    lines = spark.read.text(path).where(NOT_BLANK)
    return parse_sensor_lines(lines, _first_width(line_blocks(spark, path)))


def parse_label_lines(lines: DataFrame) -> DataFrame:
    """``label, timestamp, recorded_at``: the raw text and, beside it, the parsed time."""
    bad = lines.where(~F.col("value").rlike(LABEL_LINE)).select("value")
    contracts.assert_empty(bad, "Invalid label rows, expected label and timestamp")
    text = F.regexp_extract("value", LABEL_LINE, 2)
    others = [c for c in lines.columns if c != "value"]
    return lines.select(
        *others,
        F.regexp_extract("value", LABEL_LINE, 1).cast("int").alias("label"),
        text.alias("timestamp"),
        F.try_to_timestamp(F.replace(text, F.lit('"'), F.lit("")), F.lit(TIMESTAMP_FORMAT)).alias(
            "recorded_at"
        ),
    )


def read_label_lines(spark: SparkSession, path: str) -> DataFrame:
    return parse_label_lines(spark.read.text(path).where(NOT_BLANK))


def assemble_samples(spark: SparkSession, sensor_path: str, label_path: str) -> DataFrame:
    """Line up the two files: ``sample_id, sensor_000.., label, timestamp``."""
    sensor_blocks, label_blocks = line_blocks(spark, sensor_path), line_blocks(spark, label_path)
    contracts.assert_same_count(
        _line_count(sensor_blocks), _line_count(label_blocks), "Sensor and label"
    )
    sensors = numbered_lines(spark, sensor_path, sensor_blocks)
    labels = numbered_lines(spark, label_path, label_blocks)
    joined = parse_sensor_lines(sensors, _first_width(sensor_blocks)).join(
        parse_label_lines(labels).drop("recorded_at"), "line_no"
    )
    return joined.withColumnRenamed("line_no", "sample_id")


def read_samples(spark: SparkSession, folder: str) -> DataFrame:
    """Samples from a folder that holds the two raw files under their usual names."""
    return assemble_samples(spark, f"{folder}/{SENSOR_FILE}", f"{folder}/{LABEL_FILE}")


def event_schema(features: Iterable[str]) -> T.StructType:
    flags = {"StepID": T.LongType(), "target": T.IntegerType(), "is_test": T.IntegerType()}
    names = [*EVENT_REQUIRED_COLUMNS[:3], *features, *EVENT_REQUIRED_COLUMNS[3:]]
    kinds = {"MaterialID": T.StringType(), **flags}
    return T.StructType([T.StructField(n, kinds.get(n, T.DoubleType())) for n in names])


def read_event_csv(
    spark: SparkSession, path: str, check: bool = True, checkpointed: bool = False
) -> DataFrame:
    """Event table from a CSV file with header, in the column order of the file.

    Every column is read as text and typed here: ids as text, steps and flags as whole
    numbers, all else as double. The spellings of a missing number become NULL, never NaN;
    other text in a number column becomes NULL as well. A step or flag that isn't whole is an
    error, or NULL if ``check`` is off. The checks read the file on their own; ``store_event_csv`` writes
    first and reads it once.
    """
    events = _typed_events(spark, path, check)
    if check:
        check_events(events)
    return fix(events) if checkpointed else events


def store_event_csv(spark: SparkSession, path: str, table_path: str) -> DataFrame:
    """Turn a CSV file into a checked parquet table with one pass over the text.

    The checks of ``read_event_csv`` read the few columns they need from the written table; so it exists when
    they raise, and must not be used then. Metrics observed by the writing job would save that read, but a
    session that has observed any can't run some models afterwards: their tasks no longer serialize.
    """
    events = _typed_events(spark, path, check=True)
    events.write.mode("overwrite").parquet(table_path)
    stored = spark.read.schema(events.schema).parquet(table_path)
    check_events(stored)
    return stored


def _typed_events(spark: SparkSession, path: str, check: bool) -> DataFrame:
    raw = spark.read.csv(path, header=True)
    require_columns(raw, EVENT_REQUIRED_COLUMNS, "Event table")

    def typed(name: str):
        text = F.col(f"`{name}`")
        known = F.when(~F.trim(text).isin(EVENT_MISSING_TOKENS), text)
        if name == "MaterialID":
            return known.alias(name)
        number = coerce_numeric(known)
        whole = {"StepID": "long", "target": "int", "is_test": "int"}.get(name)
        if whole is None:
            return number.alias(name)
        broken = F.concat(F.lit(f"{name} holds a number that is not whole: "), text)
        otherwise = F.raise_error(broken) if check else F.lit(None)
        is_whole = number.isNull() | (number == F.floor(number))
        return F.when(is_whole, number.cast(whole)).otherwise(otherwise.cast(whole)).alias(name)

    return raw.select(*[typed(c) for c in raw.columns])


def check_events(events: DataFrame) -> None:
    """Flags are 0/1 and constant per material."""
    require_columns(events, EVENT_REQUIRED_COLUMNS, "Event table")
    for flag in ("target", "is_test"):
        contracts.assert_binary(events, flag)
        contracts.assert_constant_in_group(events, "MaterialID", flag)


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    required: Iterable[str] = (),
) -> DataFrame:
    """A stored result: parquet, or CSV with header and schema when the name ends in .csv."""
    if str(path).endswith(".csv"):
        reader = spark.read.option("header", True).option("nullValue", "")
        table = nan_to_null((reader.schema(schema) if schema else reader).csv(path))
    else:
        table = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    require_columns(table, required, str(path))
    return table


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """A JSON document, or a folder of one-line documents, with nested fields as structs."""
    return spark.read.json(path, multiLine=True)
