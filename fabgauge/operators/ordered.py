"""Exact ranks, running sums and medians over groups of any size.

A plain window partitioned by label, model or feature sorts one whole group in one task.
Here the ordering key is cut into cells first. Cuts come from approximate percentiles and
only balance the work: any cuts give the same exact result. Rows per cell are counted with
map-side combining, the small table of cell totals gives each cell its offset, and windows
then run inside a cell.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal
from os.path import commonprefix

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fabgauge.session import pin

MIN_CELLS, MAX_CELLS = 16, 64
# Equal pieces a median bracket is cut into, at most.
SMALL_PIECES = 256
# Half width of the percentile bracket kept around a median, and its sketch accuracy.
MEDIAN_MARGIN = 0.005
SKETCH_ACCURACY = 2000
# Bytes of a text, after the beginning that all texts share, that fit a positive long.
TEXT_BYTES = 7


@dataclass(frozen=True)
class Cuts:
    """Distinct cut values of a numeric column, and pieces per interval between two of them."""

    values: tuple
    pieces: int


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def cut_points(df: DataFrame, columns: Sequence[str]) -> dict[str, Cuts]:
    """Approximate percentiles of numeric columns, in one pass.

    There are about as many cells as shuffle partitions. Up to MAX_CELLS of them are told
    apart by cut values; beyond that the intervals are cut again into equal widths.
    """
    partitions = shuffle_partitions(df)
    cells = max(MIN_CELLS, min(MAX_CELLS, partitions))
    shares = [i / cells for i in range(cells + 1)]
    row = df.agg(
        *[F.percentile_approx(c, shares, 20 * cells).alias(c) for c in columns]
    ).first()
    pieces = -(-partitions // cells)
    return {c: Cuts(tuple(sorted(set(row[c] or []))), pieces) for c in columns}


def order_number(df: DataFrame, column: str) -> tuple[Column, bool]:
    """A number that never falls as the value grows, and whether it tells all values apart."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.NumericType):
        return F.col(column), True
    if isinstance(kind, T.DateType):
        return F.unix_date(column), True
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column), True
    if isinstance(kind, (T.StringType, T.BinaryType)):
        ends = df.agg(F.min(column), F.max(column)).first()
        raw = [e.encode() if isinstance(e, str) else bytes(e or b"") for e in ends]
        start = len(commonprefix(raw)) + 1
        part = f"substring(cast(`{column}` AS binary), {start}, {TEXT_BYTES})"
        number = f"conv(hex(rpad({part}, {TEXT_BYTES}, X'00')), 16, 10)"
        return F.expr(f"cast({number} AS long)"), False
    raise TypeError(f"rows can't be ranked by {column} of type {kind.simpleString()}")


def _place(column: str, values: Sequence[float | int | Decimal]) -> Column:
    """``2k + 1`` for exactly the cut value k, ``2k`` for the open interval below it.

    The search is a balanced tree of comparisons inside generated code.
    """

    def literal(value: float | int | Decimal) -> str:
        if isinstance(value, Decimal):
            return f"{value:f}BD"
        return f"DOUBLE('{value!r}')" if isinstance(value, float) else f"{value}L"

    def search(low: int, high: int) -> str:
        if low == high:
            return str(2 * low)
        middle = (low + high) // 2
        cut = literal(values[middle])
        return (
            f"CASE WHEN `{column}` < {cut} THEN {search(low, middle)} "
            f"WHEN `{column}` = {cut} THEN {2 * middle + 1} ELSE {search(middle + 1, high)} END"
        )

    return F.expr(search(0, len(values)))


def with_cell(df: DataFrame, column: str, cuts: Cuts, name: str) -> DataFrame:
    """Add the number of the cell a value falls in, growing with the value; -1 for NULL.

    ``<name>_single`` tells whether the cell holds one value only.
    """
    placed = df.withColumn(name, _place(column, cuts.values))
    place, value = F.col(name), F.col(column)
    # Rounding keeps the pieces of an interval in value order; the open ends have one piece.
    ends = F.lit([float(v) for v in cuts.values] or [0.0])
    lower, upper = F.get(ends, F.expr(f"{name} DIV 2 - 1")), F.get(ends, F.expr(f"{name} DIV 2"))
    piece = F.floor((value - lower) / (upper - lower) * cuts.pieces).cast("int")
    piece = F.coalesce(F.greatest(F.lit(0), F.least(F.lit(cuts.pieces - 1), piece)), F.lit(0))
    number = place * cuts.pieces
    if cuts.pieces > 1:
        number = number + F.when(place % 2 == 0, piece).otherwise(0)
    return placed.withColumns(
        {
            name: F.when(value.isNull(), -1).otherwise(number),
            f"{name}_single": value.isNull() | (place % 2 == 1),
        }
    )


def cell_offsets(
    df: DataFrame, group: Sequence[str], cells: Sequence[str], sums: dict[str, Column]
) -> DataFrame:
    """Totals of all earlier cells of the group, per cell, as a pinned table."""
    totals = df.groupBy(*group, *cells).agg(*[e.alias(n) for n, e in sums.items()])
    before = (
        Window.partitionBy(*group).orderBy(*cells).rowsBetween(Window.unboundedPreceding, -1)
    )
    return pin(
        totals.select(
            *group,
            *cells,
            *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n) for n in sums],
        )
    )


def with_rank(
    df: DataFrame,
    group: Sequence[str],
    key: str,
    tie: str,
    descending: bool = True,
    name: str = "rank",
) -> DataFrame:
    """Add the 1-based position of each row in its group by ``key``, then ``tie`` ascending.

    NULL keys come last. A key value shared by many rows gets a cell of its own, which is cut
    again by ``tie``, so one repeated value does not end up in one task. Keys and ties are
    numbers, dates, timestamps or texts (in byte order); a text key shared by many rows is not
    cut again. Other types raise a TypeError.
    """
    (key_number, exact), (tie_number, _) = order_number(df, key), order_number(df, tie)
    numbers = df.withColumns({"_key": key_number, "_tie": tie_number})
    cuts = cut_points(numbers, ["_key", "_tie"])
    placed = with_cell(numbers, "_key", cuts["_key"], "_cell")
    placed = with_cell(placed, "_tie", cuts["_tie"], "_tie_cell")
    cell, last = F.col("_cell"), (2 * len(cuts["_key"].values) + 1) * cuts["_key"].pieces
    single = F.col("_cell_single") if exact else F.col("_key").isNull()
    placed = placed.withColumns(
        {
            "_cell": F.when(cell == -1, last if not descending else 1).otherwise(
                -cell if descending else cell
            ),
            "_tie_cell": F.when(single, F.col("_tie_cell")).otherwise(0),
        }
    ).drop("_cell_single", "_tie_cell_single", "_key", "_tie")
    keys = ["_cell", "_tie_cell"]
    offsets = cell_offsets(placed, group, keys, {"_before": F.count(F.lit(1))})
    order = F.col(key).desc_nulls_last() if descending else F.col(key).asc_nulls_last()
    inside = Window.partitionBy(*group, *keys).orderBy(order, F.col(tie).asc())
    return (
        placed.join(offsets, [*group, *keys])
        .withColumn(name, F.row_number().over(inside) + F.col("_before"))
        .drop(*keys, "_before")
    )


def hash_key(*parts: Column | str | int) -> Column:
    """md5 text of the parts joined by ``|``: a seeded, repeatable shuffle key."""
    columns = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in columns]))


def with_hash_rank(
    df: DataFrame, group: Sequence[str], key: str, tie: str, name: str
) -> DataFrame:
    """Like ``with_rank`` ascending, for md5 keys: their first digits are even cells already."""
    digits = 2 if shuffle_partitions(df) <= 256 else 3
    placed = df.withColumn("_cell", F.substring(key, 1, digits))
    offsets = cell_offsets(placed, group, ["_cell"], {"_before": F.count(F.lit(1))})
    inside = Window.partitionBy(*group, "_cell").orderBy(key, tie)
    return (
        placed.join(offsets, [*group, "_cell"])
        .withColumn(name, F.row_number().over(inside) + F.col("_before"))
        .drop("_cell", "_before")
    )


def exact_median(
    df: DataFrame,
    group: Sequence[str],
    value: str,
    margin: float = MEDIAN_MARGIN,
    accuracy: int = SKETCH_ACCURACY,
) -> DataFrame:
    """Exact interpolated median of the non-null values per group, as a pinned table.

    One pass sketches a narrow bracket around each median; a second pass counts what lies
    below it and groups the values inside it. Only the bracket is sorted, not the group.
    The result holds the groups with at least one value: ``group..., n, median``.
    """
    values = df.select(*group, F.col(value).alias("_v")).where("_v IS NOT NULL")
    ends = F.percentile_approx("_v", [0.5 - margin, 0.5 + margin], accuracy)
    brackets = pin(
        values.groupBy(*group)
        .agg(F.count("_v").alias("n"), ends.alias("_ends"))
        .select(
            *group, "n", F.col("_ends")[0].alias("_low"), F.col("_ends")[1].alias("_high")
        )
    )
    found = pin(_medians_in(values, group, brackets).where("hit").drop("hit"))
    missed = brackets.select(*group).join(found, list(group), "left_anti")
    if missed.isEmpty():
        return found
    # The sketch gives no hard bound, so groups it misplaced are bracketed again, twice as wide.
    wider = exact_median(
        values.join(missed, list(group), "left_semi"),
        group,
        "_v",
        min(2 * margin, 0.5),
        2 * accuracy,
    )
    return pin(found.unionByName(wider))


def _medians_in(values: DataFrame, group: Sequence[str], brackets: DataFrame) -> DataFrame:
    group = list(group)
    # The bracket is cut into pieces of equal width; all values under it share one NULL entry.
    pieces = max(MIN_CELLS, min(SMALL_PIECES, shuffle_partitions(values)))
    width = "(_high - _low)"
    piece = f"least({pieces - 1}, floor((_v - _low) / {width} * {pieces}))"
    entries = (
        values.join(brackets, group)
        .where("_v <= _high")
        .selectExpr(
            *group,
            "n",
            f"CASE WHEN _v < _low THEN -1 WHEN {width} > 0 AND {width} < 1e300 THEN {piece} "
            "ELSE 0 END AS _cell",
            "CASE WHEN _v >= _low THEN _v END AS _v",
        )
        .groupBy(*group, "n", "_cell", "_v")
        .agg(F.count(F.lit(1)).alias("_c"))
        .withColumns({"_lower": F.expr("(n + 1) DIV 2"), "_upper": F.expr("n DIV 2 + 1")})
    )
    # Only the one or two pieces that hold the middle ranks of a group are sorted.
    earlier = (
        Window.partitionBy(*group, "_lower", "_upper")
        .orderBy("_cell")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    middle = (
        entries.groupBy(*group, "_lower", "_upper", "_cell")
        .agg(F.sum("_c").alias("_size"))
        .withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
        .where("_before < _upper AND _before + _size >= _lower")
        .select(*group, "_cell", "_before")
    )
    upto = (
        Window.partitionBy(*group, "_cell")
        .orderBy(F.col("_v").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        entries.join(middle, [*group, "_cell"])
        .withColumn("_to", F.sum("_c").over(upto) + F.col("_before"))
        .groupBy(*group, "n", "_lower", "_upper")
        .agg(
            F.min(F.expr("CASE WHEN _to >= _lower THEN _v END")).alias("_a"),
            F.min(F.expr("CASE WHEN _to >= _upper THEN _v END")).alias("_b"),
            F.max(F.expr("_cell = -1")).alias("_under"),
            F.max("_to").alias("_reached"),
        )
        .select(
            *group,
            "n",
            ((F.col("_a") + F.col("_b")) / 2).alias("median"),
            (~F.col("_under") & (F.col("_reached") >= F.col("_upper"))).alias("hit"),
        )
    )
