"""Packing documents into sequences of a fixed number of tokens.

Only the histogram of piece lengths decides how to pack, so the plan is made from at most
``capacity`` counts, and every piece finds its place from its rank among the pieces of its length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabgauge.llm.common import fresh, numbered, slices, stored, tidy
from fabgauge.llm.tokens import END_ID, worker_encoder

Pattern = tuple[tuple[int, ...], int]


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    capacity: int,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """Cut each document's ids, with ``end_id`` at the end, into pieces of at most ``capacity``.

    Only longer documents are cut, so that all pieces but the first are full. Returns doc_id, piece,
    start, length, ids_crc32 and, if asked for, ids. A null text is empty: one piece of length 1.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    schema += ", ids array<long>" if with_ids else ""

    @tidy
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer)
        for batch in batches:
            for names, texts in slices(batch):
                rows: list[tuple] = []
                for name, ids in zip(names, encoder.documents(texts, end_id), strict=True):
                    first = len(ids) % capacity or min(capacity, len(ids))
                    starts = [0, *range(first, len(ids), capacity)]
                    for k, start in enumerate(starts):
                        end = first if k == 0 else start + capacity
                        piece = ids[start:end].astype("<u4")
                        row = (name, k, start, len(piece), zlib.crc32(piece.tobytes()))
                        rows.append((*row, piece.astype(np.int64)) if with_ids else row)
                columns = list(zip(*rows, strict=True))
                arrays = [
                    pa.array(columns[0], pa.int64()),
                    pa.array(columns[1], pa.int32()),
                    *(pa.array(c, pa.int64()) for c in columns[2:5]),
                ]
                names_out = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array(columns[5], pa.list_(pa.int64())))
                    names_out.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names_out)
        encoder.shrink()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(cut, schema)


def _times(left: np.ndarray, lengths: tuple[int, ...]) -> int:
    return min(int(left[x]) // lengths.count(x) for x in set(lengths))


class _Sums:
    """Which sums the available lengths reach as a single, a pair or a triple.

    Lengths only run out, so an entry once found empty stays empty; an entry that still stands is
    checked against the counts when it is used.
    """

    def __init__(self, left: np.ndarray):
        self.left = left
        have = (left > 0).astype(np.float64)
        size = len(left)
        two = np.convolve(have, have)[:size]
        self.pairs = two > 0.5
        self.triples = np.convolve(self.pairs.astype(np.float64), have)[:size] > 0.5

    def _pair(self, gap: int, others: tuple[int, ...]) -> tuple[int, ...] | None:
        """Two lengths of sum ``gap``, the pair of which most are left."""
        big = np.arange(gap - 1, (gap - 1) // 2, -1)
        often = np.minimum(self.left[big], self.left[gap - big])
        for k in np.argsort(-often, kind="stable"):
            if often[k] <= 0:
                return None
            found = (*others, int(big[k]), int(gap - big[k]))
            if _times(self.left, found):
                return found
        return None

    def filling(self, first: int, gap: int, most: int) -> tuple[int, ...] | None:
        """``first`` and the fewest lengths, ``most`` at most, that fill ``gap`` exactly."""
        if gap == 0:
            return (first,)
        if most >= 1 and _times(self.left, (first, gap)):
            return (first, gap)
        if most >= 2 and self.pairs[gap]:
            if found := self._pair(gap, (first,)):
                return found
            self.pairs[gap] = False
        if most >= 3 and self.triples[gap]:
            ones = np.flatnonzero(self.left[:gap] > 0)
            for one in ones[self.pairs[gap - ones]][::-1]:
                if found := self._pair(gap - int(one), (first, int(one))):
                    return found
            self.triples[gap] = False
        return None


def _exact(left: np.ndarray, capacity: int, most: int) -> tuple[list[Pattern], np.ndarray]:
    """Sequences filled exactly, from the longest length down, and the counts of what remains."""
    plan: list[Pattern] = []
    residual = np.zeros_like(left)
    sums = _Sums(left)
    for first in range(capacity, 0, -1):
        while left[first]:
            found = sums.filling(first, capacity - first, most)
            if found is None:
                residual[first] = left[first]
                left[first] = 0
                break
            times = _times(left, found)
            for length in found:
                left[length] -= times
            plan.append((found, times))
    return plan, residual


def best_fit(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Pieces placed one by one, longest first, in the open sequence with the least room that takes them;
    all of one length at a time."""
    open_: dict[int, dict[tuple[int, ...], int]] = {}
    for length in range(capacity, 0, -1):
        count = int(counts[length])
        while count:
            room = min((r for r in open_ if r >= length), default=None)
            if room is None:
                contents, have, room = (), count, capacity
            else:
                contents, have = open_[room].popitem()
            # The least room is filled until it takes no more, then the next sequence of the kind.
            fit = room // length
            use = min(have, count // fit)
            placed = [(use, fit)] if use else [(1, count)]
            for bins, pieces in placed:
                inside = open_.setdefault(room - pieces * length, {})
                name = (*contents, *(length,) * pieces)
                inside[name] = inside.get(name, 0) + bins
                count -= bins * pieces
                have -= bins
            if contents and have:
                open_[room][contents] = have
            if room in open_ and not open_[room]:
                del open_[room]
    return [item for bins in open_.values() for item in bins.items()]


def plan_packing(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Contents of sequences and how many sequences have them, from counts of piece lengths.

    From the longest length down, the complement to ``capacity`` is looked up among single lengths,
    sums of pairs and sums of triples, and as many sequences are closed at once as the available
    pieces allow. Pieces without an exact complement are then placed by best fit. Combinations of many
    pieces spend the short ones that later long pieces need, so complements of up to three, two and one
    pieces and none are tried in turn, until a plan needs no more sequences than all tokens
    together; the plan with the fewest is taken, so it never has more than best fit alone.
    """
    pieces = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        if not 0 < length <= capacity:
            raise ValueError(f"piece of {length} tokens in sequences of {capacity}")
        pieces[length] += count
    least = -(-int((pieces * np.arange(capacity + 1)).sum()) // capacity)
    best, fewest = [], None
    for most in (3, 2, 1, 0):
        plan, residual = _exact(pieces.copy(), capacity, most) if most else ([], pieces)
        plan = plan + best_fit(residual, capacity)
        total = sum(times for _, times in plan)
        if fewest is None or total < fewest:
            best, fewest = plan, total
        if fewest == least:
            break
    return best


def pack_pieces(pieces: DataFrame, capacity: int) -> DataFrame:
    """Give every piece a ``sequence_id`` and an ``offset`` in it.

    ``pieces`` has doc_id, piece and length from 1 to ``capacity`` and is read several times, so
    give a stored table. Pieces of one length are interchangeable: they are ranked without
    gathering them, and a rank decides the sequence. Repeated rows are separate pieces, as are those of a null doc_id. An empty
    table gives no rows. Other columns are kept; sequence_id and offset are replaced.
    """
    pieces = pieces.drop("sequence_id", "offset")
    (place,) = fresh(pieces, "_rank")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    # Ranges of ranks, as (length, first rank, first sequence, offset); few, whatever the rows.
    ranges, used, sequence = [], dict.fromkeys(counts, 0), 0
    for contents, times in plan_packing(counts, capacity):
        at = 0
        for length in contents:
            ranges.append((length, used[length], sequence, at))
            used[length] += times
            at += length
        sequence += times
    ranges.sort()
    table = np.array(ranges or [(0, 0, 0, 0)], np.int64)
    lengths, ranks, sequences, offsets = (np.ascontiguousarray(c) for c in table.T)
    begins = np.searchsorted(lengths, np.arange(capacity + 2))

    @tidy
    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column(place).to_numpy(zero_copy_only=False)
            at = np.zeros(len(rank), np.int64)
            for one in np.unique(length):
                mine = length == one
                low, high = begins[one], begins[one + 1]
                at[mine] = low + np.searchsorted(ranks[low:high], rank[mine], "right") - 1
            kept = batch.drop_columns([place])
            yield kept.append_column(
                "sequence_id", pa.array(sequences[at] + rank - ranks[at])
            ).append_column("offset", pa.array(offsets[at]))

    ranked = numbered(pieces, ["length"], ["doc_id", "piece"], place)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    columns = pieces.columns
    return ranked.select(*columns, place).mapInArrow(
        placed, f"{schema}, sequence_id long, offset long"
    )


def packed_sequences(packed: DataFrame) -> DataFrame:
    """The ids of each sequence in order, from packed pieces that carry ``ids``."""
    inside = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(inside["ids"]).alias("ids"))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int) -> DataFrame:
    """Pieces of all documents with their places: see ``token_pieces`` and ``pack_pieces``."""
    return pack_pieces(stored(token_pieces(docs, tokenizer, capacity), "pieces"), capacity)
