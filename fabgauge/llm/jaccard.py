"""Exact Jaccard join on word shingles with a token-group matrix, and its connected components.

1. Documents with equal sets are one class. Classes that share a band of minimum hashes are compared
   with the first class of the band; those found linked form groups of similar documents.
2. Each group stores the deciding tokens of its members, not all of them:
   if two sets are similar enough, they share one of the first tokens (rarest first) of each.
   An entry also says how large a set its token can still lead to; groups without a common entry
   that allows both sizes can't hold linked documents and are never opened.
3. The other pairs of groups are opened. The task that opens one reads the texts of its members, cell by
   cell, builds the union of a cell's tokens, and compares members of the smaller group with those of
   the cell only if their overlap with the union allows a link.

This departs from a matrix of stored unions: no union is kept, and the bound by it comes after opening.
A group is connected already, so one link into it is enough, and no pair inside it is looked at.
Hashes are 64 bits wide; equal hashes are taken for equal words and shingles.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabgauge.llm.common import SLICE, fresh, numbered, partitions, sorted_unique, stored, tidy
from fabgauge.llm.components import components

# Two documents link if 100 * common >= PERCENT * union.
PERCENT, WORDS = 75, 5
# Bands of minimum hashes for the first groups; they speed the join up and decide nothing.
BANDS, BAND_ROWS = 6, 2
# Documents whose tokens show which are very common, and how many of them must hold such a token.
SAMPLE, COMMON = 8000, 8
# A token in more than so many documents is common. Tokens are counted in all documents as far as they
# are in the first part of the hash range, from which deciding tokens are taken; the
# result is kept as a filter of bounded size.
RARE, COUNTED, COMMON_BITS = 4, 0.4, 1 << 25
# Tokens in a cell of an opened group, and documents compared with a cell in one task.
CELL_TOKENS, CELL_QUERIES = 100_000, 256
# Bits of the filter by which texts are read again: a bounded size, whatever the number of ids.
FILTER_BITS = 1 << 23
# Postings that a task turns into distinct entries of the matrix at a time.
POSTINGS = 2_000_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BANDS = np.random.default_rng(7).integers(1, 2**63, BANDS * BAND_ROWS, np.uint64) | np.uint64(1)


def shingles(text: str | None, below: np.uint64 | None = None) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a whole text (A-Z lower-cased); only those under
    ``below`` if that is given."""
    words = (text or "").encode().lower().split()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    if not words:
        return hashes
    width = min(WORDS, len(words))
    count = len(words) - width + 1
    code = np.full(count, width, np.uint64)
    for k in range(width):
        code = (code ^ hashes[k : k + count]) * _MIX
        code ^= code >> np.uint64(29)
    code = np.sort(code if below is None else code[code < below])
    return code[np.concatenate(([True], code[1:] != code[:-1]))] if len(code) else code


def common_count(one: np.ndarray, other: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(one) > len(other):
        one, other = other, one
    if not len(one):
        return 0
    at = np.minimum(np.searchsorted(other, one), len(other) - 1)
    return int(np.count_nonzero(other[at] == one))


def linked(one: np.ndarray, other: np.ndarray) -> bool:
    small, large = sorted((len(one), len(other)))
    if not small or 100 * small < PERCENT * large:
        return False
    both = common_count(one, other)
    return 100 * both >= PERCENT * (small + large - both)


def deciding(
    tokens: np.ndarray, common: np.ndarray, often: np.ndarray, marked: np.ndarray
) -> np.ndarray:
    """The first tokens of a set, rarest first, of which two linked sets must share one.

    The order is by rarity class, then hash. It is the same for all documents, which is all that
    matters for finding every link; a rare token that the filter takes for common only comes later.
    """
    size = len(tokens) - -(-PERCENT * len(tokens) // 100) + 1
    if not len(tokens):
        return tokens
    bit = (tokens & np.uint64(COMMON_BITS - 1)).astype(np.int64)
    count = ((marked[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1).astype(np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, tokens), len(common) - 1)
        count = np.where(common[at] == tokens, often[at], count)
    # 16 bits are sorted by digits; the sample holds far fewer documents than they can count.
    count = np.minimum(count, 2**16 - 1).astype(np.uint16)
    return tokens[np.argsort(count, kind="stable")[:size]]


def histogram(tokens: np.ndarray) -> np.ndarray:
    """How many tokens fall into each equal part of the range; about two on average."""
    bits = max(4, int(len(tokens) // 2).bit_length())
    counts = np.bincount((tokens >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return np.minimum(counts, 255).astype(np.uint8)


def may_link(one: bytes, other: bytes, sizes: tuple[int, int]) -> bool:
    """Whether two histograms leave room for a link: the smaller count of each part bounds the
    intersection from above."""
    a, b = (np.frombuffer(x, np.uint8).astype(np.int64) for x in (one, other))
    a, b = (np.where(x == 255, 1 << 40, x) for x in (a, b))
    width = min(len(a), len(b))
    bound = np.minimum(a.reshape(width, -1).sum(1), b.reshape(width, -1).sum(1)).sum()
    return (100 + PERCENT) * int(bound) >= PERCENT * sum(sizes)


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingles(t) for t in batch.column("text").to_pylist()]
        tokens, counts = sorted_unique(np.concatenate([np.zeros(0, np.uint64), *sets]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(tokens.view(np.int64)), pa.array(counts.astype(np.int64))], names=["token", "n"]
        )


def common_tokens(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Tokens held by at least COMMON documents of a sample of about SAMPLE, sorted, and how many hold
    them. They only decide which tokens count as rare; any other choice gives the same links."""
    count = docs.count()
    if not count:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    share = min(1.0, SAMPLE / count)
    sample = docs.filter(F.pmod(F.xxhash64("doc_id", F.lit("common")), F.lit(2**30)) < int(share * 2**30))
    found = (
        sample.select("text")
        .mapInArrow(_count_tokens, "token long, n long")
        .groupBy("token")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= COMMON)
        .toArrow()
    )
    tokens = found.column("token").to_numpy().view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], found.column("n").to_numpy()[order]


def common_filter(docs: DataFrame) -> np.ndarray:
    """Bits of COMMON_BITS, set where a counted token is in more than RARE documents."""
    spark = docs.sparkSession
    parts = 4 * partitions(spark)
    first = np.uint64(int(COUNTED * 2**64))

    @tidy
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            tokens = np.concatenate(held)
            held.clear()
            part = ((tokens >> np.uint64(40)) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            low = (tokens & np.uint64(2**32 - 1)).astype("<u4")[order]
            ends = np.cumsum(np.bincount(part, minlength=parts))
            blobs = [x.tobytes() for x in np.split(low, ends[:-1])]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.arange(parts, dtype=np.int32)), pa.array(blobs, pa.binary())],
                names=["part", "tokens"],
            )

        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                for text in batch.column("text").slice(at, SLICE).to_pylist():
                    held.append(shingles(text, first))
                if sum(map(len, held)) >= POSTINGS:
                    yield flush()
        if held:
            yield flush()

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []

        def marks() -> pa.RecordBatch:
            tokens, counts = sorted_unique(np.frombuffer(b"".join(held), "<u4"))
            held.clear()
            bits = np.unique(tokens[counts > RARE] & np.uint32(COMMON_BITS - 1)).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(bits)], names=["bit"])

        for batch in batches:
            for key, blob in zip(batch.column("part").to_pylist(), batch.column("tokens").to_pylist(), strict=True):
                if key != part and held:
                    yield marks()
                part = key
                held.append(blob)
        if held:
            yield marks()

    bits = (
        docs.select("text")
        .mapInArrow(split, "part int, tokens binary")
        .repartition(parts, "part")
        .sortWithinPartitions("part")
        .mapInArrow(count, "bit long")
    )
    # At most COMMON_BITS / 64 rows.
    words = (
        bits.groupBy(F.shiftright("bit", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
        .toArrow()
    )
    marked = np.zeros(COMMON_BITS // 64, np.int64)
    marked[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return marked.view(np.uint8)


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n (set size), sign (digest of the set, null if empty), band_0.., deciding tokens and
    histogram of every row with an id."""
    known = docs.sparkSession.sparkContext.broadcast((*common_tokens(docs), common_filter(docs)))

    @tidy
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, often, marked = known.value
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                sets = [shingles(t) for t in part.column("text").to_pylist()]
                rows = []
                for tokens in sets:
                    if not len(tokens):
                        rows.append((None, *[0] * BANDS, b"", b""))
                        continue
                    least = np.array([(tokens * m).min() for m in _BANDS])
                    bands = [
                        xxhash.xxh3_64_intdigest(least[b * BAND_ROWS : (b + 1) * BAND_ROWS].tobytes()) - 2**63
                        for b in range(BANDS)
                    ]
                    sign = xxhash.xxh3_128_digest(tokens.tobytes())
                    rows.append(
                        (sign, *bands, deciding(tokens, common, often, marked).tobytes(), histogram(tokens).tobytes())
                    )
                columns = list(zip(*rows, strict=True))
                kinds = [pa.binary(), *[pa.int64()] * BANDS, pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True)),
                    ],
                    names=["doc_id", "n", "sign", *(f"band_{b}" for b in range(BANDS)), "tokens", "parts"],
                )

    bands = "".join(f", band_{b} long" for b in range(BANDS))
    schema = f"doc_id long, n long, sign binary{bands}, tokens binary, parts binary"
    return docs.mapInArrow(sketch, schema)


def among(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows whose id may be among ``ids`` (column id), by a bit filter of bounded size; all that are,
    and few others as long as the filter isn't crowded."""
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))
    words = (
        ids.select(place(F.col("id")).alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("_word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("_bits"))
    )
    # At most FILTER_BITS / 64 rows of two numbers.
    marked = rows.withColumn("_bit", place(F.col(column))).withColumn("_word", F.shiftright("_bit", 6))
    return (
        marked.join(F.broadcast(words), "_word")
        .filter(F.expr("(shiftrightunsigned(_bits, cast(_bit & 63 as int)) & 1) = 1"))
        .select(*rows.columns)
    )


def open_cells(docs: DataFrame, members: DataFrame, queries: DataFrame) -> DataFrame:
    """Links (a, b) of queries (columns cell, cell_no, id, queries) with members (cell, cell_no, id):
    for each query and cell the first member it links to.

    ``queries`` per cell is given, so that a cell with many is opened by several tasks.
    """
    salts = F.ceil(F.col("asked") / CELL_QUERIES).cast("int")
    asked = queries.groupBy("cell", "cell_no").agg(F.count(F.lit(1)).alias("asked"))
    inside = (
        members.join(asked, ["cell", "cell_no"])
        .withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        .select("cell", "cell_no", "salt", F.lit(0).alias("kind"), "id")
    )
    outside = (
        queries.join(asked, ["cell", "cell_no"])
        .withColumn("salt", F.pmod(F.xxhash64("id"), salts).cast("int"))
        .select("cell", "cell_no", "salt", F.lit(1).alias("kind"), "id")
    )
    wanted = stored(inside.unionByName(outside), "cells")
    texts = among(docs, "doc_id", wanted.select("id")).withColumnRenamed("doc_id", "id")
    return (
        wanted.join(texts, "id")
        .repartition(4 * partitions(docs.sparkSession), "cell", "cell_no", "salt")
        .sortWithinPartitions("cell", "cell_no", "salt", "kind")
        .mapInArrow(_compare, "a long, b long")
    )


@tidy
def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by cell, members first: keep one cell, and bound and compare what comes to it."""
    cell, members, union = None, [], None
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE).to_pydict()
            found = []
            keys = zip(part["cell"], part["cell_no"], part["salt"], strict=True)
            for key, kind, name, text in zip(keys, part["kind"], part["id"], part["text"], strict=True):
                if key != cell:
                    cell, members, union = key, [], None
                tokens = shingles(text)
                if kind == 0:
                    members.append((name, tokens))
                    continue
                if len(members) > 1:
                    if union is None:
                        union = np.unique(np.concatenate([t for _, t in members]))
                    if 100 * common_count(tokens, union) < PERCENT * len(tokens):
                        continue
                other = next((m for m, t in members if m != name and linked(tokens, t)), None)
                if other is not None:
                    found.append((name, other))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"]
            )


@tidy
def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct (token, group) of the deciding tokens of a task's documents, with the smallest set that
    holds the token and the largest set that a link through it allows.

    If a token is the first that two sets share, the intersection holds at most the tokens of each from
    there on. With ``rest`` of them in a set of size n, the other set has at most
    ((100 + PERCENT) * rest - PERCENT * n) / PERCENT tokens.
    """
    tokens, groups, sizes, most, held = [], [], [], [], 0

    def flush() -> pa.RecordBatch:
        nonlocal held
        t, g, s, m = (np.concatenate(each) for each in (tokens, groups, sizes, most))
        for each in (tokens, groups, sizes, most):
            each.clear()
        held = 0
        order = np.lexsort((g, t))
        t, g, s, m = t[order], g[order], s[order], m[order]
        new = np.flatnonzero(np.concatenate(([True], (t[1:] != t[:-1]) | (g[1:] != g[:-1]))))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(t[new].view(np.int64)),
                pa.array(g[new]),
                pa.array(np.minimum.reduceat(s, new).astype(np.int32)),
                pa.array(np.maximum.reduceat(m, new).astype(np.int32)),
            ],
            names=["token", "cell", "least", "most"],
        )

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("cell", "n", "tokens")]
        for group, n, packed in zip(*columns, strict=True):
            mine = np.frombuffer(packed, np.uint64)
            rest = n - np.arange(len(mine), dtype=np.int64)
            tokens.append(mine)
            groups.append(np.full(len(mine), group, np.int64))
            sizes.append(np.full(len(mine), n, np.int64))
            most.append(((100 + PERCENT) * rest - PERCENT * n) // PERCENT)
            held += len(mine)
            if held >= POSTINGS:
                yield flush()
    if held:
        yield flush()


@tidy
def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by token and least size: pairs of groups that share a token which allows both sizes."""
    names = ("token", "cell", "least", "most")
    rest = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32))

    def paired(t: np.ndarray, g: np.ndarray, least: np.ndarray, most: np.ndarray) -> pa.RecordBatch:
        first, last = [], []
        # Neighbours at distance 1, 2, ... within runs of one token, until the sizes grow too large.
        near, far = np.arange(len(t) - 1), 1
        while len(near):
            near = near[near + far < len(t)]
            near = near[(t[near + far] == t[near]) & (least[near + far] <= most[near])]
            one, two = g[near], g[near + far]
            open_ = (one != two) & (least[near] <= most[near + far])
            first.append(np.minimum(one, two)[open_])
            last.append(np.maximum(one, two)[open_])
            far += 1
        empty = np.zeros(0, np.int64)
        both = np.unique(np.stack([np.concatenate([empty, *first]), np.concatenate([empty, *last])], 1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["one", "two"])

    for batch in batches:
        held = [
            np.concatenate([old, batch.column(c).to_numpy(zero_copy_only=False)])
            for old, c in zip(rest, names, strict=True)
        ]
        t = held[0]
        whole = np.searchsorted(t, t[-1]) if len(t) else 0
        rest = tuple(x[whole:] for x in held)
        if whole:
            yield paired(*(x[:whole] for x in held))
    if len(rest[0]):
        yield paired(*rest)


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs`` (doc_id, text).

    Null and empty texts have no shingles and are their own component. Repeated rows are each
    returned, with the same component. Rows with a null id link with nothing: their component is
    null. Other columns are ignored; an empty table gives no rows.
    """
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    named = read.filter("doc_id IS NOT NULL")
    sketched = stored(sketches(read), "sketches")
    full = sketched.filter("doc_id IS NOT NULL AND n > 0")
    bands = [F.min(f"band_{b}").alias(f"band_{b}") for b in range(BANDS)]
    classes = stored(
        full.groupBy("sign").agg(F.min("doc_id").alias("id"), F.min("n").alias("n"), *bands), "classes"
    )

    # First groups: classes linked to the first one of a band.
    banded = classes.select(
        "id", F.posexplode(F.array(*[f"band_{b}" for b in range(BANDS)])).alias("band", "value")
    )
    leaders = banded.groupBy("band", "value").agg(F.min("id").alias("cell"), F.max("id").alias("last"))
    leaders = leaders.filter("cell < last").drop("last")
    near = banded.join(leaders, ["band", "value"]).filter("id <> cell").select("cell", "id").distinct()
    near = stored(near.withColumn("cell_no", F.lit(0)), "near")
    firsts = near.select("cell", "cell_no", F.col("cell").alias("id")).distinct()
    links = stored(open_cells(named, firsts, near), "links")
    grouped = components(links).select("id", F.col("component").alias("cell"))

    # The matrix, and pairs of groups with a common entry.
    nodes = stored(
        classes.select("id", "n").join(grouped, "id", "left").withColumn("cell", F.coalesce("cell", "id")),
        "nodes",
    )
    sizes = stored(
        nodes.groupBy("cell").agg(
            F.count(F.lit(1)).alias("size"),
            F.sum("n").alias("tokens"),
        ),
        "groups",
    )
    matrix = (
        full.select(F.col("doc_id").alias("id"), "n", "tokens")
        .join(nodes.select("id", "cell"), "id")
        .select("cell", "n", "tokens")
        .mapInArrow(_entries, "token long, cell long, least int, most int")
    )
    pairs = (
        matrix.repartition(4 * partitions(docs.sparkSession), "token")
        .sortWithinPartitions("token", "least")
        .mapInArrow(_pairs, "one long, two long")
        .distinct()
    )
    side = lambda name: sizes.select(
        F.col("cell").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in sizes.columns[1:]]
    )
    pairs = stored(pairs.join(side("one"), "one").join(side("two"), "two"), "group-pairs")
    pairs = _bounded(pairs, full)

    # Members of the smaller group go to all cells of the larger one.
    ask_one = F.col("one_size") <= F.col("two_size")
    opened = pairs.select(
        F.when(ask_one, F.col("one")).otherwise(F.col("two")).alias("from"),
        F.when(ask_one, F.col("two")).otherwise(F.col("one")).alias("cell"),
        F.ceil(F.when(ask_one, F.col("two_tokens")).otherwise(F.col("one_tokens")) / CELL_TOKENS)
        .cast("int")
        .alias("cells"),
    )
    opened = stored(opened, "opened")
    of = nodes.select("id", F.col("cell").alias("from"))
    queries = (
        opened.join(of, "from")
        .withColumn("cell_no", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
        .select("cell", "cell_no", "id")
    )
    members = (
        nodes.join(opened.select("cell", "cells").distinct(), "cell")
        .withColumn("cell_no", F.pmod(F.xxhash64("id"), F.col("cells")).cast("int"))
        .select("cell", "cell_no", "id")
    )
    more = stored(open_cells(named, members, queries), "more-links")
    joined = components(links.unionByName(more).unionByName(grouped.select(F.col("id").alias("a"), F.col("cell").alias("b"))))
    by_sign = classes.select("sign", "id").join(joined, "id", "left").select(
        "sign", F.coalesce("component", "id").alias("_component")
    )
    return (
        sketched.select("doc_id", F.col("n").alias("n_shingles"), "sign")
        .join(by_sign, "sign", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("_component", "doc_id")).alias("component_id"),
        )
    )


def _bounded(pairs: DataFrame, full: DataFrame) -> DataFrame:
    """Drop pairs of single documents whose histograms leave no room for a link."""
    single = (F.col("one_size") == 1) & (F.col("two_size") == 1)
    alone = pairs.filter(single)
    ids = alone.select(F.explode(F.array("one", "two")).alias("id"))
    parts = among(full.select("doc_id", "parts"), "doc_id", ids).distinct()
    side = lambda name: parts.select(F.col("doc_id").alias(name), F.col("parts").alias(f"{name}_parts"))

    @tidy
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("one_parts", "two_parts", "one_tokens", "two_tokens")]
            kept = [may_link(a, b, (n, m)) for a, b, n, m in zip(*columns, strict=True)]
            yield batch.filter(pa.array(kept, pa.bool_())).drop_columns(["one_parts", "two_parts"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.schema)
    checked = (
        alone.join(side("one"), "one").join(side("two"), "two").select(*pairs.columns, "one_parts", "two_parts")
    ).mapInArrow(keep, schema)
    # An id with several texts has several histograms.
    return pairs.filter(~single).unionByName(checked.distinct())


# Columns that ``keep_first`` adds for a while.
_OWN = ["_key", "_digest", "_new"]


def keep_first(docs: DataFrame) -> DataFrame:
    """One row of each component, that of its smallest doc_id, with all columns of ``docs``; of rows
    with the same id and text one stays. Rows with a null id are all kept. Different texts of one id
    are documents of their own: each stays or goes by its own links."""
    names = docs.columns
    clash = {n: new for n, new in zip(_OWN, fresh(docs, *_OWN), strict=True) if n != new}
    if clash:
        return keep_first(docs.withColumnsRenamed(clash)).withColumnsRenamed({v: k for k, v in clash.items()}).select(*names)
    repeated = stored(
        docs.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1"),
        "repeated-ids",
    )
    if repeated.isEmpty():
        return _first_rows(docs.withColumn("_key", F.col("doc_id")), None).select(*docs.columns)
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    again = docs.join(repeated.select("doc_id"), "doc_id", "left_semi").select("doc_id", digest.alias("_digest"))
    again = stored(again.distinct(), "repeated-texts")
    first = again.groupBy("doc_id").agg(F.min("_digest").alias("first"))
    others = stored(again.join(first, "doc_id").filter("_digest <> first").drop("first"), "other-texts")
    extra = None
    keyed = docs.withColumn("_key", F.col("doc_id"))
    if not others.isEmpty():
        # The first text keeps the id; the others get ids that no document has.
        high = docs.agg(F.max("doc_id")).first()[0]
        extra = numbered(others, [], ["doc_id", "_digest"], "n").select(
            "doc_id", "_digest", (F.col("n") + F.lit(high + 1)).alias("_new")
        )
        extra = stored(extra, "extra-ids")
        keyed = (
            docs.withColumn("_digest", digest)
            .join(extra, ["doc_id", "_digest"], "left")
            .withColumn("_key", F.coalesce("_new", "doc_id"))
            .drop("_digest", "_new")
        )
    kept = _first_rows(keyed, extra)
    columns = [*docs.columns, "_key"]
    again = kept.join(repeated.select("doc_id"), "doc_id", "left_semi").select(*columns)
    once = kept.join(repeated.select("doc_id"), "doc_id", "left_anti").select(*columns)
    return once.unionByName(again.dropDuplicates(["_key"])).select(*docs.columns)


def _first_rows(keyed: DataFrame, extra: DataFrame | None) -> DataFrame:
    """Rows whose ``_key`` is the first of its component, or null. Keys in ``extra`` (doc_id, _new) rank
    by their doc_id."""
    found = jaccard_components(keyed.select(F.col("_key").alias("doc_id"), "text"))
    others = found.filter("component_id <> doc_id")
    if extra is not None:
        found = stored(found, "components-by-text")
        real = extra.select(F.col("_new").alias("doc_id"), F.col("doc_id").alias("real"))
        first = (
            found.filter("doc_id IS NOT NULL")
            .join(real, "doc_id", "left")
            .groupBy("component_id")
            .agg(F.min(F.struct(F.coalesce("real", "doc_id").alias("real"), "doc_id")).alias("first"))
            .select("component_id", F.col("first.doc_id").alias("first"))
            .filter("first <> component_id")
        )
        others = found.join(first, "component_id", "left").filter("doc_id <> coalesce(first, component_id)")
    others = stored(others.select(F.col("doc_id").alias("_key")).distinct(), "other-copies")
    return keyed.join(others, "_key", "left_anti")
