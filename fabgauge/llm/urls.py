"""URL filter: rules by host and path, and a character language-model ratio for the rest.

Two smoothed variable-order Markov models, one of accepted and one of rejected URLs, are counted
over all URLs that a rule decides. A URL is judged by the difference of their log-likelihoods per
character against a threshold calibrated on decided URLs that were kept out of the counts.

A gram is a character and the ORDER before it, packed into 54 bits without hashing. Grams are counted
as grouped rows of a stored table that grows with the input; the counts of shorter contexts are sums
of them. Every gram that occurs gets its log ratio once, and a URL's ratio is the mean of its grams'.
"""

from __future__ import annotations

import string
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fabgauge.llm.common import stored

ORDER = 5
# Bits of a symbol: 0 stands before a URL, 1 after it, and others are bytes plus 2.
BITS = 9
# Weight of the shorter context, in characters seen.
SMOOTHING = 1.0
# One in so many decided URLs calibrates the threshold instead of being counted.
HELD_OUT = 5
# The most frequent grams are looked up where URLs are read; all others are joined.
FREQUENT = 100_000
# Log ratios are added as whole multiples of this, so that the order of addition changes nothing.
UNIT = 2.0**-32


@dataclass(frozen=True)
class Rule:
    """``verdict`` (allow or block) for a host, its subdomains, and paths with this beginning."""

    verdict: str
    host: str
    path: str

    @classmethod
    def parse(cls, text: str) -> Rule:
        """From ``block example.org/es/``."""
        verdict, place = text.split()
        host, slash, path = place.partition("/")
        return cls(verdict, host, slash + path)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and without ``://``."""
    pattern = r"^(?s:.*?)://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(text, pattern, 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(text, pattern, 2)


def apply_rules(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; both null if none fits. Of equally
    long ones the first counts. Rules are few: they become one expression."""
    rule = verdict = F.lit(None).cast("string")
    ranked = sorted(enumerate(rules), key=lambda x: (-len(x[1].host + x[1].path), x[0]))
    for _, r in reversed(ranked):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        rule = F.when(fits, F.lit(r.host + r.path)).otherwise(rule)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return rule, verdict


def _grams(urls: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The grams of every character (and the end) of all URLs, and where those of each URL start."""
    raw = [b"\0" * ORDER + (u or "").lower().encode() + b"\0" for u in urls]
    symbols = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64) + 2
    lengths = np.array([len(x) for x in raw])
    ends = np.cumsum(lengths)
    place = np.arange(len(symbols)) - np.repeat(ends - lengths, lengths)
    symbols[place < ORDER] = 0
    symbols[ends - 1] = 1
    at = np.flatnonzero(place >= ORDER)
    grams = np.zeros(len(at), np.int64)
    for k in range(ORDER + 1):
        grams |= symbols[at - k] << (BITS * k)
    return grams, np.concatenate(([0], np.cumsum(lengths - ORDER)[:-1]))


def count_grams(labelled: DataFrame) -> DataFrame:
    """Grams of all rows with url and accepted (0, 1, or null: not counted in a model): gram, times in
    all rows, and in rejected and accepted ones. Rows are combined before they are sent."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                grams, starts = _grams(part.column("url").to_pylist())
                labels = part.column("accepted").fill_null(-1).to_numpy(zero_copy_only=False)
                owner = np.repeat(labels, np.diff(np.append(starts, len(grams))))
                found, which = np.unique(grams, return_inverse=True)
                sums = [np.bincount(which, minlength=len(found))]
                sums += [np.bincount(which[owner == c], minlength=len(found)) for c in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found), *(pa.array(x.astype(np.int64)) for x in sums)],
                    names=["gram", "times", "rejected", "accepted"],
                )

    parts = labelled.select("url", "accepted").mapInArrow(
        count, "gram long, times long, rejected long, accepted long"
    )
    return parts.groupBy("gram").agg(*(F.sum(c).alias(c) for c in ("times", "rejected", "accepted")))


def score_grams(grams: DataFrame) -> DataFrame:
    """The log ratio of every gram of a stored table, in UNITs: gram, times, score.

    Contexts are joined with the next shorter ones. A context has few characters after it and few
    contexts that are longer by one, so no task of a grouping or join holds a large share.
    """
    chances = None
    for k in range(ORDER + 1):
        mask = (1 << (BITS * (k + 1))) - 1
        code = F.col("gram").bitwiseAND(F.lit(mask))
        sums = [F.sum(c).alias(c) for c in ("times", "rejected", "accepted")]
        level = grams.groupBy(code.alias("gram")).agg(*sums)
        context = Window.partitionBy(F.shiftright("gram", BITS))
        level = level.withColumns({f"{c}_seen": F.sum(c).over(context) for c in ("rejected", "accepted")})
        if chances is None:
            level = level.withColumns({f"{c}_chance": F.lit(1 / 257) for c in ("rejected", "accepted")})
        else:
            level = level.withColumn("shorter", F.col("gram").bitwiseAND(F.lit(mask >> BITS))).join(
                chances, "shorter"
            )
        mixed = {
            c: (F.col(c) + SMOOTHING * F.col(f"{c}_chance")) / (F.col(f"{c}_seen") + SMOOTHING)
            for c in ("rejected", "accepted")
        }
        if k == ORDER:
            score = F.round((F.log(mixed["accepted"]) - F.log(mixed["rejected"])) / UNIT).cast("long")
            return level.select("gram", "times", score.alias("score"))
        chances = level.select(
            F.col("gram").alias("shorter"), *(x.alias(f"{c}_chance") for c, x in mixed.items())
        )


@dataclass(frozen=True)
class Scores:
    """Scores of all grams as a stored table, those of the most frequent ones in order of the gram,
    and whether there are others."""

    table: DataFrame
    grams: np.ndarray
    values: np.ndarray
    more: bool

    @classmethod
    def of(cls, table: DataFrame) -> Scores:
        first = table.orderBy(F.col("times").desc(), "gram").limit(FREQUENT + 1).select("gram", "score").toArrow()
        grams = first.column("gram").to_numpy()[:FREQUENT].astype(np.int64)
        values = first.column("score").to_numpy()[:FREQUENT].astype(np.int64)
        order = np.argsort(grams)
        return cls(table, grams[order], values[order], first.num_rows > FREQUENT)


def _partly_scored(urls: DataFrame, scores: Scores) -> DataFrame:
    """Add the number of a URL's grams, the sum of the scores of the frequent ones, and the others."""
    known = urls.sparkSession.sparkContext.broadcast((scores.grams, scores.values))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, values = known.value
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                mine, starts = _grams(part.column("url").to_pylist())
                place = np.minimum(np.searchsorted(grams, mine), len(grams) - 1)
                found = grams[place] == mine
                sums = np.add.reduceat(np.where(found, values[place], 0), starts)
                sizes = np.diff(np.append(starts, len(mine)))
                missing = np.add.reduceat((~found).astype(np.int64), starts)
                offsets = np.concatenate(([0], np.cumsum(missing))).astype(np.int32)
                rest = pa.ListArray.from_arrays(pa.array(offsets), pa.array(mine[~found]))
                columns = [*part.columns, pa.array(sums), pa.array(sizes.astype(np.int64)), rest]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, "_sum", "_size", "_rest"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in urls.schema)
    return urls.mapInArrow(score, f"{schema}, _sum long, _size long, _rest array<long>")


def log_ratio(urls: DataFrame, scores: Scores) -> DataFrame:
    """Add ``ratio``: log-likelihood per character under the accepted model minus the rejected.

    Every gram of ``urls`` must be in the table of scores. URLs with grams that are not among the most
    frequent get these by a join; such a URL is not in very many rows, as its grams would be frequent.
    """
    partly = _partly_scored(urls, scores)
    ratio = F.col("_sum") * F.lit(UNIT) / F.col("_size")
    work = ("_sum", "_size", "_rest")
    if not scores.more:
        return partly.withColumn("ratio", ratio).drop(*work)
    text = F.coalesce("url", F.lit(""))
    each = stored(urls.select(text.alias("url")).distinct(), "distinct-urls")
    rare = _partly_scored(each, scores).filter(F.size("_rest") > 0)
    rare = stored(rare.select(F.monotonically_increasing_id().alias("id"), "url", "_rest"), "rare-grams")
    sums = (
        rare.select("id", F.explode("_rest").alias("gram"))
        .join(scores.table.select("gram", "score"), "gram")
        .groupBy("id")
        .agg(F.sum("score").alias("_more"))
    )
    sums = rare.select("id", F.col("url").alias("_text")).join(sums, "id").drop("id")
    done = partly.filter(F.size("_rest") == 0).withColumn("ratio", ratio)
    others = partly.filter(F.size("_rest") > 0).withColumn("_text", text).join(sums, "_text")
    others = others.withColumn("_sum", F.col("_sum") + F.col("_more")).withColumn("ratio", ratio)
    return done.drop(*work).unionByName(others.drop(*work, "_text", "_more"))


def calibrate(scored: DataFrame) -> float:
    """The ratio at and above which a URL is accepted, with the best mean of both classes' shares
    of right decisions; 0 if a class is missing. Reads hundredths of the ratio, so few rows."""
    bins = (
        scored.groupBy(F.floor(F.col("ratio") * 100).alias("bin"))
        .agg(F.sum("accepted").alias("good"), F.sum(1 - F.col("accepted")).alias("bad"))
        .orderBy("bin")
        .collect()
    )
    good, bad = sum(r["good"] for r in bins), sum(r["bad"] for r in bins)
    if not good or not bad:
        return 0.0
    best, threshold, lost, caught = -1.0, 0.0, 0, 0
    for r in bins:
        right = (1 - lost / good) + caught / bad
        if right > best:
            best, threshold = right, r["bin"] / 100
        lost, caught = lost + r["good"], caught + r["bad"]
    return threshold


def judge_urls(pages: DataFrame, rules: Sequence[Rule], url_column: str = "url") -> DataFrame:
    """Add host, path, rule, ratio and verdict to every row.

    A rule's verdict counts; other URLs are allowed if their ratio reaches the threshold. Null and
    empty URLs have empty parts and are judged like others by their (empty) text; repeated
    rows are judged each. Without decided URLs of both kinds the ratio's threshold is 0. Other
    columns are kept, except those that are replaced. An empty table gives no rows.
    """
    host, path = url_parts(F.col(url_column))
    parts = pages.withColumns({"host": host, "path": path})
    rule, verdict = apply_rules(F.col("host"), F.col("path"), rules)
    ruled = parts.withColumns({"rule": rule, "_ruled": verdict, "_url": F.col(url_column)})
    held_out = F.pmod(F.xxhash64("url"), F.lit(HELD_OUT)) == 0
    labelled = ruled.select(F.col("_url").alias("url"), (F.col("_ruled") == "allow").cast("int").alias("accepted"))
    seen = labelled.withColumn("accepted", F.when(~held_out, F.col("accepted")))
    grams = stored(count_grams(seen), "url-grams")
    scores = Scores.of(stored(score_grams(grams), "gram-scores"))
    threshold = calibrate(log_ratio(labelled.filter(held_out & F.col("accepted").isNotNull()), scores))
    others = [c for c in ruled.columns if c not in ("ratio", "verdict", "url")]
    scored = log_ratio(ruled.select(*others, F.col("_url").alias("url")), scores)
    judged = F.when(F.col("ratio") >= threshold, "allow").otherwise("block")
    scored = scored.withColumn("verdict", F.coalesce("_ruled", judged))
    if url_column != "url":
        scored = scored.drop("url")
    return scored.drop("_ruled", "_url")
