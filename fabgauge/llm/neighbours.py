"""Exact nearest vectors by inner product, with cover trees over queries and candidates.

The upper level of both trees is one set of nodes, whose centres come from a bounded sample; every
vector belongs to the node of its nearest centre. A pair of a query node and a candidate node is
opened only if the covering radii allow a score as high as the worst k-th score in the query node. The
lower levels are built inside tasks, over blocks of bounded size, and pruned in the same way.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fabgauge.llm.common import partitions, stored

# Vectors of the sample that centres are chosen from, and nodes of the upper level at most.
SAMPLE, NODES = 4096, 128
# Vectors per node aimed at, vectors in a block of candidates, queries searched together.
PER_NODE, BLOCK, QUERIES = 500, 4096, 512
# Vectors in a leaf and children of a tree's node at most.
LEAF, CHILDREN = 128, 8
SCALE = 256


@dataclass
class Node:
    """A node covers its vectors within ``radius`` of its centre."""

    centre: np.ndarray
    radius: float
    rows: np.ndarray
    children: list[Node] = field(default_factory=list)

    def leaves(self) -> list[Node]:
        return [x for c in self.children for x in c.leaves()] if self.children else [self]


def cover_tree(vectors: np.ndarray, rows: np.ndarray | None = None) -> Node:
    """Children are the points farthest from those chosen before, until they cover the node within
    half its radius or are as many as allowed; vectors go to the nearest."""
    rows = np.arange(len(vectors)) if rows is None else rows
    mine = vectors[rows]
    apart = np.linalg.norm(mine - mine[0], axis=1)
    radius = float(apart.max(initial=0.0))
    node = Node(mine[0], radius, rows)
    if len(rows) <= LEAF or radius == 0.0:
        return node
    owner = np.zeros(len(rows), int)
    nearest = apart.copy()
    for k in range(1, CHILDREN):
        far = int(np.argmax(nearest))
        if nearest[far] <= radius / 2:
            break
        other = np.linalg.norm(mine - mine[far], axis=1)
        owner[other < nearest] = k
        nearest = np.minimum(nearest, other)
    parts = [rows[owner == k] for k in range(owner.max() + 1)]
    if len(parts) == 1:
        parts = np.array_split(rows, 2)
    node.children = [cover_tree(vectors, part) for part in parts if len(part)]
    return node


def highest(query: Node, others: list[Node]) -> np.ndarray:
    """Upper bounds of the inner product of any vector in ``query`` and any in each other node."""
    centres = np.array([o.centre for o in others])
    radii = np.array([o.radius for o in others])
    bound = (
        centres @ query.centre
        + np.linalg.norm(query.centre) * radii
        + query.radius * np.linalg.norm(centres, axis=1)
        + query.radius * radii
    )
    return bound + 1e-9 * np.abs(bound) + 1e-6


class Best:
    """The k highest scores of each query so far; ties go to the smaller id."""

    def __init__(self, ids: np.ndarray, k: int):
        self.ids, self.k = ids, k
        self.scores = np.full((len(ids), k), -np.inf)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        scores = np.where(ids[None, :] == self.ids[rows][:, None], -np.inf, scores)
        scores = np.concatenate([self.scores[rows], scores], axis=1)
        names = np.concatenate([self.found[rows], np.broadcast_to(ids, (len(rows), len(ids)))], axis=1)
        order = np.lexsort((names, -scores), axis=-1)[:, : self.k]
        self.scores[rows] = np.take_along_axis(scores, order, 1)
        self.found[rows] = np.take_along_axis(names, order, 1)

    def worst(self, node: Node) -> float:
        return float(self.scores[node.rows, -1].min())


def search(queries: np.ndarray, tree: Node, vectors: np.ndarray, ids: np.ndarray, best: Best) -> None:
    """Descend both trees together: a candidate node that is too far for a query node is too far for
    all below it."""

    def descend(query: Node, others: list[Node]) -> None:
        while others:
            bounds = highest(query, others)
            order = np.argsort(-bounds, kind="stable")
            others = [others[i] for i in order if bounds[i] >= best.worst(query)]
            if not any(o.children for o in others):
                break
            others = [c for o in others for c in (o.children or [o])]
            if query.children:
                break
        for child in query.children:
            descend(child, others)
        if not query.children:
            bounds = highest(query, others) if others else ()
            for other, bound in zip(others, bounds, strict=True):
                if bound >= best.worst(query):
                    scores = queries[query.rows] @ vectors[other.rows].T
                    best.add(query.rows, scores, ids[other.rows])

    descend(cover_tree(queries), [tree])


def integer_vectors(table: DataFrame, id_column: str, vector_column: str, scale: int = SCALE) -> DataFrame:
    """id and vector of floor(scale * x) of the rows that take part: id and vector not null, all
    components finite. Of rows with the same id the smallest vector counts."""
    finite = F.forall(
        vector_column,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")),
    )
    return (
        table.filter(F.col(id_column).isNotNull() & F.col(vector_column).isNotNull())
        .filter(finite)
        .groupBy(F.col(id_column).cast("long").alias("id"))
        .agg(F.min(vector_column).alias("vector"))
        .select("id", F.transform("vector", lambda x: F.floor(x.cast("double") * scale)).alias("vector"))
    )


def _matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Rows of floats, exact for scores below 2**53; shorter vectors are filled up with zeros."""
    lengths = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width))
    out[np.arange(width)[None, :] < lengths[:, None]] = flat
    return out


def _centres(vectors: DataFrame, count: int, width: int) -> np.ndarray:
    """Up to NODES centres: each the sampled vector farthest from those before."""
    wanted = min(NODES, max(1, count // PER_NODE))
    share = min(1.0, SAMPLE / count)
    sample = vectors.filter(F.pmod(F.xxhash64("id"), F.lit(2**30)) < int(share * 2**30)).limit(2 * SAMPLE)
    found = sample.select("vector").toArrow().column("vector").combine_chunks()
    points = _matrix(found, width)
    if not len(points):
        return np.zeros((1, width))
    points = points[np.lexsort(points.T)]
    chosen = [0]
    nearest = np.linalg.norm(points - points[0], axis=1)
    while len(chosen) < wanted and nearest.max() > 0:
        chosen.append(int(np.argmax(nearest)))
        nearest = np.minimum(nearest, np.linalg.norm(points - points[chosen[-1]], axis=1))
    return points[chosen]


def top_inner_products(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """The ``k`` vectors with the highest inner product for each query: query_id, rank, vec_id, score.

    ``vectors`` has a unique long id and a vector of longs (see ``integer_vectors``), all of which are
    candidates but the query itself; ``is_query`` is a condition on id. Equal scores go
    to the smaller id; with fewer candidates all are returned. Vectors of different length are
    compared as if filled up with zeros. Scores are exact up to 2**53. No rows for an empty table or without queries.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score long"
    base = stored(vectors.select("id", "vector"), "vectors")
    size = base.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width")).first()
    if not size["n"]:
        return spark.createDataFrame([], schema)
    width = size["width"]
    shared = spark.sparkContext.broadcast(_centres(base, size["n"], width))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = shared.value
        squares = (centres**2).sum(axis=1)
        for batch in batches:
            points = _matrix(batch.column("vector"), width)
            node = np.argmin(squares - 2 * points @ centres.T, axis=1)
            apart = np.linalg.norm(points - centres[node], axis=1) if len(points) else np.zeros(0)
            yield batch.append_column("node", pa.array(node.astype(np.int32))).append_column(
                "apart", pa.array(apart)
            )

    placed = stored(
        base.mapInArrow(assign, "id long, vector array<long>, node int, apart double").withColumn(
            "is_query", is_query
        ),
        "placed-vectors",
    )
    # One row per node of the upper level.
    stats = placed.groupBy("node").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("apart").alias("radius"),
        F.coalesce(F.max(F.when(F.col("is_query"), F.col("apart"))), F.lit(-1.0)).alias("query_radius"),
    ).collect()
    centre = shared.value
    blocks = {r["node"]: -(-r["n"] // BLOCK) for r in stats}
    candidates = {r["node"]: Node(centre[r["node"]], r["radius"], np.zeros(0, int)) for r in stats}
    query_nodes = {
        r["node"]: Node(centre[r["node"]], r["query_radius"], np.zeros(0, int))
        for r in stats
        if r["query_radius"] >= 0
    }

    def opened(pairs: list[tuple[int, int]]) -> DataFrame:
        """Top k within the blocks of each (query node, candidate node)."""
        rows = [(q, c, b) for q, c in pairs for b in range(blocks[c])]
        # At most NODES ** 2 node pairs; blocks of a node follow from its size.
        plan = spark.createDataFrame(rows, "node int, to int, block int")
        count = F.element_at(F.create_map(*[F.lit(x) for item in blocks.items() for x in item]), F.col("node"))
        data = placed.select(
            F.col("node").alias("to"),
            F.pmod(F.xxhash64("id"), count).cast("int").alias("block"),
            F.lit(0).alias("kind"),
            "id",
            "vector",
        )
        asked = placed.filter("is_query").join(F.broadcast(plan) if len(rows) <= NODES**2 else plan, "node")
        asked = asked.select("to", "block", F.lit(1).alias("kind"), "id", "vector")
        return (
            data.unionByName(asked)
            .repartition(4 * partitions(spark), "to", "block")
            .sortWithinPartitions("to", "block", "kind", "id")
            .mapInArrow(lambda batches: _search_blocks(batches, width, k), "query_id long, vec_id long, score long")
        )

    by_score = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")

    def best_of(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k)

    if not query_nodes:
        return spark.createDataFrame([], schema)
    first = stored(opened([(q, q) for q in query_nodes]), "first-neighbours")
    queries = placed.filter("is_query").select(F.col("id").alias("query_id"), "node")
    kth = (
        queries.join(best_of(first).filter(F.col("rank") == k), "query_id", "left")
        .groupBy("node")
        .agg(F.min(F.coalesce("score", F.lit(-(2**62)))).alias("worst"))
        .collect()
    )
    worst = {r["node"]: r["worst"] for r in kth}
    names = sorted(candidates)
    pairs = []
    for q, node in query_nodes.items():
        bounds = highest(node, [candidates[c] for c in names])
        pairs += [(q, c) for c, bound in zip(names, bounds, strict=True) if c != q and bound >= worst[q]]
    found = first.unionByName(opened(pairs)) if pairs else first
    return best_of(found).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _search_blocks(batches: Iterator[pa.RecordBatch], width: int, k: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block, candidates before queries: keep one block, search its queries in turn."""
    block: tuple | None = None
    candidates: list[tuple[np.ndarray, np.ndarray]] = []
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    built: tuple | None = None

    def answer() -> pa.RecordBatch:
        nonlocal built
        ids = np.concatenate([x for x, _ in waiting])
        queries = np.concatenate([x for _, x in waiting])
        waiting.clear()
        if built is None:
            names = np.concatenate([x for x, _ in candidates])
            points = np.concatenate([x for _, x in candidates])
            built = (cover_tree(points), points, names)
        tree, points, names = built
        best = Best(ids, k)
        search(queries, tree, points, names, best)
        real = np.isfinite(best.scores)
        return pa.RecordBatch.from_pydict(
            {
                "query_id": np.broadcast_to(ids[:, None], real.shape)[real],
                "vec_id": best.found[real],
                "score": best.scores[real].astype(np.int64),
            }
        )

    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("to", "block", "kind")], 1)
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        points = _matrix(batch.column("vector"), width)
        steps = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
        bounds = [0, *steps, len(keys)]
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            if low == high:
                continue
            key, kind = tuple(keys[low, :2]), keys[low, 2]
            if key != block:
                if waiting:
                    yield answer()
                block, built = key, None
                candidates.clear()
            if kind == 0:
                candidates.append((ids[low:high], points[low:high]))
                continue
            if not candidates:
                continue
            for at in range(low, high, QUERIES):
                waiting.append((ids[at : min(at + QUERIES, high)], points[at : min(at + QUERIES, high)]))
                if sum(len(x) for x, _ in waiting) >= QUERIES:
                    yield answer()
    if waiting:
        yield answer()
