"""The trie of all beginnings of conversations, built from sorted shards below a small skeleton.

Conversations are sorted by their paths (a digest per turn) and cut at splitter paths into shards. A node
whose conversations lie on both sides of a cut is a beginning of a splitter, so the trie of the splitters,
the skeleton, is known before any work starts and small enough to broadcast. Each shard finishes all other
nodes alone. Of a skeleton node it knows only its own part; these parts are added up.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabgauge.llm.common import partitions, slices, stored

# Bytes of a path for each turn.
STEP = 16
# Paths in a shard, shards at most, paths looked at for each splitter, and turns to which a
# splitter is cut: the skeleton has at most MAX_SHARDS * SPLITTER_TURNS nodes, whatever the input.
SHARD_PATHS, MAX_SHARDS, SAMPLED, SPLITTER_TURNS = 20_000, 4096, 8, 64
# Conversations with ids in a range of so many are joined into one text before they are hashed.
ID_BLOCK = 4096

_SHARD_ROWS = (
    "skeleton long, parent_skeleton long, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, ends_sha256 string, chars long"
)
_NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversation_steps(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id and its turns as ``steps`` of (key, chars), in order.

    Turns are ordered by turn (null first), then role and text, so ties and repeated rows have one order.
    A null role or text is empty. Rows without conv_id are left out; other columns are ignored. The key
    is a digest of role and text; equal digests are taken for equal turns. All turns of one conversation
    meet in one row.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text")
    )
    key = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))
    step = F.struct(
        "turn", "role", "text", key.alias("key"), F.length("text").cast("long").alias("chars")
    )
    steps = F.sort_array(F.collect_list(step))
    return rows.groupBy("conv_id").agg(
        F.transform(steps, lambda s: F.struct(s["key"].alias("key"), s["chars"].alias("chars"))).alias("steps")
    )


def _blocks(conversations: DataFrame) -> DataFrame:
    """Conversations of one path with ids in one range as one row, so that a path that many
    share is a few rows: path, block, chars, n, first, ids."""
    joined = conversations.select(
        F.unhex(F.array_join("steps.key", "")).alias("path"),
        F.floor(F.col("conv_id") / ID_BLOCK).alias("block"),
        F.col("steps.chars").alias("chars"),
        "conv_id",
    )
    return joined.groupBy("path", "block").agg(
        F.first("chars").alias("chars"),
        F.count(F.lit(1)).alias("n"),
        F.min("conv_id").alias("first"),
        F.array_join(F.sort_array(F.collect_list("conv_id")), ",").alias("ids"),
    )


def splitters(blocks: DataFrame) -> list[bytes]:
    """Paths at which the sorted paths are cut into shards of about equal size.

    They come from a sample of bounded size and decide nothing but which task does the work.
    """
    spark = blocks.sparkSession
    count = blocks.count()
    shards = min(MAX_SHARDS, max(partitions(spark), count // SHARD_PATHS))
    share = min(1.0, SAMPLED * shards / max(count, 1))
    cut = F.substring("path", 1, STEP * SPLITTER_TURNS)
    picked = blocks.filter(F.pmod(F.xxhash64("path"), F.lit(2**30)) < int(share * 2**30))
    sample = sorted({bytes(r[0]) for r in picked.select(cut).collect()})
    return sample[SAMPLED :: SAMPLED] if share < 1 else sample[1 :: max(1, len(sample) // shards)]


def skeleton(paths: list[bytes]) -> dict[bytes, int]:
    """All proper beginnings of the splitters, numbered so that a node comes after its parent."""
    nodes = {b""} | {p[:k] for p in paths for k in range(0, len(p), STEP)}
    return {node: k for k, node in enumerate(sorted(nodes, key=lambda node: (len(node), node)))}


class _Shard:
    """Nodes met while the sorted paths of one shard pass by.

    Nodes are numbered from 0 as they appear, after their parents; skeleton nodes are -1 - number.
    """

    def __init__(self, skeleton_: dict[bytes, int]):
        self.skeleton = skeleton_
        self.parent, self.depth, self.chars = [], [], []
        self.first, self.count, self.ends = [], [], []
        # Of skeleton nodes: smallest member, members, children, leaves, saved, ends, depth, chars.
        self.parts: dict[int, list] = {}
        self.last, self.stack = b"", []
        self.digest, self.open = None, None

    def add(self, path: bytes, chars: list[int], first: int, count: int, ids: str) -> None:
        """The next path, or the next block of ids of the same one."""
        if self.open is None or path != self.last:
            self._close()
            self._descend(path, chars)
            self.digest = hashlib.sha256(ids.encode())
            self.open = [first, count]
        else:
            self.digest.update(b"," + ids.encode())
            self.open[0] = min(self.open[0], first)
            self.open[1] += count

    def _descend(self, path: bytes, chars: list[int]) -> None:
        depth = len(path) // STEP
        same, most = 0, min(depth, len(self.last) // STEP)
        while same < most and path[same * STEP : (same + 1) * STEP] == self.last[same * STEP : (same + 1) * STEP]:
            same += 1
        keep = same + 1 if self.stack else 0
        del self.stack[keep:]
        for at in range(keep, depth + 1):
            above = self.stack[-1] if self.stack else None
            size = chars[at - 1] if at else 0
            number = self.skeleton.get(path[: at * STEP]) if above is None or above < 0 else None
            if number is not None:
                self.parts.setdefault(number, [None, 0, 0, 0, 0, None, at, size])
                self.stack.append(-1 - number)
                continue
            self.stack.append(len(self.parent))
            self.parent.append(above)
            self.depth.append(at)
            self.chars.append(size)
            self.first.append(None)
            self.count.append(0)
            self.ends.append(None)
        self.last = path

    def _close(self) -> None:
        if self.open is None:
            return
        (first, count), node, ends = self.open, self.stack[-1], self.digest.hexdigest()
        if node < 0:
            part = self.parts[-1 - node]
            part[0] = first if part[0] is None else min(part[0], first)
            part[1] += count
            part[5] = ends
        else:
            self.first[node], self.count[node], self.ends[node] = first, count, ends
        self.open = None

    def rows(self) -> Iterator[tuple]:
        """Finished nodes, and the parts of skeleton nodes."""
        self._close()
        size = len(self.parent)
        children, leaves, saved = [0] * size, [0] * size, [0] * size
        first, count = self.first, self.count
        for node in range(size - 1, -1, -1):
            leaves[node] += children[node] == 0
            saved[node] += (count[node] - 1) * self.chars[node]
            above = self.parent[node]
            if above < 0:
                part = self.parts[-1 - above]
                part[0] = first[node] if part[0] is None else min(part[0], first[node])
                part[1] += count[node]
                part[2] += 1
                part[3] += leaves[node]
                part[4] += saved[node]
            else:
                first[above] = first[node] if first[above] is None else min(first[above], first[node])
                count[above] += count[node]
                children[above] += 1
                leaves[above] += leaves[node]
                saved[above] += saved[node]
        for node in range(size):
            above = self.parent[node]
            yield (
                None,
                -1 - above if above < 0 else None,
                first[node],
                self.depth[node],
                None if above < 0 else first[above],
                count[node],
                children[node],
                leaves[node],
                saved[node],
                self.ends[node],
                self.chars[node],
            )
        for number, (low, n, kids, ended, kept, ends, depth, chars) in self.parts.items():
            yield (number, None, low, depth, None, n, kids, ended, kept, ends, chars)


def _reduced(parts: DataFrame, skeleton_: dict[bytes, int]) -> list[tuple]:
    """Skeleton nodes with all their members: the parts of the shards added up per node by Spark, then
    from the deepest node to the root. No more rows than the skeleton has nodes."""
    sums = parts.groupBy("skeleton").agg(
        F.min("conv_id"), F.sum("n_convs"), F.sum("n_children"), F.sum("n_leaves"), F.sum("saved_tokens"),
        F.max("ends_sha256"), F.max("depth"), F.max("chars"),
    )
    total = {r[0]: list(r)[1:] for r in sums.collect()}
    above = {k: skeleton_[path[:-STEP]] for path, k in skeleton_.items() if path}
    for node in sorted(total, reverse=True):
        mine = total[node]
        mine[4] += (mine[1] - 1) * mine[7]
        if node in above:
            parent = total[above[node]]
            parent[0] = mine[0] if parent[0] is None else min(parent[0], mine[0])
            parent[1] += mine[1]
            parent[2] += 1
            parent[3] += mine[3]
            parent[4] += mine[4]
    return [
        (k, low, depth, total[above[k]][0] if k in above else None, n, kids, leaves, saved, ends)
        for k, (low, n, kids, leaves, saved, ends, depth, _) in total.items()
    ]


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per distinct beginning of the conversations, which have conv_id and ``steps``.

    conv_id is the smallest member, a conversation that begins so; parent_conv_id that of the beginning
    without the last turn (null for the root, which has no turns); n_convs counts members, n_children the
    beginnings with one more turn, n_leaves the childless ones in the subtree. saved_tokens adds up
    over the subtree the code points of the last text of each node that all members but one share.
    ends_sha256 is the SHA-256 of the ids of the members that end here, ascending, with commas between.
    A conversation without turns ends at the root. conv_id must be unique and not null. Without
    conversations there are no nodes, not even the root. Paths of turns that are common to many
    conversations are cut into several shards; only a beginning of more than SPLITTER_TURNS turns stays in one.
    """
    spark = conversations.sparkSession
    blocks = stored(_blocks(conversations), "trie-paths")
    cuts = splitters(blocks)
    nodes = skeleton(cuts)

    @F.pandas_udf("int")
    def shard_of(path: pd.Series) -> pd.Series:
        return path.map(lambda p: bisect_right(cuts, bytes(p))).astype("int32")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [(n, pa.string() if t == "string" else pa.int64()) for n, t in (f.split() for f in _SHARD_ROWS.split(", "))]
        )

        def finished(shard: _Shard) -> Iterator[pa.RecordBatch]:
            columns = list(zip(*shard.rows(), strict=True))
            arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
            yield from pa.Table.from_arrays(arrays, schema=schema).to_batches(max_chunksize=10_000)

        shard, number = None, None
        for batch in batches:
            for rows in slices(batch):
                for at, path, _, chars, count, first, ids in zip(*rows, strict=True):
                    if at != number:
                        if shard is not None:
                            yield from finished(shard)
                        shard, number = _Shard(nodes), at
                    shard.add(path, chars, first, count, ids)
        if shard is not None:
            yield from finished(shard)

    dealt = blocks.select(shard_of("path").alias("shard"), "path", "block", "chars", "n", "first", "ids")
    sorted_ = dealt.repartition(len(cuts) + 1, "shard").sortWithinPartitions("shard", "path", "block")
    found = stored(sorted_.mapInArrow(build, _SHARD_ROWS), "trie-nodes")
    rows = _reduced(found.filter("skeleton IS NOT NULL"), nodes)
    top = spark.createDataFrame(
        rows,
        "skeleton long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
        "n_leaves long, saved_tokens long, ends_sha256 string",
    )
    parents = F.broadcast(top.select(F.col("skeleton").alias("parent_skeleton"), F.col("conv_id").alias("_above")))
    below = found.filter("skeleton IS NULL").join(parents, "parent_skeleton", "left")
    below = below.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_above"))
    ends = F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")
    return below.select(*_NODE).unionByName(top.select(*_NODE)).select(*_NODE[:-1], ends)


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Conversations that begin like others: with c the id and h the CRC-32 of it as text modulo 6, the
    first h steps of conversation c - c % 100, then the steps of c after its own first h."""
    own = stored(conversations, "trie-steps")
    h = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(6)).cast("int")
    base = own.select(F.col("conv_id").alias("_base"), F.slice("steps", 1, 5).alias("_first"))
    joined = own.withColumn("_base", F.col("conv_id") - F.col("conv_id") % 100).join(base, "_base", "left")
    empty = F.slice("steps", 1, 0)
    return joined.select(
        "conv_id",
        F.concat(
            F.slice(F.coalesce("_first", empty), F.lit(1), h),
            F.slice("steps", h + 1, F.greatest(F.size("steps") - h, F.lit(0))),
        ).alias("steps"),
    )

