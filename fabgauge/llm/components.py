"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabgauge.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """id and component (the smallest id in reach) of every end of ``edges`` (columns a, b: long).

    Labels pass along edges and then jump to the label of their label, until none changes; the
    number of rounds grows with the logarithm of the longest path. Each round is written once.
    """
    one_way = edges.select("a", "b")
    both = stored(one_way.union(edges.select("b", "a")).distinct(), "edges")
    labels = both.groupBy(F.col("a").alias("id")).agg(
        F.least(F.min("b"), F.col("id")).alias("component")
    )
    labels, total = stored(labels, "labels"), None
    while True:
        found = labels.agg(F.sum(F.col("component").cast("decimal(38,0)"))).first()[0]
        if found == total:
            return labels
        total = found
        near = (
            both.join(labels, F.col("b") == F.col("id"))
            .groupBy("a")
            .agg(F.min("component").alias("near"))
        )
        lower = labels.join(near, F.col("id") == F.col("a")).select(
            "id", F.least("component", "near").alias("component")
        )
        lower = stored(lower, "labels")
        parent = lower.select(F.col("id").alias("component"), F.col("component").alias("root"))
        labels = stored(
            lower.join(parent, "component").select("id", F.col("root").alias("component")), "labels"
        )
