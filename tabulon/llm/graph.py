"""Connected components of a link table by alternating star contractions."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _rooted(edges: DataFrame, both: bool) -> DataFrame:
    """Each node's links re-pointed to the smallest node it sees; ``both`` looks at larger neighbours as well.

    Looking both ways hangs larger neighbours on the minimum; looking down hangs the node and its smaller
    neighbours on it. Minima are aggregated before the shuffle, and the join back can be split by AQE when a node
    has very many links.
    """
    down = edges.select(F.col("b").alias("node"), F.col("a").alias("other"))
    seen = down.union(edges.select(F.col("a").alias("node"), F.col("b").alias("other"))) if both else down
    low = seen.groupBy("node").agg(F.min("other").alias("low")).withColumn("low", F.least("node", "low"))
    linked = seen.join(low, "node")
    if both:
        moved = linked.where("other > node").select(F.col("low").alias("a"), F.col("other").alias("b"))
    else:
        moved = linked.select(F.col("low").alias("a"), F.col("other").alias("b")).union(
            low.select(F.col("low").alias("a"), F.col("node").alias("b"))
        )
    return moved.where("a < b").distinct()


#: A graph of at most so many links, counted first, is small enough for one task.
FEW_LINKS = 1 << 18


def _joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(node, root) of a small graph's links, by joining trees."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while above.setdefault(x, x) != x:
            above[x] = above[above[x]]
            x = above[x]
        return x

    for links in batches:
        for a, b in zip(links["a"].tolist(), links["b"].tolist()):
            low, high = sorted((top(a), top(b)))
            above[high] = low
    yield pd.DataFrame({"node": list(above), "root": [top(x) for x in list(above)]}, dtype="int64")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with a link in ``edges`` (a < b); root is its component's smallest node.

    Every round is checkpointed. The number of rounds grows with the logarithm of the longest chain. A graph of few links
    is joined by one task instead. An empty link table gives an empty result.
    """

    def mark(df: DataFrame) -> tuple:
        return tuple(
            df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").bitwiseAND(F.lit((1 << 26) - 1)))).first()
        )

    edges = cut(edges.select("a", "b").where("a < b").distinct())
    before = mark(edges)
    if before[0] <= FEW_LINKS:
        return edges.coalesce(1).mapInPandas(_joined, "node long, root long")
    while before[0]:
        edges = cut(_rooted(_rooted(edges, both=True), both=False))
        after = mark(edges)
        if after == before:
            break
        before = after
    root = edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))
    return root.union(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
