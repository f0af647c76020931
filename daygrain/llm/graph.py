"""Connected components: small forests inside a task, star contraction across the cluster."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrain.llm.common import stored


class Forest:
    """Union-find over the rows of one block, merged a row of links at a time."""

    def __init__(self, size: int):
        self.parent = np.arange(size)

    def roots(self, nodes: np.ndarray) -> np.ndarray:
        found = self.parent[nodes]
        while True:
            above = self.parent[found]
            if np.array_equal(above, found):
                self.parent[nodes] = found
                return found
            found = above

    def link(self, node: int, others: np.ndarray) -> None:
        """Put ``node`` and ``others`` into one tree."""
        roots = np.unique(self.roots(np.append(others, node)))
        if len(roots) > 1:
            self.parent[roots] = roots[0]

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """One edge per node that is not a root: the node and its root."""
        nodes = np.arange(len(self.parent))
        roots = self.roots(nodes)
        moved = nodes[roots != nodes]
        return moved, roots[moved]


def _least_neighbour(pairs: DataFrame) -> DataFrame:
    """The least of each node's neighbourhood; written, so that a join with it can split a hub's edges."""
    return stored(pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the least of its neighbourhood."""
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    return both.join(_least_neighbour(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the least of them."""
    least = _least_neighbour(edges)
    moved = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).filter("u > v").distinct()


def _is_done(edges: DataFrame) -> bool:
    """Whether all trees are stars: no node hangs on two, and none that others hang on hangs itself."""
    ends = F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up")))
    nodes = edges.select(F.inline(ends)).groupBy("node").agg(F.sum("up").alias("up"), F.min("up").alias("least"))
    return nodes.filter("up > 1 OR up = 1 AND least = 0").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``edges``; the component is its smallest node.

    Alternates large and small stars until all trees are stars, which takes a
    logarithmic number of rounds. Each round is two aggregations with map-side
    combine, whose results are written, and two joins with them, which adaptive
    execution splits where a hub has many edges. Each round is written out, so that
    no lineage grows. Self-links and repeated links do no harm; no edges give no rows.
    """
    now = stored(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u > v").distinct(), "edges"
    )
    while not _is_done(now):
        # Two steps with a write between them: the second reads the edges twice.
        now = stored(_small_star(stored(_large_star(now), "edges")), "edges")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
