"""Connected components of a large graph."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm.scratch import stored


class Sets:
    """Disjoint sets whose name is their smallest member."""

    def __init__(self):
        self.parent: dict = {}

    def find(self, x):
        root = x
        while (up := self.parent.get(root, root)) != root:
            root = up
        while x != root:
            self.parent[x], x = root, self.parent.get(x, x)
        return root

    def join(self, a, b) -> bool:
        """Unite two sets; False if they were one."""
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A batch's edges, reduced to one per node that has a smaller one."""
    for batch in batches:
        sets = Sets()
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            sets.join(a, b)
        rows = [(sets.find(x), x) for x in sets.parent if sets.find(x) != x]
        columns = [pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)]
        yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """Node and root (the smallest node reachable), for all nodes with an edge.

    ``edges`` has two string columns. Each round replaces every batch of edges
    by a forest, hooks every node to the smallest neighbour of its own, and
    contracts the graph to these. Minima are combined before the shuffle, so a
    node with very many edges does no harm; tables between the rounds cut the
    lineage.
    """
    spark = edges.sparkSession
    a, b = edges.columns
    graph = stored(edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b").mapInArrow(_forest, "a string, b string"), "cc-edges")
    roots = spark.createDataFrame([], "node string, root string")
    first = True
    while not graph.isEmpty():
        both = graph.union(graph.select("b", "a"))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
        hooks = stored(hooks.select("node", F.least("node", "near").alias("up")), "cc-hooks")
        grand = hooks.select(F.col("node").alias("up"), F.col("up").alias("grand"))
        hooks = stored(hooks.join(grand, "up").select("node", F.col("grand").alias("up")), "cc-hooks")
        if first:
            roots, first = hooks.select("node", F.col("up").alias("root")), False
        else:
            moved = roots.join(hooks, F.col("root") == hooks["node"], "left")
            roots = stored(moved.select(roots["node"], F.coalesce("up", "root").alias("root")), "cc-roots")
        left = hooks.select(F.col("node").alias("a"), F.col("up").alias("x"))
        right = hooks.select(F.col("node").alias("b"), F.col("up").alias("y"))
        contracted = graph.join(left, "a").join(right, "b").where("x <> y")
        graph = stored(
            contracted.select(F.col("x").alias("a"), F.col("y").alias("b")).mapInArrow(_forest, "a string, b string"),
            "cc-edges",
        )
    return roots
