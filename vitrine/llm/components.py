"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import written

#: Edges left after contraction that one task may finish with union-find (16 bytes each).
FINISH_EDGES = 50_000


class Forest:
    """Union-find over the numbers 0 to n - 1; the smallest number is the root."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def union(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def forest_edges(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node of its component), without those of a node to itself."""
    nodes, codes = np.unique(np.concatenate((left, right)), return_inverse=True)
    forest = Forest(len(nodes))
    half = len(left)
    for a, b in zip(codes[:half].tolist(), codes[half:].tolist()):
        forest.union(a, b)
    roots = np.fromiter((forest.find(i) for i in range(len(nodes))), np.int64, len(nodes))
    moved = roots != np.arange(len(nodes))
    return nodes[moved], nodes[roots[moved]]


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [b for b in batches if b.num_rows]
    if held:
        table = pa.Table.from_batches(held)
        nodes, roots = forest_edges(table.column("a").to_numpy(), table.column("b").to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots)], ["node", "root"])


def components(edges: DataFrame, finish_edges: int = FINISH_EDGES) -> DataFrame:
    """`node, root` (both long) for every node of `edges(a, b)`: the smallest node it reaches.

    Each round hooks every node to its smallest neighbour, follows the hooks twice, and replaces
    the nodes of every edge by what they now hang on; edges inside one node vanish. At least every
    node that is no local minimum goes, so the table shrinks quickly. Once at most `finish_edges`
    are left, one task ends the work; the bound is fixed and does not grow with the input. The
    edges and each round are written to the shared folder. Null nodes have no component; self-loops are allowed.
    """
    spark = edges.sparkSession
    # What makes the edges may be dear, and nodes and edges both read them.
    pairs = written(edges.where("a is not null and b is not null"), "pairs")
    nodes = written(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "nodes")
    live = written(
        pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = nodes.withColumn("root", F.col("node"))
    while (left := live.count()) > finish_edges:
        both = live.select("a", "b").union(live.select(F.col("b"), F.col("a")))
        hooks = both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("up"))
        hooks = written(hooks, "hooks")
        for _ in range(2):
            above = hooks.select(F.col("node").alias("up"), F.col("up").alias("top"))
            hooks = hooks.join(above, "up", "left").select("node", F.coalesce("top", "up").alias("up"))
        hooks = written(hooks, "hooks")
        ends = {c: hooks.select(F.col("node").alias(c), F.col("up").alias(f"{c}_up")) for c in "ab"}
        moved = live.join(ends["a"], "a").join(ends["b"], "b").where("a_up <> b_up")
        live = written(moved.select(F.least("a_up", "b_up").alias("a"), F.greatest("a_up", "b_up").alias("b")).distinct(), "edges")
        labels = _relabel(labels, hooks)
    if left:
        last = live.coalesce(1).mapInArrow(_finish, "node long, root long")
        labels = _relabel(labels, written(last.select("node", F.col("root").alias("up")), "hooks"))
    return labels


def _relabel(labels: DataFrame, hooks: DataFrame) -> DataFrame:
    renamed = hooks.select(F.col("node").alias("root"), "up")
    return written(labels.join(renamed, "root", "left").select("node", F.coalesce("up", "root").alias("root")), "labels")
