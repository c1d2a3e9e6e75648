"""Connected components of a large graph, by hooking, pointer jumping and contraction.

Each round every node hooks to its smallest smaller neighbour, the hooks are
compressed to their roots, and the edges are rewritten between roots; edges
inside a tree vanish. The roots of a round are local minima, at most half of
the nodes that still have edges, so the rounds number O(log n). All state is
in written tables; the driver sees only counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _compress(hooks: DataFrame) -> DataFrame:
    """Hooks (node, parent) with every parent replaced by the root of its chain."""
    while True:
        up = hooks.select(F.col("node").alias("mid"), F.col("parent").alias("far"))
        jumped = hooks.join(up, hooks.parent == up.mid, "left").select(
            "node", F.coalesce("far", "parent").alias("parent"), F.col("far").isNotNull().alias("moved"))
        jumped = materialise(jumped, "hooks")
        if jumped.where("moved").isEmpty():
            return hooks
        hooks = jumped.drop("moved")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each end of an edge of ``edges`` (a, b) that is not its component's smallest node."""
    edges = materialise(edges.where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    roots = None
    while not edges.isEmpty():
        hooks = _compress(materialise(
            edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("parent")), "hooks"))
        to = hooks.select(F.col("node").alias("n"), F.col("parent").alias("p"))
        if roots is None:
            roots = hooks
        else:
            moved = roots.join(to, roots.parent == to.n, "left").select(
                "node", F.coalesce("p", "parent").alias("parent"))
            roots = materialise(moved.unionByName(hooks), "roots")
        first = edges.join(to, edges.a == to.n, "left").select(F.coalesce("p", "a").alias("a"), "b")
        both = first.join(to, first.b == to.n, "left").select("a", F.coalesce("p", "b").alias("b"))
        edges = materialise(both.where("a != b").select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.select("node", F.col("parent").alias("root"))
