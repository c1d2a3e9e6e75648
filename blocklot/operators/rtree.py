"""A packed R-tree over boxes, as one written table per level.

*Bulk load* (sort-tile-recursive). ``n`` entries make ``p = ceil(n / capacity)`` nodes. They are
ranked by the middle of their boxes along x and cut into ``ceil(sqrt(p))`` vertical slices of
equal numbers of nodes; each slice is ranked along y and cut into nodes of ``capacity`` entries. Ranks
come from range partitions and their counts (``positions.numbered``), so neither a slice nor a level
is ever in one task. The boxes of the nodes are the entries of the next level, until
at most ``capacity`` nodes are left: the tops, the only rows that come to the driver.

*Join.* A query box starts at the tops and goes down level by level: an equi-join on
the number of the node, then a comparison of boxes. A level that is proven small is
broadcast, so all the way down is one pass; a larger one is a shuffle join in which
hot nodes, where many queries meet, are split (``skew.salted_join``).

Boxes are closed: touching ones meet. Entries and queries without a box (a null
bound) meet nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .joins import DEFAULT_BROADCAST_BYTES
from .positions import numbered
from .skew import salted_join

CAPACITY = 64
#: Memory of a broadcast node or entry, besides what the entry carries.
NODE_BYTES = 128
BOX = ("minx", "miny", "maxx", "maxy")


def _meets(a: str, b: str) -> Column:
    return ((F.col(f"{a}minx") <= F.col(f"{b}maxx")) & (F.col(f"{b}minx") <= F.col(f"{a}maxx"))
            & (F.col(f"{a}miny") <= F.col(f"{b}maxy")) & (F.col(f"{b}miny") <= F.col(f"{a}maxy")))


def _tiled(entries: DataFrame, n: int, capacity: int) -> DataFrame:
    """``entries`` with ``node``: sort, tile."""
    nodes = -(-n // capacity)
    slices = math.ceil(math.sqrt(nodes))
    per_slice = -(-nodes // slices) * capacity
    middle = entries.withColumns({"mid_x": (F.col("minx") + F.col("maxx")) / 2, "mid_y": (F.col("miny") + F.col("maxy")) / 2})
    across = numbered(middle, ["mid_x", "mid_y"], "rank_x")
    sliced = across.withColumn("slice", F.floor(F.col("rank_x") / per_slice))
    down = numbered(sliced, ["mid_y", "mid_x"], "rank_y", ["slice"])
    node = F.col("slice") * (per_slice // capacity) + F.floor(F.col("rank_y") / capacity)
    return down.withColumn("node", node.cast("bigint")).drop("mid_x", "mid_y", "rank_x", "rank_y", "slice")


def _boxes(level: DataFrame) -> DataFrame:
    """(own, box) of the nodes of a level."""
    return level.groupBy(F.col("node").alias("own")).agg(
        F.min("minx").alias("minx"), F.min("miny").alias("miny"), F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy"))


class RTree:
    """``levels``: from the tops' children down to the entries, each (node, box, own) or, last, (node, box, payload)."""

    def __init__(self, tops: list[tuple], levels: list[tuple[DataFrame, int]]):
        self.tops, self.levels = tops, levels

    @staticmethod
    def of(entries: DataFrame, capacity: int = CAPACITY) -> RTree:
        """The tree of ``entries`` (minx, miny, maxx, maxy and what they carry)."""
        if capacity < 2:
            raise ValueError("a node has at least two entries")
        whole = F.lit(True)
        for c in BOX:
            whole = whole & F.col(c).isNotNull()
        current, levels = entries.where(whole), []
        while True:
            n = current.count()
            level = written(_tiled(current, n, capacity), "rtree") if n else current.withColumn("node", F.lit(0).cast("bigint"))
            levels.append((level, n))
            if n <= capacity * capacity:  # the nodes above are at most about ``capacity``: the tops
                tops = [tuple(r) for r in _boxes(level).select("own", *BOX).collect()]
                return RTree(tops, levels[::-1])
            current = written(_boxes(level), "rtree")

    def meeting(self, queries: DataFrame, max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES,
                entry_bytes: int = 0) -> DataFrame:
        """Every pair of a query (minx, miny, maxx, maxy and what it carries) and an entry whose boxes meet.

        The columns of the queries but their boxes, and of the entries but theirs; no name may be in both.
        ``entry_bytes`` is what an entry carries at most, for the size of a broadcast.
        """
        asked = [c for c in queries.columns if c not in BOX]
        carried = [c for c in self.levels[-1][0].columns if c not in (*BOX, "node")]
        if set(asked) & set(carried):
            raise ValueError(f"columns in queries and entries: {sorted(set(asked) & set(carried))}")
        boxed = queries.select(*[F.col(c).alias(f"q_{c}") for c in BOX], *asked)
        tops = F.array(*[F.struct(*[F.lit(v).alias(f"t_{c}") for c, v in zip(("node", *BOX), t)]) for t in self.tops])
        if not self.tops:
            kinds = "array<struct<t_node:bigint,t_minx:double,t_miny:double,t_maxx:double,t_maxy:double>>"
            tops = F.array().cast(kinds)
        at = boxed.select("*", F.inline(tops)).where(_meets("q_", "t_")).select(
            *[f"q_{c}" for c in BOX], *asked, F.col("t_node").alias("at"))
        for k, (level, n) in enumerate(self.levels):
            last = k + 1 == len(self.levels)
            kept = carried if last else ["own"]
            children = level.select(F.col("node").alias("at"), *[F.col(c).alias(f"t_{c}") for c in BOX], *kept)
            if n * (NODE_BYTES + (entry_bytes if last else 0)) <= max_broadcast_bytes:
                met = at.join(F.broadcast(children), "at")
            else:
                met = salted_join(written(at, "frontier"), children, ["at"], how="inner")
            at = met.where(_meets("q_", "t_")).select(
                *[f"q_{c}" for c in BOX], *asked, *([] if last else [F.col("own").alias("at")]), *(kept if last else []))
        return at.select(*asked, *carried)
