"""Polygon layers as DataFrames: centroids, point-in-polygon and intersects joins.

A layer has one row per polygon part: ``key``, ``part`` and ``rings``
(``array<array<array<double>>>``, GeoJSON Polygon coordinates: ring 0 is the
outer ring, the others are holes, every ring closed). Coordinates are planar
(one projected CRS for all layers).

Everything per polygon is computed inside its row with higher-order
functions (no shuffle): ring sums for the centroid, bounding boxes, edges.

Spatial joins use a family of grids. The cell sizes are powers of four, so
``v / g`` is exact and the cell of a coordinate never depends on rounding:

* a polygon is filed at the level whose cell is at least as long as its box,
  in the (at most four) cells that its box meets, whatever other polygons
  there are; an edge likewise by its own box;
* ``points_in_polygons`` looks a point up at every level that occurs (an
  equi-join on level and cell: broadcast when the index is bounded, salted
  otherwise), compares boxes, and then tests the edges of the one horizontal
  strip of the polygon that the point lies in. A polygon has as many strips as
  leave its edges in at most four strips each on average;
* ``polygons_intersecting`` pairs polygons whose boundaries cross (the finer of
  two edges looks the coarser one up at the coarser one's level, exact
  segment test) or where one contains a vertex of the other.

Nothing is tuned to the data: results and index sizes (four cells a polygon,
about four copies an edge) are the same for any mix of sizes.

Boundary rules: ``within`` excludes points on an edge, ``covers`` includes
them; intersects counts touching polygons.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import DEFAULT_BROADCAST_BYTES
from .predicates import orientation
from .rtree import BOX, RTree
from .skew import salted_join
from ..session import written

#: How polygons, or edges, near a place are found.
GRID, TREE = "grid", "tree"
EDGE_FIELDS = "struct<x1:double,y1:double,x2:double,y2:double>"


# ---- per-row geometry ------------------------------------------------------

def ring_edges(ring: Column) -> Column:
    """Edges of a closed ring as ``array<struct<x1,y1,x2,y2>>``."""
    n = F.size(ring)
    return F.when(n >= 2, F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.struct(
        ring[i - 1][0].alias("x1"), ring[i - 1][1].alias("y1"),
        ring[i][0].alias("x2"), ring[i][1].alias("y2")))).otherwise(F.array().cast(f"array<{EDGE_FIELDS}>"))


def _ring_sums(ring: Column) -> Column:
    """Shoelace sums of one ring: S = sum(x1*y2 - x2*y1), SX, SY (centroid numerators).

    Callers move the polygon's box corner to the origin first: the products
    then have the size of the polygon, not of its place on the map.
    """
    zero = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("sx"), F.lit(0.0).alias("sy"))

    def step(acc, e):
        c = e["x1"] * e["y2"] - e["x2"] * e["y1"]
        return F.struct((acc["s"] + c).alias("s"),
                        (acc["sx"] + (e["x1"] + e["x2"]) * c).alias("sx"),
                        (acc["sy"] + (e["y1"] + e["y2"]) * c).alias("sy"))
    return F.aggregate(ring_edges(ring), zero, step)


def part_moments(rings: Column) -> Column:
    """Oriented shoelace sums of a polygon part: outer ring counted positive,
    holes negative, whatever each ring's winding."""
    zero = F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("sx"), F.lit(0.0).alias("sy"))
    idx = F.sequence(F.lit(0), F.size(rings) - 1)

    def step(acc, i):
        m = _ring_sums(rings[i])
        f = F.when(i == 0, F.signum(m["s"])).otherwise(-F.signum(m["s"]))
        return F.struct((acc["s"] + f * m["s"]).alias("s"),
                        (acc["sx"] + f * m["sx"]).alias("sx"),
                        (acc["sy"] + f * m["sy"]).alias("sy"))
    return F.aggregate(idx, zero, step)


def outer_box(rings: Column) -> Column:
    xs = F.transform(rings[0], lambda p: p[0])
    ys = F.transform(rings[0], lambda p: p[1])
    return F.struct(F.array_min(xs).alias("minx"), F.array_min(ys).alias("miny"),
                    F.array_max(xs).alias("maxx"), F.array_max(ys).alias("maxy"))


def centroids(parts: DataFrame) -> DataFrame:
    """Area-weighted centroid and area per key (shoelace over all rings and parts)."""
    boxed = parts.select("key", "rings", outer_box(F.col("rings")).alias("b"))
    local = F.transform("rings", lambda ring: F.transform(ring, lambda p: F.array(
        p[0] - F.col("b.minx"), p[1] - F.col("b.miny"))))
    m = boxed.select("key", "b.minx", "b.miny", part_moments(local).alias("m"))
    # Back on the map: the moment about the true origin is the local one plus 3 * corner * 2 * area.
    sums = m.groupBy("key").agg(F.sum("m.s").alias("s2"), F.sum(F.col("m.sx") + F.col("minx") * F.col("m.s") * 3).alias("sx"),
                                F.sum(F.col("m.sy") + F.col("miny") * F.col("m.s") * 3).alias("sy"))
    return sums.select("key", (F.col("s2") / 2).alias("area"),
                       F.when(F.col("s2") != 0, F.col("sx") / (F.col("s2") * 3)).alias("cx"),
                       F.when(F.col("s2") != 0, F.col("sy") / (F.col("s2") * 3)).alias("cy"))


# ---- exact predicates ------------------------------------------------------

def _side(e, px: Column, py: Column) -> Column:
    """The side of the edge's line that the point is on (1 left, -1 right, 0 on it); exact."""
    return orientation(e["x1"], e["y1"], e["x2"], e["y2"], px, py)


def _crosses_right(e, px: Column, py: Column) -> Column:
    straddles = (e["y1"] > py) != (e["y2"] > py)
    # A point beyond the edge's box is left or right of all of it; only the others need the line.
    return straddles & (px <= F.greatest(e["x1"], e["x2"])) & (
        (px < F.least(e["x1"], e["x2"])) | ((_side(e, px, py) > 0) == (e["y2"] > e["y1"])))


def _on_edge(e, px: Column, py: Column) -> Column:
    return ((px >= F.least(e["x1"], e["x2"])) & (px <= F.greatest(e["x1"], e["x2"]))
            & (py >= F.least(e["y1"], e["y2"])) & (py <= F.greatest(e["y1"], e["y2"]))
            & (_side(e, px, py) == 0))


def point_in_edges(edge_list: Column, px: Column, py: Column, boundary: bool) -> Column:
    """Even-odd ray test over the given edges; ``boundary`` says whether a point
    on an edge counts as inside."""
    crossings = F.aggregate(edge_list, F.lit(0), lambda acc, e: acc + F.when(_crosses_right(e, px, py), 1)
                            .otherwise(0))
    on_edge = F.exists(edge_list, lambda e: _on_edge(e, px, py))
    odd = (crossings % 2) == 1
    return (odd | on_edge) if boundary else (odd & ~on_edge)


def segments_touch(a: dict, b: dict) -> Column:
    """Closed segments a and b share at least one point; exact."""
    o1 = orientation(a["x1"], a["y1"], a["x2"], a["y2"], b["x1"], b["y1"])
    o2 = orientation(a["x1"], a["y1"], a["x2"], a["y2"], b["x2"], b["y2"])
    o3 = orientation(b["x1"], b["y1"], b["x2"], b["y2"], a["x1"], a["y1"])
    o4 = orientation(b["x1"], b["y1"], b["x2"], b["y2"], a["x2"], a["y2"])

    def apart(c: str) -> Column:
        return (F.greatest(a[f"{c}1"], a[f"{c}2"]) < F.least(b[f"{c}1"], b[f"{c}2"])) | (
            F.greatest(b[f"{c}1"], b[f"{c}2"]) < F.least(a[f"{c}1"], a[f"{c}2"]))
    # Segments whose boxes meet share a point when neither lies on one side of the other's line: of
    # segments on one line the boxes alone decide.
    return ~apart("x") & ~apart("y") & (o1 * o2 <= 0) & (o3 * o4 <= 0)


# ---- grid join -------------------------------------------------------------

# Levels are exponents of two, two apart; sizes beyond them share the last level.
MIN_LEVEL, MAX_LEVEL, LEVEL_STEP = -30, 60, 2
CELL_ENTRY_BYTES = 96
EDGE_BYTES = 64


def _level(side: Column) -> Column:
    """The level whose cell is at least ``side`` long."""
    up = F.ceil(F.log2(side) / LEVEL_STEP) * LEVEL_STEP
    return F.greatest(F.least(F.when(side > 0, up).otherwise(F.lit(MIN_LEVEL)), F.lit(MAX_LEVEL)),
                      F.lit(MIN_LEVEL)).cast("int")


def _size(level: Column) -> Column:
    return F.pow(F.lit(2.0), level)


def _cell(v: Column, size: Column) -> Column:
    return F.floor(v / size).cast("bigint")


def _cells_between(lo: Column, hi: Column, size: Column) -> Column:
    return F.sequence(_cell(lo, size), _cell(hi, size))


def _prepared(parts: DataFrame) -> DataFrame:
    """key, part, edges, b (box), level, h (strip height), copies, edge_levels (bits), fx, fy of each polygon part."""
    shaped = parts.select("key", "part", F.flatten(F.transform("rings", ring_edges)).alias("edges"),
                          outer_box(F.col("rings")).alias("b"), F.col("rings")[0][0][0].alias("fx"),
                          F.col("rings")[0][0][1].alias("fy"))
    n, box = F.size("edges"), F.col("b")
    low = F.transform("edges", lambda e: F.least(e["y1"], e["y2"]))
    high = F.transform("edges", lambda e: F.greatest(e["y1"], e["y2"]))
    top = F.greatest(F.ceil(F.log2(F.greatest(F.array_max(high) - F.array_min(low), F.lit(2.0 ** MIN_LEVEL)))),
                     F.lit(MIN_LEVEL))

    def copies(h: Column) -> Column:
        return F.aggregate("edges", F.lit(0).cast("bigint"), lambda acc, e: acc + _cell(
            F.greatest(e["y1"], e["y2"]), h) - _cell(F.least(e["y1"], e["y2"]), h) + 1)

    heights = F.transform(F.sequence(F.lit(0), F.ceil(F.log2(n + 1)).cast("int")), lambda j: _size(top - j))
    fitting = F.filter(F.transform(heights, lambda h: F.struct(h.alias("h"), copies(h).alias("copies"))),
                       lambda c: c["copies"] <= 4 * n + 8)
    found = F.aggregate("edges", F.lit(0).cast("bigint"), lambda acc, e: acc.bitwiseOR(_bit(_edge_level(e))))
    sized = shaped.select("key", "part", "edges", "b", "fx", "fy", F.when(n > 0, F.element_at(fitting, -1)).alias("strip"),
                          F.when(n > 0, _level(F.greatest(box["maxx"] - box["minx"], box["maxy"] - box["miny"]))).alias("level"),
                          found.alias("edge_levels"))
    return sized.select("key", "part", "edges", "b", "fx", "fy", "level", "edge_levels", F.col("strip.h").alias("h"),
                        F.col("strip.copies").alias("copies"))


def _bit(level: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), ((level - MIN_LEVEL) / LEVEL_STEP).cast("int"))


def _levels_of(bits: int) -> list[int]:
    return [level for k, level in enumerate(range(MIN_LEVEL, MAX_LEVEL + 1, LEVEL_STEP)) if bits >> k & 1]


class Layer:
    """A polygon layer prepared for joins: one written row per part, and what is known of all of them.

    The source is read once; every join reads the written copy, which also cuts the lineage.
    """

    def __init__(self, rows: DataFrame, index_bytes: int, levels: int, edge_levels: int):
        self.rows, self.index_bytes, self.levels, self.edge_levels = rows, index_bytes, levels, edge_levels

    @staticmethod
    def of(parts: DataFrame | Layer) -> Layer:
        """``parts`` (key, part, rings) prepared. Raises when two rows share key and part: their edges would be one polygon."""
        if isinstance(parts, Layer):
            return parts
        rows = written(_prepared(parts), "polygons")
        size, b = _size(F.col("level")), F.col("b")
        cells = ((_cell(b["maxx"], size) - _cell(b["minx"], size) + 1)
                 * (_cell(b["maxy"], size) - _cell(b["miny"], size) + 1))
        own = rows.select("key", "part", cells.alias("cells"), "copies", _bit(F.col("level")).alias("level"), "edge_levels")
        each = own.groupBy("key", "part").agg(
            F.count(F.lit(1)).alias("n"), F.sum("cells").alias("cells"), F.sum("copies").alias("copies"),
            F.bit_or("level").alias("level"), F.bit_or("edge_levels").alias("edge_levels"))
        f = each.agg(F.max_by(F.struct("key", "part", "n"), "n").alias("most"), F.sum("cells").alias("cells"),
                     F.sum("copies").alias("copies"), F.bit_or("level").alias("level"),
                     F.bit_or("edge_levels").alias("edge_levels")).first()
        if f["most"] is not None and f["most"]["n"] > 1:
            raise ValueError(f"layer has several rows for key {f['most']['key']}, part {f['most']['part']}")
        return Layer(rows, int(f["cells"] or 0) * CELL_ENTRY_BYTES + int(f["copies"] or 0) * EDGE_BYTES,
                     f["level"] or 0, f["edge_levels"] or 0)

    def keyed(self, key: Column) -> Layer:
        """The layer with another key for each part."""
        return Layer(self.rows.withColumn("key", key), self.index_bytes, self.levels, self.edge_levels)

    def union(self, other: Layer) -> Layer:
        return Layer(self.rows.unionByName(other.rows), self.index_bytes + other.index_bytes,
                     self.levels | other.levels, self.edge_levels | other.edge_levels)

    def shaped(self) -> DataFrame:
        """The parts that have edges."""
        return self.rows.where(F.size("edges") > 0)

    def first_vertices(self) -> DataFrame:
        """The first vertex of each part's outer ring, as a point (key, px, py)."""
        return self.rows.select("key", F.col("fx").alias("px"), F.col("fy").alias("py"))


def polygon_cells(prepared: DataFrame) -> DataFrame:
    """One row per cell that a part's box meets, at the part's level."""
    size, b = _size(F.col("level")), F.col("b")
    columns = prepared.select("key", "part", "b", "h", "level", F.explode(
        _cells_between(b["minx"], b["maxx"], size)).alias("cx"))
    return columns.select("key", "part", "b", "h", "level", "cx", F.explode(
        _cells_between(b["miny"], b["maxy"], size)).alias("cy"))


def polygon_strips(prepared: DataFrame) -> DataFrame:
    """key, part, strip, edges: the edges of a part that reach each of its horizontal strips."""
    each = prepared.select("key", "part", "h", F.explode("edges").alias("e"))
    spread = each.select("key", "part", "e", F.explode(_cells_between(
        F.least("e.y1", "e.y2"), F.greatest("e.y1", "e.y2"), F.col("h"))).alias("strip"))
    return spread.groupBy("key", "part", "strip").agg(F.collect_list("e").alias("edges"))


def points_in_polygons(points: DataFrame, parts: DataFrame | Layer, boundary: bool = False, point_key: str = "key",
                       max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES, index: str = GRID) -> DataFrame:
    """Left spatial join: distinct (point key, polygon key) for each polygon containing the point.

    ``points`` has ``point_key``, ``px``, ``py``. A point in no polygon gives
    one row with a NULL polygon key. ``boundary=False`` is *within* (a point
    on an edge is outside), ``True`` is *covers*. The index is broadcast only
    when the layer's own bound proves it small; otherwise points and index are both
    shuffled on the cell, with a cell holding many points split over several
    tasks (``skew.salted_join``). ``index`` "tree" finds the boxes that hold a
    point by a packed R-tree instead of the grids; the answer is the same.
    """
    layer = Layer.of(parts)
    prepared, levels = layer.shaped(), _levels_of(layer.levels)
    small = layer.index_bytes <= max_broadcast_bytes
    px, py, b = F.col("px"), F.col("py"), F.col("b")

    def look_up(rows: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
        return rows.join(F.broadcast(table), on) if small else salted_join(rows, table, on, how="inner")

    if index == TREE:
        boxes = prepared.select(*[b[c].alias(c) for c in BOX], "key", "part", "h")
        at = points.select(px.alias("minx"), py.alias("miny"), px.alias("maxx"), py.alias("maxy"), F.col(point_key).alias("pkey"), "px", "py")
        near = RTree.of(boxes).meeting(at, max_broadcast_bytes if small else 0)
    else:
        all_levels = F.array(*[F.lit(x) for x in levels]) if levels else F.array().cast("array<int>")
        located = points.select(F.col(point_key).alias("pkey"), "px", "py", F.explode(all_levels).alias("level")).select(
            "pkey", "px", "py", "level", _cell(px, _size(F.col("level"))).alias("cx"),
            _cell(py, _size(F.col("level"))).alias("cy"))
        near = look_up(located, polygon_cells(prepared), ["level", "cx", "cy"]).where(
            (px >= b["minx"]) & (px <= b["maxx"]) & (py >= b["miny"]) & (py <= b["maxy"]))
    in_strip = look_up(near.select("pkey", "px", "py", "key", "part", _cell(py, F.col("h")).alias("strip")),
                       polygon_strips(prepared), ["key", "part", "strip"])
    hits = in_strip.where(point_in_edges(F.col("edges"), px, py, boundary)).select(
        "pkey", F.col("key").alias("polygon_key")).distinct()
    keys = points.select(F.col(point_key).alias("pkey")).distinct()
    return keys.join(hits, "pkey", "left").select(F.col("pkey").alias(point_key), "polygon_key")


# ---- intersects ------------------------------------------------------------

def _edge_level(e) -> Column:
    return _level(F.greatest(F.abs(e["x2"] - e["x1"]), F.abs(e["y2"] - e["y1"])))


def _levelled(layer: Layer, name: str) -> DataFrame:
    """name, x1, y1, x2, y2, own (level) of the layer's edges."""
    e = layer.rows.select(F.col("key").alias(name), F.inline("edges"))
    return e.withColumn("own", _edge_level({c: F.col(c) for c in ("x1", "y1", "x2", "y2")}))


def _filed(e: DataFrame, levels: Column) -> DataFrame:
    """Edges in the cells that they meet, at each of ``levels`` (an array of levels no finer than their own)."""
    at = e.select("*", F.explode(levels).alias("level"))
    size = _size(F.col("level"))
    columns = at.select("*", F.explode(_cells_between(F.least("x1", "x2"), F.greatest("x1", "x2"), size)).alias("cx"))
    return columns.select("*", F.explode(_cells_between(F.least("y1", "y2"), F.greatest("y1", "y2"), size)).alias("cy"))


def polygons_intersecting(left: DataFrame | Layer, right: DataFrame | Layer,
                          max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES, index: str = GRID) -> DataFrame:
    """Left spatial join on *intersects*: (left key, right key) per touching pair.

    A left polygon touching nothing keeps one row with a NULL right key. ``index`` "tree" pairs
    edges, and finds first vertices, by packed R-trees instead of the grids.
    """
    left, right = Layer.of(left), Layer.of(right)
    le, re = _levelled(left, "lkey"), _levelled(right, "rkey")
    left_levels, right_levels = (F.array(*[F.lit(x) for x in _levels_of(y.edge_levels)]).cast("array<int>") for y in (left, right))
    own = F.array("own")
    a = {c: F.col(f"a.{c}") for c in ("x1", "y1", "x2", "y2")}
    b = {c: F.col(f"b.{c}") for c in ("x1", "y1", "x2", "y2")}

    def meeting(one: DataFrame, other: DataFrame) -> DataFrame:
        on = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("level", "cx", "cy")]
        return one.alias("a").join(other.alias("b"), on[0] & on[1] & on[2]).where(
            segments_touch(a, b)).select("a.lkey", "b.rkey")

    if index == TREE:
        def boxed(e: DataFrame, key: str, side: str) -> DataFrame:
            return e.select(F.least("x1", "x2").alias("minx"), F.least("y1", "y2").alias("miny"), F.greatest("x1", "x2").alias("maxx"),
                            F.greatest("y1", "y2").alias("maxy"), key, F.struct("x1", "y1", "x2", "y2").alias(side))
        met = RTree.of(boxed(re, "rkey", "b")).meeting(boxed(le, "lkey", "a"), max_broadcast_bytes, EDGE_BYTES)
        crossing = met.where(segments_touch(a, b)).select("lkey", "rkey")
    else:
        # Every pair once: at the right edge's level where that is the coarser one (or the same), else at the left's.
        up_left = _filed(le, F.filter(right_levels, lambda x: x >= F.col("own")))
        up_right = _filed(re, F.filter(left_levels, lambda x: x > F.col("own")))
        crossing = meeting(up_left, _filed(re, own)).unionByName(meeting(_filed(le, own), up_right))
    left_in_right = (points_in_polygons(left.first_vertices().withColumnRenamed("key", "lkey"), right, boundary=True,
                                        point_key="lkey", max_broadcast_bytes=max_broadcast_bytes, index=index)
                     .where(F.col("polygon_key").isNotNull()).select("lkey", F.col("polygon_key").alias("rkey")))
    right_in_left = (points_in_polygons(right.first_vertices().withColumnRenamed("key", "rkey"), left, boundary=True,
                                        point_key="rkey", max_broadcast_bytes=max_broadcast_bytes, index=index)
                     .where(F.col("polygon_key").isNotNull()).select(F.col("polygon_key").alias("lkey"), "rkey"))
    pairs = crossing.unionByName(left_in_right).unionByName(right_in_left).distinct()
    keys = left.rows.select(F.col("key").alias("lkey")).distinct()
    return keys.join(pairs, "lkey", "left")
