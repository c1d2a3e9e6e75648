"""Polygon layers derived from the driver tables.

The real boundary files are not shipped, so two layers are derived row by
row and grow with the scale factor:

* areas (one polygon per customer), laid on a 50-column grid of 100-unit
  cells: rectangles, U shapes (centroid outside the polygon), squares with a
  hole (centroid in the hole) and triangles, sized from the key;
* zones (one polygon per supplier), larger rectangles spread over the same
  grid, overlapping each other, every fifth with a hole, every seventh with a
  second part to the right of the first; their edges fall on some area
  centroids, which exercises the on-boundary rule.

All vertices are integers, so areas and centroids are exact sums.
Layer columns: key, part, rings (GeoJSON Polygon coordinates); zones also name (an attribute).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table

GRID_COLUMNS = 50
CELL = 100

# Vertex templates of the area shapes, in quarter units of the
# shape's width and height (ring 0 outer, ring 1 hole; every ring closed).
AREA_SHAPES = {
    0: [[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]],
    1: [[(0, 0), (4, 0), (4, 4), (3, 4), (3, 1), (1, 1), (1, 4), (0, 4), (0, 0)]],
    2: [[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], [(1, 1), (1, 3), (3, 3), (3, 1), (1, 1)]],
    3: [[(0, 0), (4, 0), (2, 4), (0, 0)]],
}


def _shape_templates() -> Column:
    """All area templates as one literal, indexed by shape code + 1."""
    return F.array(*[F.array(*[F.array(*[F.array(F.lit(ux), F.lit(uy)) for ux, uy in ring])
                               for ring in AREA_SHAPES[code]]) for code in sorted(AREA_SHAPES)])


def area_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    sized = c.select(
        k.alias("key"),
        ((k % GRID_COLUMNS) * CELL + 10).alias("x0"),
        (F.floor(k / GRID_COLUMNS).cast("bigint") * CELL + 10).alias("y0"),
        (5 + k % 16).alias("u"),
        (5 + F.floor(k / 7).cast("bigint") % 16).alias("v"),
        ((k + F.col("c_nationkey")) % 4).cast("int").alias("shape"))
    x0, y0, u, v = F.col("x0"), F.col("y0"), F.col("u"), F.col("v")
    template = F.element_at(_shape_templates(), F.col("shape") + 1)
    rings = F.transform(template, lambda ring: F.transform(ring, lambda p: F.array(
        (x0 + p[0] * u).cast("double"), (y0 + p[1] * v).cast("double"))))
    return sized.select("key", F.lit(0).alias("part"), rings.alias("rings"))


def zone_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    x0 = ((k * 7) % GRID_COLUMNS) * CELL + 40
    y0 = k * 30 - 25
    x1 = x0 + CELL * (2 + k % 4)
    y1 = y0 + CELL * (1 + k % 3)

    def pt(x, y):
        return F.array(x.cast("double"), y.cast("double"))
    outer = F.array(pt(x0, y0), pt(x1, y0), pt(x1, y1), pt(x0, y1), pt(x0, y0))
    hole = F.array(pt(x0 + 30, y0 + 20), pt(x0 + 30, y0 + 60), pt(x0 + 70, y0 + 60),
                   pt(x0 + 70, y0 + 20), pt(x0 + 30, y0 + 20))
    first = F.when(k % 5 == 0, F.array(outer, hole)).otherwise(F.array(outer))
    second = F.array(F.array(pt(x1 + 10, y0 + 10), pt(x1 + 25, y0 + 10), pt(x1 + 25, y0 + 25), pt(x1 + 10, y0 + 25),
                             pt(x1 + 10, y0 + 10)))
    parts = F.when(k % 7 == 0, F.array(first, second)).otherwise(F.array(first))
    named = F.concat(F.lit("zone "), k.cast("string"))
    return s.select(k.alias("key"), named.alias("name"), F.posexplode(parts).alias("part", "rings"))


# Rectangles for the four district layers: table, key, columns of the grid, spacing, offsets and
# size terms in hundredths of a unit. Widths and heights are odd, so a centroid never lies on an edge.
DISTRICTS = {
    "community": ("customer", "c_custkey", 40, 1000, 3, 7, 300, 401),
    "council": ("supplier", "s_suppkey", 13, 3000, 11, 5, 900, 1501),
    "school": ("supplier", "s_suppkey", 10, 4000, 17, 13, 1100, 1901),
    "tract": ("part", "p_partkey", 45, 900, 1, 2, 150, 601),
}


def district_layer(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One rectangle per key, with corners at two decimals (no binary fractions)."""
    table, key, columns, spacing, ox, oy, sizes, least = DISTRICTS[name]
    k = F.col(key).cast("bigint")
    row = F.floor(k / columns).cast("bigint")
    x0 = (k % columns) * spacing + ox + (k * 37) % 301
    y0 = row * spacing + oy + (k * 53) % 211
    x1 = x0 + (k % sizes) * 2 + least
    y1 = y0 + (F.floor(k / 3).cast("bigint") % sizes) * 2 + least + 2

    def pt(x, y):
        return F.array(x / 100, y / 100)
    ring = F.array(pt(x0, y0), pt(x1, y0), pt(x1, y1), pt(x0, y1), pt(x0, y0))
    return read_table(spark, sf_dir, table).select(k.alias("key"), F.lit(0).alias("part"), F.array(ring).alias("rings"))
