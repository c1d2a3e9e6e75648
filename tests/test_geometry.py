"""Centroid, within and intersects on literal polygons with known answers."""

import pytest
from pyspark.sql import functions as F

from blocklot.operators import geometry as geo
from blocklot.plans import crosswalks


def _ring(*pts):
    pts = list(pts) + [pts[0]]
    return [[float(x), float(y)] for x, y in pts]


# Test polygons (outer ring, then holes).
AREAS = {
    101: [_ring((0, 0), (30, 0), (30, 30), (20, 30), (20, 10), (10, 10), (10, 30), (0, 30))],
    102: [_ring((40, 0), (60, 0), (60, 20), (40, 20))],
    103: [_ring((70, 0), (90, 0), (90, 20), (70, 20)), _ring((75, 5), (85, 5), (85, 15), (75, 15))],
    104: [_ring((30, 0), (40, 0), (40, 10), (30, 10))],
    105: [_ring((200, 200), (210, 200), (210, 210), (200, 210))],
}
ZONES = {
    "A": [_ring((0, 0), (35, 0), (35, 35), (0, 35))],
    "B": [_ring((35, 0), (65, 0), (65, 35), (35, 35))],
    "C": [_ring((65, 0), (95, 0), (95, 35), (65, 35)), _ring((75, 5), (85, 5), (85, 15), (75, 15))],
}


def _layer(spark, polys, key_type):
    return spark.createDataFrame([(k, 0, r) for k, r in polys.items()],
                                 f"key {key_type}, part int, rings array<array<array<double>>>")


@pytest.fixture(scope="module")
def areas(spark):
    return _layer(spark, AREAS, "bigint")


@pytest.fixture(scope="module")
def zones(spark):
    return _layer(spark, ZONES, "string")


def test_centroids(areas):
    got = {r.key: (r.area, round(r.cx, 6), round(r.cy, 6)) for r in geo.centroids(areas).collect()}
    assert got == {101: (700.0, 15.0, 13.571429), 102: (400.0, 50.0, 10.0), 103: (300.0, 80.0, 10.0),
                   104: (100.0, 35.0, 5.0), 105: (100.0, 205.0, 205.0)}


def test_centroid_ignores_winding(spark):
    cw = spark.createDataFrame([(1, 0, [_ring((0, 0), (0, 4), (4, 4), (4, 0))])],
                               "key bigint, part int, rings array<array<array<double>>>")
    r = geo.centroids(cw).first()
    assert (r.area, r.cx, r.cy) == (16.0, 2.0, 2.0)


@pytest.mark.parametrize("g", [None, 7.0, 100.0])
def test_centroid_within(areas, zones, g):
    out = crosswalks.centroid_crosswalk(areas, zones, "area", "zone")
    assert sorted(map(tuple, out.collect())) == [(101, "A"), (102, "B"), (103, None), (104, None), (105, None)]


def test_points_on_edges(spark, zones):
    pts = spark.createDataFrame([(1, 35.0, 5.0), (2, 10.0, 10.0), (3, 75.0, 10.0), (4, 0.0, 0.0)],
                                "key bigint, px double, py double")
    within = {(r.key, r.polygon_key) for r in geo.points_in_polygons(pts, zones, boundary=False).collect()}
    assert within == {(1, None), (2, "A"), (3, None), (4, None)}
    covers = {(r.key, r.polygon_key) for r in geo.points_in_polygons(pts, zones, boundary=True).collect()}
    assert covers == {(1, "A"), (1, "B"), (2, "A"), (3, "C"), (4, "A")}


@pytest.mark.parametrize("g", [None, 6.0])
def test_intersects(areas, zones, g):
    out = crosswalks.intersects_crosswalk(areas, zones, "area", "zone")
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [(101, "A"), (102, "B"), (103, "C"), (104, "A"), (104, "B"), (105, None)], key=str)


def test_intersects_touching_areas(spark, areas):
    pairs = geo.polygons_intersecting(areas, areas.select(F.col("key"), "part", "rings"))
    got = {(r.lkey, r.rkey) for r in pairs.collect() if r.lkey != r.rkey}
    assert got == {(101, 104), (104, 101), (104, 102), (102, 104)}


def test_polygon_inside_hole_does_not_intersect(spark):
    outer = spark.createDataFrame([(1, 0, [_ring((0, 0), (10, 0), (10, 10), (0, 10)),
                                           _ring((2, 2), (8, 2), (8, 8), (2, 8))])],
                                  "key bigint, part int, rings array<array<array<double>>>")
    inner = spark.createDataFrame([(9, 0, [_ring((3, 3), (4, 3), (4, 4), (3, 4))]),
                                   (8, 0, [_ring((1, 1), (1.5, 1), (1.5, 1.5), (1, 1.5))])],
                                  "key bigint, part int, rings array<array<array<double>>>")
    got = {(r.lkey, r.rkey) for r in geo.polygons_intersecting(inner, outer).collect()}
    assert got == {(9, None), (8, 1)}


def test_within_without_broadcast(spark, zones):
    pts = spark.createDataFrame([(1, 35.0, 5.0), (2, 10.0, 10.0), (3, 75.0, 10.0), (4, 500.0, 0.0)],
                                "key bigint, px double, py double")
    out = geo.points_in_polygons(pts, zones, boundary=False, max_broadcast_bytes=0)
    assert "strategy=broadcast" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.key, r.polygon_key) for r in out.collect()} == {(1, None), (2, "A"), (3, None), (4, None)}


def test_index_facts_bound_the_index(spark, zones):
    layer = geo.Layer.of(zones)
    prepared, bytes_, levels = layer.rows, layer.index_bytes, geo._levels_of(layer.levels)
    cells, copies = geo.polygon_cells(prepared), geo.polygon_strips(prepared).selectExpr("size(edges) n").collect()
    assert bytes_ == cells.count() * geo.CELL_ENTRY_BYTES + sum(r.n for r in copies) * geo.EDGE_BYTES
    assert {r.level for r in cells.collect()} == set(levels)


def _square(key, x, y, side, part=0):
    return (key, part, [_ring((x, y), (x + side, y), (x + side, y + side), (x, y + side))])


LAYER = "key bigint, part int, rings array<array<array<double>>>"


def test_one_outsized_polygon_costs_a_few_rows(spark):
    rows = [_square(i, i * 1.5, i % 7, 1.0) for i in range(50)] + [_square(99, -100.0, -100.0, 1000.0)]
    layer = spark.createDataFrame(rows, LAYER)
    prepared = geo._prepared(layer)
    assert geo.polygon_cells(prepared).count() <= 4 * 51
    assert geo.polygon_strips(prepared).selectExpr("sum(size(edges)) n").first().n <= 51 * (4 * 4 + 8)
    got = {(r.lkey, r.rkey) for r in geo.polygons_intersecting(layer, layer).collect()}
    assert {(99, i) for i in range(50)} <= got and {(i, 99) for i in range(50)} <= got
    assert (0, 1) not in got and (0, 0) in got


def test_polygon_of_many_edges_has_short_strips(spark):
    import math
    ring = [[50 + 40 * math.cos(2 * math.pi * i / 4000), 50 + 40 * math.sin(2 * math.pi * i / 4000)] for i in range(4000)]
    layer = spark.createDataFrame([(1, 0, [[*ring, ring[0]]])], LAYER)
    strips = geo.polygon_strips(geo._prepared(layer)).selectExpr("max(size(edges)) most", "sum(size(edges)) n").first()
    assert strips.n <= 4 * 4000 + 8 and strips.most < 400
    pts = spark.createDataFrame([(1, 50.0, 50.0), (2, 95.0, 50.0), (3, 50.0, 89.9)], "key bigint, px double, py double")
    got = {(r.key, r.polygon_key) for r in geo.points_in_polygons(pts, layer).collect()}
    assert got == {(1, 1), (2, None), (3, 1)}


def test_stacked_squares(spark):
    layer = spark.createDataFrame([_square(i, 0.0, 0.0, 1.0) for i in range(300)], LAYER)
    assert geo.polygon_cells(geo._prepared(layer)).count() <= 4 * 300
    pts = spark.createDataFrame([(1, 0.5, 0.5), (2, 1.0, 0.5)], "key bigint, px double, py double")
    got = geo.points_in_polygons(pts, layer).collect()
    assert sum(r.key == 1 for r in got) == 300 and [r.polygon_key for r in got if r.key == 2] == [None]


def test_point_on_an_edge_of_a_decimal_polygon(spark):
    layer = spark.createDataFrame([(1, 0, [_ring((3.4, 0), (5, 0), (5, 1), (3.4, 1))])], LAYER)
    pts = spark.createDataFrame([(1, 3.4, 0.5)], "key bigint, px double, py double")
    assert [r.polygon_key for r in geo.points_in_polygons(pts, layer, boundary=False).collect()] == [None]
    assert [r.polygon_key for r in geo.points_in_polygons(pts, layer, boundary=True).collect()] == [1]


def test_repeated_part_is_refused(spark):
    import pytest
    layer = spark.createDataFrame([_square(1, 0, 0, 1.0), _square(1, 5, 5, 1.0)], LAYER)
    pts = spark.createDataFrame([(1, 0.5, 0.5)], "key bigint, px double, py double")
    with pytest.raises(ValueError, match="key 1, part 0"):
        geo.points_in_polygons(pts, layer)


def test_second_part_counts(spark):
    layer = spark.createDataFrame([_square(1, 0.0, 0.0, 1.0), _square(1, 5.0, 5.0, 1.0, part=1)], LAYER)
    pts = spark.createDataFrame([(1, 0.5, 0.5), (2, 5.5, 5.5), (3, 3.0, 3.0)], "key bigint, px double, py double")
    got = {(r.key, r.polygon_key) for r in geo.points_in_polygons(pts, layer).collect()}
    assert got == {(1, 1), (2, 1), (3, None)}


def test_centroid_far_from_the_origin(spark):
    far = 1e8
    layer = spark.createDataFrame([_square(1, far, far, 20.0)], LAYER)
    r = geo.centroids(layer).first()
    assert r.area == 400 and abs(r.cx - far - 10) < 1e-6 and abs(r.cy - far - 10) < 1e-6
