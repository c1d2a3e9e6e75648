"""Randomised checks of the grid spatial joins on rectangles with a plain spec."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from blocklot.operators import geometry as geo

SETTINGS = settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))

rect = st.tuples(st.integers(0, 40), st.integers(0, 40), st.integers(1, 25), st.integers(1, 25))
rects = st.lists(rect, min_size=1, max_size=12)
points = st.lists(st.tuples(st.integers(0, 70), st.integers(0, 70)), min_size=1, max_size=25)
# Two decimals: most are no binary fractions, so cell arithmetic that rounds would show.
cent = st.integers(-4000, 4000).map(lambda v: v / 100)


def _layer(spark, rs, base):
    rows = []
    for i, (x, y, w, h) in enumerate(rs):
        ring = [[float(x), float(y)], [float(x + w), float(y)], [float(x + w), float(y + h)],
                [float(x), float(y + h)], [float(x), float(y)]]
        rows.append((base + i, 0, [ring]))
    return spark.createDataFrame(rows, "key bigint, part int, rings array<array<array<double>>>")


@SETTINGS
@given(rs=rects, ps=points)
def test_points_in_rectangles(spark, rs, ps):
    layer = _layer(spark, rs, 100)
    pts = spark.createDataFrame([(i, float(px), float(py)) for i, (px, py) in enumerate(ps)],
                                "key bigint, px double, py double")
    for boundary in (False, True):
        got = {(r.key, r.polygon_key) for r in geo.points_in_polygons(pts, layer, boundary=boundary).collect()}
        want = set()
        for i, (px, py) in enumerate(ps):
            hit = [100 + j for j, (x, y, w, h) in enumerate(rs)
                   if ((x <= px <= x + w and y <= py <= y + h) if boundary
                       else (x < px < x + w and y < py < y + h))]
            want |= {(i, k) for k in hit} if hit else {(i, None)}
        assert got == want


@SETTINGS
@given(a=rects, b=rects)
def test_rectangles_intersect(spark, a, b):
    left, right = _layer(spark, a, 0), _layer(spark, b, 1000)
    got = {(r.lkey, r.rkey) for r in geo.polygons_intersecting(left, right).collect()}
    want = set()
    for i, (x, y, w, h) in enumerate(a):
        hit = [1000 + j for j, (u, v, p, q) in enumerate(b)
               if x <= u + p and u <= x + w and y <= v + q and v <= y + h]
        want |= {(i, k) for k in hit} if hit else {(i, None)}
    assert got == want


@SETTINGS
@given(rs=st.lists(st.tuples(cent, cent, st.integers(1, 2500), st.integers(1, 2500)), min_size=1, max_size=10),
       extra=st.lists(st.tuples(cent, cent), max_size=10))
def test_decimal_points_on_edges_and_corners(spark, rs, extra):
    boxes = [(x, y, x + w / 100, y + h / 100) for x, y, w, h in rs]
    layer = spark.createDataFrame([(i, 0, [[[a, b], [c, b], [c, d], [a, d], [a, b]]]) for i, (a, b, c, d) in enumerate(boxes)],
                                  "key bigint, part int, rings array<array<array<double>>>")
    ps = extra + [p for a, b, c, d in boxes for p in ((a, b), (c, d), (a, (b + d) / 2), ((a + c) / 2, d))]
    pts = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(ps)], "key bigint, px double, py double")
    for boundary in (False, True):
        got = {(r.key, r.polygon_key) for r in geo.points_in_polygons(pts, layer, boundary=boundary).collect()}
        want = set()
        for i, (x, y) in enumerate(ps):
            hit = [j for j, (a, b, c, d) in enumerate(boxes)
                   if ((a <= x <= c and b <= y <= d) if boundary else (a < x < c and b < y < d))]
            want |= {(i, j) for j in hit} if hit else {(i, None)}
        assert got == want
