"""The packed R-tree against comparison of all pairs of boxes."""

import random

import pytest
from pyspark.sql import functions as F

from blocklot.operators import geometry as geo
from blocklot.operators.positions import numbered
from blocklot.operators.rtree import BOX, RTree

SCHEMA = "minx double, miny double, maxx double, maxy double"


def boxes(spark, rows, name):
    return spark.createDataFrame([(*b, i) for i, b in enumerate(rows)], f"{SCHEMA}, {name} long")


def random_boxes(n, seed, far=100):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        x, y = rng.randint(0, far), rng.randint(0, far)
        w, h = (rng.choice([0, 1, 3, 40]) for _ in "wh")
        out.append((float(x), float(y), float(x + w), float(y + h)))
    return out


def meet(a, b):
    return a[0] <= b[2] and b[0] <= a[2] and a[1] <= b[3] and b[1] <= a[3]


def pairs(df):
    return sorted((r.q, r.e) for r in df.collect())


@pytest.mark.parametrize("n,capacity", [(0, 4), (1, 4), (3, 4), (70, 4), (300, 3), (300, 64)])
def test_equals_all_pairs(spark, n, capacity):
    entries, queries = random_boxes(n, n), random_boxes(60, 7)
    tree = RTree.of(boxes(spark, entries, "e"), capacity)
    want = sorted((i, j) for i, q in enumerate(queries) for j, e in enumerate(entries) if meet(q, e))
    asked = boxes(spark, queries, "q")
    assert pairs(tree.meeting(asked)) == want
    assert pairs(tree.meeting(asked, max_broadcast_bytes=-1)) == want  # every level by a shuffle join


def test_nodes_are_full_and_hold_their_children(spark):
    n, capacity = 500, 4
    tree = RTree.of(boxes(spark, random_boxes(n, 3), "e"), capacity)
    assert len(tree.levels) == 4 and len(tree.tops) <= 2 * capacity
    above = {t[0]: t[1:] for t in tree.tops}
    for k, (level, size) in enumerate(tree.levels):
        rows = level.collect()
        assert len(rows) == size
        held = {}
        for r in rows:
            held.setdefault(r.node, []).append(r)
            b = above[r.node]
            assert b[0] <= r.minx and b[1] <= r.miny and b[2] >= r.maxx and b[3] >= r.maxy
        assert max(map(len, held.values())) <= capacity
        assert len(held) <= -(-size // capacity) + size ** 0.5
        if k + 1 < len(tree.levels):
            above = {r.own: tuple(r[c] for c in BOX) for r in rows}


def test_hot_places_nulls_and_names(spark):
    entries = [(0.0, 0.0, 1.0, 1.0)] * 200 + random_boxes(50, 5) + [(None, 0.0, 1.0, 1.0)]
    queries = [(0.5, 0.5, 0.5, 0.5)] * 40 + [(1.0, 1.0, 1.0, 1.0), (0.0, None, 0.0, 0.0)]
    want = sorted((i, j) for i, q in enumerate(queries) for j, e in enumerate(entries) if None not in (*q, *e) and meet(q, e))
    got = RTree.of(boxes(spark, entries, "e"), 8).meeting(boxes(spark, queries, "q"), -1)
    assert pairs(got) == want and len(want) >= 8200
    with pytest.raises(ValueError, match="queries and entries"):
        RTree.of(boxes(spark, entries, "e")).meeting(boxes(spark, queries, "e"))


def test_places_in_order(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), rng.randint(0, 50), i) for i in range(400)]
    df = spark.createDataFrame(rows, "g string, x long, i long").repartition(6)
    got = numbered(df, ["x"], "at", ["g"]).collect()
    for g in ("a", "b", None):
        own = sorted((r["at"], r.x) for r in got if r.g == g)
        assert [a for a, _ in own] == list(range(len(own))) and [x for _, x in own] == sorted(x for _, x in own)
    alone = sorted((r["at"], r.x, r.i) for r in numbered(df, ["x", "i"], "at").collect())
    assert [(x, i) for _, x, i in alone] == sorted((x, i) for _, x, i in rows) and [a for a, _, _ in alone] == list(range(400))


def test_joins_by_tree_equal_joins_by_grid(spark):
    rng = random.Random(8)
    layers = []
    for base in (0, 1000):
        rows = []
        for k in range(60):
            x, y, w, h = rng.randint(-50, 50) / 7, rng.randint(-50, 50) / 7, rng.choice([0.1, 1.0, 9.7]), rng.choice([0.3, 2.1])
            ring = [[x, y], [x + w, y + h / 3], [x + w / 2, y + h], [x, y]]
            rows.append((base + k // 2, k % 2, [ring]))
        layers.append(spark.createDataFrame(rows, "key bigint, part int, rings array<array<array<double>>>"))
    left, right = map(geo.Layer.of, layers)
    pts = spark.createDataFrame([(i, rng.randint(-60, 60) / 7, rng.randint(-60, 60) / 7) for i in range(300)], "key bigint, px double, py double")

    def rows_of(df):
        return sorted(map(tuple, df.collect()), key=repr)
    for limit in (1 << 26, 0):
        found = rows_of(geo.points_in_polygons(pts, left, max_broadcast_bytes=limit, index=geo.TREE))
        assert found == rows_of(geo.points_in_polygons(pts, left)) and any(r[1] is not None for r in found)
    assert rows_of(geo.polygons_intersecting(left, right, index=geo.TREE)) == rows_of(geo.polygons_intersecting(left, right))
