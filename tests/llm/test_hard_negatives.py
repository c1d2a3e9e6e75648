import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from blocklot.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, id int, Q string"


@pytest.fixture
def table(spark):
    def make(rows):
        return spark.createDataFrame([(i, v, y, 1, "x") for i, v, y in rows], SCHEMA)
    return make


def brute_force(rows, every=50, positives=5, negatives=3, low=50, high=95):
    """What the contract says, row by row, in whole numbers."""
    import math
    kept = set()
    for i, v, y in rows:
        if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.add((i, tuple(math.floor(256 * float(np.float32(x))) for x in v), y))
    out = []
    for a in kept:
        if a[0] % every:
            continue
        score = [(sum(p * q for p, q in zip(a[1], b[1])), b) for b in kept if b[0] != a[0]]
        best = sorted((-s, b[0]) for s, b in score if b[2] == a[2])[:positives]
        for neg, identity in best:
            inside = sorted((-s, b[0]) for s, b in score if b[2] != a[2] and low * -neg <= 100 * s <= high * -neg)
            for rank, (s, other) in enumerate(inside[:negatives], 1):
                out.append((a[0], identity, rank, other, -neg, -s))
    return sorted(out)


def mined(df, every=50, **options):
    return sorted(tuple(r) for r in hn.mine(hn.quantised(df), F.col("id") % every == 0, **options).collect())


def clustered(n, dims, seed, groups=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 1, (groups, dims))
    which = rng.integers(0, groups, n)
    points = centres[which] + rng.normal(0, 0.2, (n, dims))
    return [(i, points[i].astype(np.float32).tolist(), int(rng.integers(0, 3))) for i in range(n)]


@pytest.mark.parametrize("stripe_rows,block_rows", [(8192, 512), (20, 3)])
def test_equals_brute_force(table, stripe_rows, block_rows):
    rows = clustered(240, 6, 1)
    got = mined(table(rows), 5, stripe_rows=stripe_rows, block_rows=block_rows)
    assert got == brute_force(rows, 5) and len(got) > 100


def test_odd_rows(table):
    same = [0.5, 0.25]
    rows = [(0, same, 1), (1, same, 1), (2, same, 1), (3, same, 1), (4, same, 1), (5, same, 1), (6, same, 1),
            (7, [0.25, 0.25], 2), (8, [0.25, 0.25], 2), (9, [0.3, 0.25], 2), (9, [0.3, 0.25], 2), (9, [0.2, 0.2], 2),
            (50, [-0.5, -0.1], 1), (100, [], 2), (150, [0.5], 2), (200, [0.25, 0.25, 4.0], 3), (250, same, None),
            (300, None, 1), (350, [float("nan"), 0.0], 1), (351, [float("inf"), 0.0], 1), (352, [None, 0.5], 1),
            (None, same, 1), (-50, [0.4, 0.4], 2)]
    assert mined(table(rows)) == brute_force(rows)


def test_repeated_rows_and_ties_count_once(table):
    rows = clustered(60, 4, 3)
    assert mined(table(rows * 3), 10) == mined(table(rows), 10) == brute_force(rows, 10)


def test_large_components_stay_exact(table):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(0, 1, 4) * 2.0 ** 21).astype(np.float32).tolist(), i % 2) for i in range(40)]
    assert mined(table(rows), 10) == brute_force(rows, 10)


def test_empty_table(table):
    assert mined(table([])) == []
    assert mined(table([(1, [0.1], 1)])) == []


def _block(q, labels):
    rows, parent, edge = hn.spanning_tree(q)
    n = len(rows)
    return hn.Block(pa.table({"block": pa.array([0] * n), "place": pa.array(range(n)), "id": pa.array(-1 - rows),
                              "label": pa.array(labels[rows]), "q": pa.array(q[rows].tolist()), "parent": pa.array(parent),
                              "edge": pa.array(edge), "windows": pa.array([None] * n)}))


def test_tree_is_minimal_and_parents_come_first():
    q = np.random.default_rng(2).integers(-100, 100, (40, 3))
    rows, parent, edge = hn.spanning_tree(q)
    assert sorted(rows.tolist()) == list(range(40)) and (parent < np.arange(40)).all() and parent[0] == -1
    # Kruskal's rule as the plain version.
    pairs = sorted((float(((q[a] - q[b]) ** 2).sum()) ** 0.5, a, b) for a in range(40) for b in range(a))
    root, total = list(range(40)), 0.0
    for d, a, b in pairs:
        ra, rb = (next(x for x in [root[k]]) for k in (a, b))
        if ra != rb:
            root = [rb if x == ra else x for x in root]
            total += d
    assert edge.sum() == pytest.approx(total)


def test_bounds_hold_and_prune():
    rng = np.random.default_rng(4)
    centres = rng.integers(-4000, 4000, (8, 5))
    anchors = np.repeat(centres, 20, axis=0) + rng.integers(-20, 20, (160, 5))
    points = np.repeat(centres, 200, axis=0) + rng.integers(-600, 600, (1600, 5))
    stripe = hn.Stripe(np.arange(1600), rng.integers(0, 2, 1600), points)
    block = _block(anchors, rng.integers(0, 2, 160))
    for i, low, high in block.walk(stripe):
        scores = stripe.q @ block.q[i]
        assert (low <= scores).all() and (scores <= high).all()
        some = rng.random(1600) < 0.3
        low[some] = high[some] = scores[some]
    stripe.scored = 0
    found = {i: (ids.tolist(), s.tolist()) for i, ids, s in block.best_positives(stripe, 5)}
    for i, (ids, scores) in found.items():
        own = np.flatnonzero(stripe.labels == block.labels[i])
        best = sorted((-int(stripe.q[r] @ block.q[i]), int(stripe.ids[r])) for r in own)[:5]
        assert [(-s, x) for s, x in zip(scores, ids)] == best
    assert stripe.scored < 0.25 * 160 * 800  # of the rows of each anchor's label
