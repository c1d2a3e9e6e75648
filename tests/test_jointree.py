"""Sums over join trees against the joined rows themselves."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from blocklot.operators.jointree import JoinTree, joined_sums

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
key = st.one_of(st.none(), st.integers(0, 3))
value = st.one_of(st.none(), st.integers(-5, 5))
rows = st.lists(st.tuples(key, key, value), max_size=9)


@SETTINGS
@given(a=rows, b=rows, c=rows, d=rows, hows=st.tuples(*[st.sampled_from(["left", "inner"])] * 3))
def test_equals_the_joined_rows(spark, a, b, c, d, hows):
    frames = [spark.createDataFrame(t, "k long, j long, v long") for t in (a, b, c, d)]
    fa, fb, fc, fd = frames
    tree = JoinTree(fa, groups={"ga": "j"}, sums={"sa": "v"}).join(
        JoinTree(fb, sums={"sb": "v"}).join(JoinTree(fc, groups={"gc": "v"}, sums={"sc": "j"}), {"j": "k"}, hows[1]),
        {"k": "k"}, hows[0]).join(JoinTree(fd, sums={"sd": "v"}), {"j": "k"}, hows[2])
    got = sorted((tuple(r) for r in joined_sums(tree).collect()), key=repr)
    named = [f.select(*[F.col(x).alias(f"{n}{x}") for x in "kjv"]) for n, f in zip("abcd", frames)]
    inner = named[1].join(named[2], F.col("bj") == F.col("ck"), hows[1])
    joined = named[0].join(inner, F.col("ak") == F.col("bk"), hows[0]).join(named[3], F.col("aj") == F.col("dk"), hows[2])
    want = joined.groupBy(F.col("aj").alias("ga"), F.col("cv").alias("gc")).agg(
        F.count(F.lit(1)), *[F.coalesce(F.sum(x), F.lit(0)) for x in ("av", "bv", "cj", "dv")])
    assert got == sorted((tuple(r) for r in want.collect()), key=repr)


@SETTINGS
@given(a=rows, b=rows, safe=st.booleans())
def test_null_safe_keys_and_no_groups(spark, a, b, safe):
    fa, fb = (spark.createDataFrame(t, "k long, j long, v long") for t in (a, b))
    tree = JoinTree(fa, sums={"sa": "v"}).join(JoinTree(fb, sums={"sb": "v"}), {"k": "k", "j": "j"}, null_safe=safe)
    [got] = joined_sums(tree).collect()

    def same(x, y):
        return x == y if x is not None and y is not None else safe and x is None and y is None
    n = sa = sb = 0
    for x in a:
        hit = [y for y in b if same(x[0], y[0]) and same(x[1], y[1])]
        n += max(1, len(hit))
        sa += (x[2] or 0) * max(1, len(hit))
        sb += sum(y[2] or 0 for y in hit)
    assert tuple(got) == (n, sa, sb)


def test_hot_keys_and_no_pairs(spark):
    """A third of the rows on one key: millions of joined rows, none of them built."""
    big = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), F.lit(2).alias("v"))
    tree = JoinTree(big, groups={"k": "k"}, sums={"left_sum": "v"}).join(JoinTree(big, sums={"right_sum": "v"}), {"k": "k"})
    out = joined_sums(tree, rows_per_task=100)
    hot = out.where("k = 0").first()
    n = big.where("k = 0").count()
    assert (hot.joined_rows, hot.left_sum, hot.right_sum) == (n * n, 2 * n * n, 2 * n * n) and n * n > 9_000_000
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") > plan.index("Aggregate")  # both sides are reduced before they meet
    assert out.count() == 50


def test_refusals(spark):
    t = spark.createDataFrame([(1, 2)], "k long, v long")
    with pytest.raises(ValueError, match="repeat"):
        joined_sums(JoinTree(t, sums={"x": "v"}).join(JoinTree(t, sums={"X": "v"}), {"k": "k"}))
    with pytest.raises(ValueError, match="left and inner"):
        JoinTree(t).join(JoinTree(t), {"k": "k"}, "full")
    with pytest.raises(ValueError, match="keys"):
        JoinTree(t).join(JoinTree(t), {})


def test_empty_tables(spark):
    t = spark.createDataFrame([], "k long, v long")
    assert tuple(joined_sums(JoinTree(t, sums={"x": "v"}).join(JoinTree(t, sums={"y": "v"}), {"k": "k"})).first()) == (0, 0, 0)
    assert joined_sums(JoinTree(t, groups={"k": "k"}).join(JoinTree(t), {"k": "k"})).count() == 0
