"""Duplicate counts kept over loads, against counts over all rows at once."""

import random

import pytest
from pyspark.sql import functions as F

from blocklot.operators import profile
from blocklot.operators.duplicates import DuplicateState

SCHEMA = "a long, b string, c double"


def loads(spark, seed, n=4, size=120):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        rows = [(rng.choice([None, 1, 2, 3]), rng.choice(["x", "y", None, ""]), rng.choice([0.5, float("nan"), None])) for _ in range(size * k)]
        out.append(spark.createDataFrame(rows + [(k, "hot", 1.0)] * 50, SCHEMA))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_rows_at_once(spark, seed):
    state, whole = DuplicateState(spark, ["a", "b", "c"], buckets=5), None
    assert tuple(state.report().first()) == (0, 0, 0, 3)
    for load in loads(spark, seed):
        whole = load if whole is None else whole.unionByName(load)
        assert tuple(state.add(load).report().first()) == tuple(profile.dataset_checks(whole).first())


def test_the_stored_side_is_not_exchanged(spark):
    one, two = loads(spark, 3)[1:3]
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        state = DuplicateState(spark, ["a", "b", "c"], buckets=16).add(one)
        out = state.merged(two)
        out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        stored, new = plan[plan.index("SortMergeJoin"):].split("Scan parquet", 1)
        assert "Exchange" not in stored and "Exchange" in plan and "Bucketed: true" in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_failed_load_leaves_the_state(spark):
    state = DuplicateState(spark, ["a", "b", "c"]).add(loads(spark, 4)[1])
    before = tuple(state.report().first())
    broken = spark.range(3).select(F.raise_error(F.lit("no")).cast("long").alias("a"), F.lit("x").alias("b"), F.lit(1.0).alias("c"))
    with pytest.raises(Exception):
        state.add(broken)
    assert tuple(state.report().first()) == before
    with pytest.raises(ValueError, match="columns"):
        state.add(spark.range(1))
