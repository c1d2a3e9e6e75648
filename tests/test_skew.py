"""A key holding a third of all rows: partial aggregation and AQE skew splits.

Thresholds are lowered to test scale; broadcasts are switched off so the
shuffle-join path (the one a cluster takes when the keyed side is large) is
the one exercised.
"""

import pytest
from pyspark.sql import functions as F

from blocklot.operators import aggregates as agg

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _skewed(spark, n=30000):
    # Project 0 holds a third of the rows; every 7th row has no lot.
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 2000 + 1).cast("bigint").alias("Project_ID"),
        F.when(F.col("id") % 7 == 0, F.lit(None)).otherwise(F.col("id")).cast("bigint").alias("BBL"),
        (F.col("id") % 5 + 1).cast("double").alias("All_Counted_Units"))


def test_redistribution_splits_hot_project(spark, skew_conf):
    df = _skewed(spark)
    out = agg.redistribute_missing(df, rows_per_task=1000)
    got = out.collect()
    # The hot project (about 8,600 kept rows) is spread over 9+ salts.
    salts = salted_parts(df)
    assert salts >= 9
    # Same numbers as a plain computation on the driver-side reference formula.
    pdf = df.toPandas()
    missing = pdf[pdf.BBL.isna()].groupby("Project_ID").All_Counted_Units.sum()
    kept = pdf[pdf.BBL.notna()]
    expect = (kept.All_Counted_Units + kept.Project_ID.map(missing).fillna(0)).sum()
    assert len(got) == len(kept) and sum(r.All_Counted_Units for r in got) == expect


def salted_parts(df):
    from blocklot.operators.skew import hot_keys
    return hot_keys(df.where("BBL is not null"), ["Project_ID"], 1000).where("Project_ID = 0").first()["__splits"]


def test_salted_join_equals_plain_join(spark):
    big = spark.range(5000).select((F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 50)).alias("k"),
                                   F.col("id").alias("v"))
    other = spark.range(60).select((F.col("id") % 55).alias("k"), (F.col("id") * 10).alias("w"))
    from blocklot.operators.skew import salted_join
    for how in ["left", "inner", "left_anti", "left_semi"]:
        salted = salted_join(big, other, ["k"], how=how, rows_per_task=100)
        plain = big.join(other, "k", how)
        assert salted.exceptAll(plain.select(*salted.columns)).count() == 0
        assert plain.select(*salted.columns).exceptAll(salted).count() == 0


def test_hot_key_group_sum_is_combined_map_side(spark, skew_conf):
    df = _skewed(spark)
    out = agg.group_sums(df, ["Project_ID"], {"units": "All_Counted_Units"})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan
    assert out.where("Project_ID = 0").first().units == float(sum(i % 5 + 1 for i in range(0, 30000, 3)))


def test_key_join_salted_many_to_many(spark):
    from blocklot.operators import relational as rel
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 4)
                                    .alias("k"), F.col("id").alias("v"))
    right = spark.range(40).select(F.when(F.col("id") % 10 == 0, F.lit(None)).otherwise(F.col("id") % 6)
                                   .alias("k"), F.col("id").alias("v"))
    for null_safe in (False, True):
        salted = rel.key_join(left, right, ["k"], how="left", null_safe=null_safe, skew_rows=50)
        plain = rel.key_join(left, right, ["k"], how="left", null_safe=null_safe)
        assert salted.columns == plain.columns == ["k", "v_x", "v_y"]
        assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0


def test_aqe_alone_leaves_aggregate_join_unsplit(spark, skew_conf):
    """Why the salting exists: AQE does not split a join fed by an aggregate."""
    df = _skewed(spark)
    missing = agg.missing_key_sums(df, "Project_ID", "BBL", "All_Counted_Units", "__m")
    plain = df.where("BBL is not null").join(missing, "Project_ID", "left")
    plain.collect()
    plan = plain._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "skew=true" not in plan


def _equal(one, other):
    other = other.select(*one.columns)
    return one.exceptAll(other).count() == 0 and other.exceptAll(one).count() == 0


def test_hot_null_keys_are_spread(spark):
    from blocklot.operators.skew import salted_join
    left = spark.range(3000).select(F.when(F.col("id") % 2 == 0, F.lit(None)).otherwise(F.col("id") % 7)
                                    .cast("bigint").alias("k"), F.col("id").alias("v"))
    right = spark.range(10).select(F.col("id").alias("k"), F.col("id").alias("w"))
    assert _equal(salted_join(left, right, ["k"], how="left", rows_per_task=100), left.join(right, "k", "left"))


def _salt_pairs(left, right, rows_per_task):
    """Distinct (left salt, right salt) places of key 0, from the joined rows' own salts."""
    from blocklot.operators import skew
    table = left.sparkSession.createDataFrame(
        [(0, skew._hot_list(left, ["k"], rows_per_task).get((0,), 1), skew._hot_list(right, ["j"], rows_per_task).get((0,), 1))],
        "__hot0 bigint, __l_splits int, __r_splits int")
    ls = skew._salted(left, ["k"], table, "l", "r").where("k = 0")
    return ls.select("__l", "__r").distinct().count()


def test_right_side_hot_key_is_split(spark):
    from blocklot.operators.skew import split_join
    left = spark.range(40).select((F.col("id") % 4).alias("k"), F.col("id").alias("v"))
    right = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") + 5).alias("j"),
                                     F.col("id").alias("w"))
    assert _salt_pairs(left, right, 100) == 30
    for how in ("left", "inner", "left_semi", "left_anti"):
        for null_safe in (False, True):
            got = split_join(left, right, ["k"], ["j"], how, null_safe, rows_per_task=100)
            assert _equal(got, left.join(right, left.k == right.j, how)), how


def test_hot_on_both_sides_with_nulls(spark):
    from blocklot.operators.skew import split_join
    left = spark.range(900).select(F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 3 == 1, F.lit(None))
                                   .otherwise(F.col("id")).cast("bigint").alias("k"), F.col("id").alias("v"))
    right = spark.range(600).select(F.when(F.col("id") % 2 == 0, 0).when(F.col("id") % 5 == 1, F.lit(None))
                                    .otherwise(F.col("id")).cast("bigint").alias("j"), F.col("id").alias("w"))
    for how in ("left", "inner", "left_semi", "left_anti"):
        for null_safe in (False, True):
            on = left.k.eqNullSafe(right.j) if null_safe else left.k == right.j
            got = split_join(left, right, ["k"], ["j"], how, null_safe, rows_per_task=50)
            assert _equal(got, left.join(right, on, how)), (how, null_safe)


def test_identical_rows_are_spread(spark):
    from blocklot.operators import skew
    left = spark.range(1000).select(F.lit(0).cast("bigint").alias("k"), F.lit(1).alias("v"))
    right = spark.range(3).select(F.col("id").alias("j"), F.col("id").alias("w"))
    assert _salt_pairs(left, right, 100) == 10
    assert skew.split_join(left, right, ["k"], ["j"], "left", rows_per_task=100).count() == 1000


def test_without_hot_keys_the_join_is_plain(spark):
    from blocklot.operators.skew import split_join
    left = spark.range(50).select(F.col("id").alias("k"))
    right = spark.range(50).select(F.col("id").alias("j"))
    plan = split_join(left, right, ["k"], ["j"], rows_per_task=100)._jdf.queryExecution().optimizedPlan().toString()
    assert "__l" not in plan and "Generate" not in plan


def test_salts_are_the_same_when_a_partition_is_computed_again(spark, tmp_path):
    """The numbers that salts come from are stored: another order of the rows, another number of tasks, the same salts."""
    from blocklot.operators import skew
    rows = spark.range(3000).select((F.col("id") % 2).alias("k"), F.col("id").alias("v")).repartition(7)
    table = spark.createDataFrame([(0, 9, 1)], "__hot0 bigint, __l_splits int, __r_splits int")
    salted = skew._salted(rows, ["k"], table, "l", "r")
    first = {r.v: r["__l"] for r in salted.collect()}
    again = {r.v: r["__l"] for r in salted.orderBy(F.rand(3)).collect()}
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
        other = {r.v: r["__l"] for r in salted.repartition(3, "v").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert first == again == other and len(set(first[v] for v in first if v % 2 == 0)) == 9
    # Nothing in the plan draws a number: they are read from files.
    plan = salted._jdf.queryExecution().optimizedPlan().toString()
    assert "monotonically" not in plan and "rand(" not in plan and "Relation" in plan


def test_helper_names_do_not_clash(spark):
    from blocklot.operators.skew import salted_join
    left = spark.range(500).select((F.col("id") % 2).alias("k"), F.col("id").alias("__id"), F.lit(1).alias("__l"),
                                   F.lit(2).alias("__R_hot"), F.lit(3).alias("__rows"))
    right = spark.range(300).select((F.col("id") % 2).alias("k"), F.col("id").alias("__o_k"), F.lit(5).alias("__hot0"))
    got = salted_join(left, right, ["k"], how="left", rows_per_task=50)
    assert got.columns == ["k", "__id", "__l", "__R_hot", "__rows", "__o_k", "__hot0"]
    assert _equal(got, left.join(right, "k", "left"))


def test_a_unique_side_is_not_counted(spark):
    from blocklot.operators import skew
    left = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    right = spark.range(3).select(F.col("id").alias("j"), (F.col("id") * 10).alias("w"))
    for how in ("left", "inner", "left_semi", "left_anti"):
        for unique in (False, True):
            got = skew.split_join(left, right, ["k"], ["j"], how, rows_per_task=100, right_unique=unique)
            assert _equal(got, left.join(right, F.col("k") == F.col("j"), how))
