"""Joins to a dimension with many rows a key: packed, dealt over more tasks, the plain join's rows."""

import pytest
from pyspark.sql import functions as F

from blocklot.operators.joins import fan_out_join
from blocklot.plans import school


def _tables(spark):
    jobs = spark.createDataFrame([(1, 2.0), (2, 2.0), (2, 2.0), (3, None), (4, 7.0), (5, -0.0), (6, 9.5)], "job bigint, dist double")
    schools = spark.createDataFrame(
        [(10, 2, "a"), (11, 2, None), (11, 2, None), (12, 2, "b"), (13, 9, "c"), (14, None, "d"), (15, 0, "e"), (None, 2, "f")],
        "school bigint, geo bigint, name string")
    return jobs, schools


def _same(got, want):
    assert got.columns == want.columns and got.dtypes == want.dtypes
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


@pytest.mark.parametrize("options", [{}, {"packed_rows": 1}, {"packed_rows": 2, "built_rows": 1}, {"built_rows": 5}, {"max_bytes": 0}])
def test_rows_of_the_plain_left_join(spark, options):
    jobs, schools = _tables(spark)
    _same(fan_out_join(jobs, schools, "dist", "geo", **options), jobs.join(schools, jobs.dist == schools.geo, "left"))


def test_empty_sides(spark):
    jobs, schools = _tables(spark)
    for j, s in ((jobs.limit(0), schools), (jobs, schools.limit(0)), (jobs, schools.where("geo IS NULL"))):
        _same(fan_out_join(j, s, "dist", "geo"), j.join(s, j.dist == s.geo, "left"))


def test_a_task_for_each_share_of_the_result(spark):
    jobs = spark.range(0, 1000, 1, 2).select("id", (F.col("id") % 3).cast("double").alias("dist"))
    schools = spark.range(300).select(F.col("id").alias("school"), (F.col("id") % 3).alias("geo"))
    for built_rows, tasks in ((10_000, 10), (100_000, 2)):
        out = fan_out_join(jobs, schools, "dist", "geo", built_rows=built_rows)
        assert out.rdd.getNumPartitions() == tasks
        per_task = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(per_task) == 100_000 and max(per_task) <= 2 * 100_000 // tasks


def test_school_bridge_meets_packed_schools(spark):
    jobs = spark.createDataFrame([(1, 101.0), (2, 101.0), (3, None)], "Job_ID bigint, CommntyDst double")
    xw = spark.createDataFrame([(101, 4.0)], "BoroCD bigint, SchoolDist double")
    schools = spark.range(50).select(F.col("id").alias("School_ID"), F.lit(4).cast("bigint").alias("Geo_Dist"),
                                     F.lit(500).alias("Org_Target_Cap"), F.lit(480).alias("Org_Enroll"))
    out = school.school_bridge(jobs, xw, schools)
    assert out.count() == 101 and out.where("SchoolCapacity = 20").count() == 100
    # The join makes three rows, one for each job; the schools come out of an array.
    assert "Generate inline" in out._jdf.queryExecution().executedPlan().toString()


def _bytes(df, path):
    df.write.parquet(str(path))
    return sum(f.stat().st_size for f in path.rglob("*.parquet"))


def test_result_is_small_when_written(spark, tmp_path):
    jobs = spark.range(0, 1500, 1, 2).select("id", (F.col("id") % 30).cast("double").alias("dist"))
    schools = spark.range(9000).select(F.col("id").alias("school"), (F.col("id") % 30).alias("geo"),
                                       F.xxhash64("id").alias("code"), F.pmod(F.xxhash64("id"), F.lit(701)).alias("seats"))
    plain = jobs.join(F.broadcast(schools), jobs.dist == schools.geo, "left")
    for options in ({}, {"packed_rows": 64}, {"packed_rows": 128, "built_rows": 100_000}):
        out = fan_out_join(jobs, schools, "dist", "geo", **options)
        _same(out, plain)
        # The schools of a district come again and again, job after job: 450,000 rows, few more bytes than 9,000.
        assert _bytes(out, tmp_path / f"out{len(options)}") < 0.4 * _bytes(plain, tmp_path / f"plain{len(options)}")


def test_order_of_the_result(spark):
    jobs = spark.range(0, 400, 1, 1).select("id", (F.col("id") % 4).cast("double").alias("dist"))
    schools = spark.range(1200).select(F.col("id").alias("school"), (F.col("id") % 4).alias("geo"))
    out = fan_out_join(jobs, schools, "dist", "geo", packed_rows=100)
    rows = [(r.dist, r.school // 400, r.id) for r in out.collect()]
    # 12 arrays, each of them with its 100 jobs.
    assert len(rows) == 120_000 and sum(a[:2] != b[:2] for a, b in zip(rows, rows[1:])) == 11
    assert sum(a != b for a, b in zip(rows, rows[1:])) == 12 * 100 - 1


def test_few_rows_a_key_are_not_sorted(spark):
    jobs, schools = _tables(spark)
    assert "Sort [dist" not in fan_out_join(jobs, schools, "dist", "geo")._jdf.queryExecution().executedPlan().toString()
