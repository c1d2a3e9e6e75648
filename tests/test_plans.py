"""Physical plans: pruned scans, pushed filters, size-checked broadcasts."""

from blocklot.plans import housing as H
from blocklot.plans import school
from blocklot.sources import ingest, standins


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_used_columns_and_pushes_filters(spark, sf_dir):
    h = ingest.housing_jobs(spark, sf_dir)
    q = H.clean_housing(h).select("Job_ID", "community_district")
    plan = _plan(q)
    assert "PushedFilters: [IsNotNull(CommntyDst), IsNotNull(CouncilDst)]" in plan
    assert "ReadSchema: struct<Job_ID:bigint,CommntyDst:double,CouncilDst:double>" in plan


def test_flagship_builds_no_pairs(spark, sf_dir):
    h, a = ingest.housing_jobs(spark, sf_dir), ingest.affordable_buildings(spark, sf_dir)
    plan = _plan(H.housing_metrics(H.clean_housing(h), H.clean_affordable(a)))
    # Both sides are aggregated before the key join.
    assert plan.count("HashAggregate") >= 6
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_dimension_tables_broadcast(spark, sf_dir):
    q = school.school_bridge(ingest.housing_jobs(spark, sf_dir), standins.community_to_school(spark, sf_dir),
                             standins.school_capacity(spark, sf_dir))
    q.collect()
    assert _plan(q).count("BroadcastHashJoin") >= 2


def test_school_bridge_without_broadcast_equals_broadcast(spark, sf_dir):
    h = ingest.housing_jobs(spark, sf_dir)
    xw, sc = standins.community_to_school(spark, sf_dir), standins.school_capacity(spark, sf_dir)
    small = school.school_bridge(h, xw, sc)
    big = school.school_bridge(h, xw, sc, max_broadcast_bytes=0)
    assert sorted(big.columns) == sorted(small.columns)
    assert big.exceptAll(small.select(*big.columns)).count() == 0
    assert small.select(*big.columns).exceptAll(big).count() == 0
