"""Crosswalk sets, golden crosswalk pairs, the school step by district, the quality report, duplicates by hash."""

import pytest
from pyspark.sql import functions as F

from blocklot.operators import profile
from blocklot.operators import relational as rel
from blocklot.plans import crosswalks, school
from blocklot.plans import housing as H
from blocklot.sources import ingest, standins

# Two rows, one blank where there is one, of each of the five published crosswalk pairs (raw, standardised).
GOLDEN = [
    ({"BoroCD": "community_district", "CounDist": "council_district"}, [(101, 1), (101, 3)], [(101, 1), (101, 3)], "int", "int"),
    ({"BoroCD": "community_district", "SchoolDist": "school_district"}, [(101, 2.0), (356, None)], [(101, 2), (356, None)], "int", "double"),
    ({"BoroCD": "community_district", "CT2020": "census_tract"}, [(101, "000700"), (356, None)], [(101, "000700"), (356, None)], "int", "string"),
    ({"CounDist": "council_district", "SchoolDist": "school_district"}, [(1, 2.0), (8, None)], [(1, 2), (8, None)], "int", "double"),
    ({"CounDist": "council_district", "CT2020": "census_tract"}, [(1, "001501"), (8, None)], [(1, "001501"), (8, None)], "int", "string"),
]


@pytest.mark.parametrize("names,raw,want,left,right", GOLDEN)
def test_every_crosswalk_form_is_standardised(spark, names, raw, want, left, right):
    a, b = names
    df = spark.createDataFrame(raw, f"{a} {left}, {b} {right}")
    out = crosswalks.standardise_crosswalk(df, names)
    assert out.columns == list(names.values()) and [tuple(r) for r in out.collect()] == want


def test_school_step_has_one_row_per_job(spark, sf_dir):
    h = ingest.housing_jobs(spark, sf_dir)
    xw, sc = standins.community_to_school(spark, sf_dir), standins.school_capacity(spark, sf_dir)
    out = school.school_bridge_by_district(h, xw, sc)
    assert out.count() == h.count()
    pairs = school.school_bridge(h, xw, sc)
    assert out.agg(F.sum(F.greatest(F.coalesce("schools", F.lit(0)), F.lit(1)))).first()[0] == pairs.count()


def test_council_school_summary_equals_the_built_chain(spark, sf_dir):
    h = ingest.housing_jobs(spark, sf_dir).where("Job_ID % 5 = 0")
    a = ingest.affordable_buildings(spark, sf_dir).where("Project_ID % 7 = 0")
    xw, sc = standins.community_to_school(spark, sf_dir), standins.school_capacity(spark, sf_dir)
    built = school.school_bridge(h.join(a, h.CouncilDst.eqNullSafe(a.council_district), "left"), xw, sc)
    want = built.agg(F.count(F.lit(1)), F.sum("ClassANet"), F.sum("All_Counted_Units")).first()
    got = school.council_school_summary(h, a, xw, sc).agg(
        F.sum("joined_rows"), F.sum("housing_units"), F.sum("affordable_units")).first()
    assert tuple(got) == tuple(want)


def test_quality_report_agrees_with_the_built_join(spark, sf_dir):
    h, a = ingest.housing_jobs(spark, sf_dir), ingest.affordable_buildings(spark, sf_dir)
    report = H.join_quality_report(h, a).first()
    joined = H.join_by_lot_year(h, a)
    assert H.rows_without_partner(joined, H.prepare_completed_jobs(h), H.prepare_new_construction(a)).count() == report.unjoined_rows
    assert report.affordable_rows_left == report.affordable_rows_new - report.affordable_missing_lot
    assert H.unmatched_jobs(h, a).count() == report.unjoined_rows


def test_columns_not_in_ignores_case(spark):
    left, right = spark.createDataFrame([(1, 2)], "A int, b int"), spark.createDataFrame([(1, 2, 3)], "a int, C int, B int")
    assert rel.columns_not_in(right, left) == ["C"]


def test_unmatched_reads_two_columns_of_the_buildings(spark, sf_dir):
    plan = H.unmatched_jobs(ingest.housing_jobs(spark, sf_dir), ingest.affordable_buildings(spark, sf_dir))
    text = plan._jdf.queryExecution().executedPlan().toString()
    schema = next(x for x in text.split("\n") if "Project_Completion_Date" in x and "ReadSchema" in x)
    assert "council_district" not in schema.split("ReadSchema")[1] and "Project_ID" not in schema.split("ReadSchema")[1]


def test_duplicates_by_hash_equal_whole_rows(spark):
    rows = [(1, "a", 1.0), (1, "a", 1.0), (2, None, float("nan")), (2, None, float("nan")), (3, "b", 0.0), (3, "b", -0.0),
            (4, "", None)]
    df = spark.createDataFrame(rows, "k int, s string, x double")
    r = profile.dataset_checks(df).first()
    assert (r.total_rows, r.duplicated_rows, r.rows_with_missing, r["columns"]) == (7, 6, 3, 3)
    assert profile.dataset_checks(df.where("k = 4")).first().duplicated_rows == 0
    assert tuple(profile.dataset_checks(df.where("false")).first()) == (0, 0, 0, 3)
