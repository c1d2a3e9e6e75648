"""Randomised identity: aggregate-first metrics equal metrics over the built joins."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from blocklot.plans import housing as H

SETTINGS = settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))

small = lambda *vals: st.one_of(st.none(), st.sampled_from(vals))

job = st.tuples(small(101.0, 102.0, 205.0), small(1.0, 2.0), small(1000000001, 1000000002),
                small("1/5/2020", "2019", "3/3/2019"), st.integers(1, 9))
building = st.tuples(small(1, 2, 3), small(1000000001.0, 1000000002.0), small("MN-01", "MN-02", " bx - 5", "XX-1"),
                     small(1.0, 2.0), small("01/05/2020", "03/03/2019"), small("Preservation", "New Construction"),
                     st.integers(1, 50))

JOB_SCHEMA = ("Job_ID bigint, CommntyDst double, CouncilDst double, CenTract20 double, BBL bigint, "
              "CompltYear string, PermitYear string, ClassANet double, ZoningDst1 string, FloorsProp double")
BUILDING_SCHEMA = ("Project_ID bigint, BBL double, community_district string, council_district double, "
                   "census_tract double, Project_Completion_Date string, Reporting_Construction_Type string, "
                   "All_Counted_Units double")


@SETTINGS
@given(jobs=st.lists(job, min_size=1, max_size=30), buildings=st.lists(building, min_size=1, max_size=40))
def test_metrics_and_rollup_forms_agree(spark, jobs, buildings):
    h = spark.createDataFrame([(i, c, k, 100.0, b, y, "2018", float(n), "Z", 3.0)
                               for i, (c, k, b, y, n) in enumerate(jobs)], JOB_SCHEMA)
    a = spark.createDataFrame([(p, b, cd, k, 200.0, d, t, float(u)) for p, b, cd, k, d, t, u in buildings],
                              BUILDING_SCHEMA)
    hc, ac = H.clean_housing(h), H.clean_affordable(a)
    assert tuple(H.housing_metrics(hc, ac).first()) == \
        tuple(H.housing_metrics_from_join(H.join_housing_affordable(hc, ac)).first())
    pre = H.units_rollup_from_sources(h, a)
    pairs = H.units_rollup(H.join_by_lot_year(H.standardise_job_keys(h), a))
    assert pre.exceptAll(pairs.select(*pre.columns)).count() == 0
    assert pairs.select(*pre.columns).exceptAll(pre).count() == 0
