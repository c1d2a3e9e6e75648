"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver tables (through the stand-in derivations) over
whole tables; none filters rows to make itself cheaper. Limits appear only
where the operator is a preview or a sample.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, keys, layouts
from ..operators import aggregates as agg
from ..operators import duplicates
from ..operators import geometry as geo
from ..operators import preview, profile
from ..operators import relational as rel
from ..session import scratch_path
from ..sources import geojson, ingest, layers, messy, standins, tables
from ..sources.tables import read_table
from . import housing as H
from . import crosswalks, school

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def wrap(fn):
        QUERIES[name] = fn
        return fn
    return wrap


def _h(spark, sf_dir):
    return ingest.housing_jobs(spark, sf_dir)


def _a(spark, sf_dir):
    return ingest.affordable_buildings(spark, sf_dir)


@register("housing_metrics")
def housing_metrics(spark, sf_dir):
    """Flagship (C4): rows, housing units, affordable units of the C3 join."""
    return H.housing_metrics(H.clean_housing(_h(spark, sf_dir)), H.clean_affordable(_a(spark, sf_dir)))


@register("housing_metrics_join_form")
def housing_metrics_join_form(spark, sf_dir):
    """C4 computed over the built C3 rows (cross-check of the flagship)."""
    joined = H.join_housing_affordable(H.clean_housing(_h(spark, sf_dir)),
                                       H.clean_affordable(_a(spark, sf_dir)))
    return H.housing_metrics_from_join(joined)


@register("housing_clean")
def housing_clean(spark, sf_dir):
    return H.clean_housing(_h(spark, sf_dir))


@register("affordable_clean")
def affordable_clean(spark, sf_dir):
    return H.clean_affordable(_a(spark, sf_dir))


@register("housing_affordable_join")
def housing_affordable_join(spark, sf_dir):
    return H.join_housing_affordable(H.clean_housing(_h(spark, sf_dir)),
                                     H.clean_affordable(_a(spark, sf_dir)))


@register("units_reconciliation")
def units_reconciliation(spark, sf_dir):
    before = H.standardise_affordable_keys(_a(spark, sf_dir))
    return agg.units_reconciliation(before, agg.redistribute_missing(before))


@register("units_by_project")
def units_by_project(spark, sf_dir):
    """A5: units of lot-less buildings per project (NULL project left out)."""
    return agg.missing_key_sums(_a(spark, sf_dir), "Project_ID", "BBL", "All_Counted_Units")


@register("new_construction_only")
def new_construction_only(spark, sf_dir):
    """Buildings that are not preservation projects (unknown type kept)."""
    return rel.exclude_value(_a(spark, sf_dir), "Reporting_Construction_Type", "Preservation")


@register("join_bbl_year")
def join_bbl_year(spark, sf_dir):
    return H.join_by_lot_year(_h(spark, sf_dir), _a(spark, sf_dir))


@register("unmatched_housing")
def unmatched_housing(spark, sf_dir):
    return H.unmatched_jobs(_h(spark, sf_dir), _a(spark, sf_dir))


def _rollup_input(spark, sf_dir):
    return H.join_by_lot_year(H.standardise_job_keys(_h(spark, sf_dir)), _a(spark, sf_dir))


@register("units_rollup_5dim")
def units_rollup_5dim(spark, sf_dir):
    """5-key roll-up of the lot+year join, from per-key aggregates (no pairs built)."""
    return H.units_rollup_from_sources(_h(spark, sf_dir), _a(spark, sf_dir))


@register("units_rollup_join_form")
def units_rollup_join_form(spark, sf_dir):
    """C6 over the built C5 rows, as the source job does (cross-check)."""
    return H.units_rollup(_rollup_input(spark, sf_dir))


@register("units_rollup_total")
def units_rollup_total(spark, sf_dir):
    return H.units_rollup_totals(H.units_rollup_from_sources(_h(spark, sf_dir), _a(spark, sf_dir)))


@register("council_cross_join")
def council_cross_join(spark, sf_dir):
    return school.council_join_summary(_h(spark, sf_dir), _a(spark, sf_dir))


@register("school_bridge")
def school_bridge(spark, sf_dir):
    return school.school_bridge(_h(spark, sf_dir), standins.community_to_school(spark, sf_dir),
                                standins.school_capacity(spark, sf_dir))


@register("school_bridge_by_district")
def school_bridge_by_district(spark, sf_dir):
    """J4/J5 with one row per job: the schools of a district summed before the join."""
    return school.school_bridge_by_district(_h(spark, sf_dir), standins.community_to_school(spark, sf_dir),
                                            standins.school_capacity(spark, sf_dir))


@register("crosswalk_chain")
def crosswalk_chain(spark, sf_dir):
    """Sums over jobs x tract, council and school crosswalks x schools x buildings, as messages up a join tree."""
    return school.crosswalk_chain(
        _h(spark, sf_dir), _a(spark, sf_dir), standins.community_to_tract(spark, sf_dir),
        standins.community_to_council(spark, sf_dir), standins.community_to_school(spark, sf_dir),
        standins.school_capacity(spark, sf_dir))


@register("council_school_summary")
def council_school_summary(spark, sf_dir):
    """C11: the council join carried on to the schools, per (community, council)."""
    return school.council_school_summary(_h(spark, sf_dir), _a(spark, sf_dir), standins.community_to_school(spark, sf_dir),
                                         standins.school_capacity(spark, sf_dir))


@register("fill_unknown")
def fill_unknown(spark, sf_dir):
    """Every gap of the bridged table written as 'Unknown', in every column."""
    return rel.fill_labels(school_bridge_by_district(spark, sf_dir))


@register("join_quality_report")
def join_quality_report(spark, sf_dir):
    """Row counts, key gaps, unjoined jobs and unit totals of the lot+year join."""
    return H.join_quality_report(_h(spark, sf_dir), _a(spark, sf_dir))


@register("std_community_board")
def std_community_board(spark, sf_dir):
    raw = ingest.raw_keys(spark, sf_dir)
    a = _a(spark, sf_dir).select(F.col("community_district").alias("board_text"))
    both = raw.select("board_text").unionByName(a)
    return keys.with_community_board(both, "board_text", "community_district")


@register("std_council")
def std_council(spark, sf_dir):
    raw = ingest.raw_keys(spark, sf_dir)
    return raw.select("council_text",
                      keys.council_district("council_text", raw.schema["council_text"].dataType)
                      .alias("council_district"))


@register("std_school")
def std_school(spark, sf_dir):
    s = standins.community_to_school(spark, sf_dir)
    return s.select("BoroCD", "SchoolDist",
                    keys.school_district("SchoolDist", s.schema["SchoolDist"].dataType).alias("school_district"))


@register("std_tract")
def std_tract(spark, sf_dir):
    raw = ingest.raw_keys(spark, sf_dir)
    t = {f.name: f.dataType for f in raw.schema.fields}
    return raw.select("tract_number", "tract_text",
                      keys.census_tract("tract_number", t["tract_number"]).alias("tract_from_number"),
                      keys.census_tract("tract_text", t["tract_text"]).alias("tract_from_text"))


@register("year_strict")
def year_strict(spark, sf_dir):
    h, a = _h(spark, sf_dir), _a(spark, sf_dir)
    texts = h.select(F.col("CompltYear").alias("date_text")).unionByName(
        a.select(F.col("Project_Completion_Date").alias("date_text")))
    return texts.select("date_text", dates.strict_year("date_text").alias("year"))


@register("year_any")
def year_any(spark, sf_dir):
    h, a = _h(spark, sf_dir), _a(spark, sf_dir)
    texts = (h.select(F.col("CompltYear").alias("date_text"))
             .unionByName(h.select(F.col("PermitYear").alias("date_text")))
             .unionByName(a.select(F.col("Project_Completion_Date").alias("date_text"))))
    return texts.select("date_text", dates.any_year("date_text").alias("year"))


@register("int_key_text")
def int_key_text(spark, sf_dir):
    h = _h(spark, sf_dir)
    a = _a(spark, sf_dir)
    t = {f.name: f.dataType for f in h.schema.fields}
    left = h.select(F.lit("housing").alias("source"), F.col("Job_ID").alias("row_id"),
                    keys.int_key_text("CommntyDst", t["CommntyDst"]).alias("community_text"),
                    keys.int_key_text("CenTract20", t["CenTract20"]).alias("tract_text"),
                    keys.int_key("CouncilDst", t["CouncilDst"]).alias("council_int"))
    ta = {f.name: f.dataType for f in a.schema.fields}
    quarter = (F.col("All_Counted_Units") / 4)
    right = a.select(F.lit("affordable").alias("source"), F.col("Project_ID").alias("row_id"),
                     keys.int_key_text(quarter).alias("community_text"),
                     keys.int_key_text("census_tract", ta["census_tract"]).alias("tract_text"),
                     keys.int_key("BBL", ta["BBL"]).alias("council_int"))
    return left.unionByName(right)


@register("distinct_pairs")
def distinct_pairs(spark, sf_dir):
    """Distinct (community, council) pairs of the jobs table."""
    return rel.distinct_pairs(_h(spark, sf_dir), "CommntyDst", "CouncilDst")


@register("preview_head")
def preview_head(spark, sf_dir):
    """L1: the first 20 cleaned jobs by job id (a preview is the feature)."""
    return preview.head(H.clean_housing(_h(spark, sf_dir)), 20, order_by=["Job_ID"])


@register("preview_transposed")
def preview_transposed(spark, sf_dir):
    """L2: the first cleaned job as (column, value) rows."""
    return preview.first_row_transposed(H.clean_housing(_h(spark, sf_dir)), order_by=["Job_ID"])


@register("sample_rows")
def sample_rows(spark, sf_dir):
    """L3: a seeded sample of 10 jobs (a sample is the feature)."""
    return preview.seeded_sample(_h(spark, sf_dir), 10, key="Job_ID", seed=42)


@register("units_rollup_sorted")
def units_rollup_sorted(spark, sf_dir):
    """L4: the roll-up in key order."""
    return H.units_rollup_from_sources(_h(spark, sf_dir), _a(spark, sf_dir), order=True)


# ---- profiling -------------------------------------------------------------

def _jobs_without_id(spark, sf_dir):
    return _h(spark, sf_dir).drop("Job_ID")


@register("profile_columns")
def profile_columns(spark, sf_dir):
    """A18 (A8, A11, A12, A13, A14): one row per column of the jobs table."""
    return profile.profile_columns(_h(spark, sf_dir))


@register("profile_customer")
def profile_customer(spark, sf_dir):
    """A18 over a table without gaps (customer)."""
    return profile.profile_columns(read_table(spark, sf_dir, "customer"))


@register("profile_dataset_jobs")
def profile_dataset_jobs(spark, sf_dir):
    """Rows, duplicate rows (all copies), rows with a gap, columns of the jobs table."""
    return profile.dataset_checks(_h(spark, sf_dir))


@register("profile_dataset")
def profile_dataset(spark, sf_dir):
    """The same checks beside the id: jobs that differ in nothing but their number are duplicates."""
    return profile.dataset_checks(_jobs_without_id(spark, sf_dir))


@register("profile_incremental")
def profile_incremental(spark, sf_dir):
    """A9/A10/A15 over the order lines in three loads, each merged into the stored counts."""
    lines = read_table(spark, sf_dir, "lineitem")
    state = duplicates.DuplicateState(spark, lines.columns)
    part = F.pmod(F.xxhash64(*lines.columns), F.lit(3))
    for k in range(3):  # together all rows
        state.add(lines.where(part == k))
    return state.report()


@register("profile_dataset_lineitem")
def profile_dataset_lineitem(spark, sf_dir):
    """Dataset checks over the whole order-line table."""
    return profile.dataset_checks(read_table(spark, sf_dir, "lineitem"))


@register("null_counts")
def null_counts(spark, sf_dir):
    return profile.null_counts(_h(spark, sf_dir))


@register("zscore_outliers")
def zscore_outliers(spark, sf_dir):
    """A13 over every numeric column of the order-line table."""
    return profile.zscore_outliers(read_table(spark, sf_dir, "lineitem"))


@register("dates_inferred")
def dates_inferred(spark, sf_dir):
    """F9 in any layout: three text columns, the layout of each inferred from all its rows."""
    raw = messy.raw_dates(spark, sf_dir)
    found = layouts.infer(raw, ["us_text", "eu_text", "mixed_text"])
    return raw.select("o_orderkey", *[found[f"{c}_text"].date(f"{c}_text").alias(f"{c}_date") for c in ("us", "eu", "mixed")],
                      found["mixed_text"].year("mixed_text").alias("mixed_year"))


# ---- geometry and crosswalks ----------------------------------------------

@register("polygon_centroid")
def polygon_centroid(spark, sf_dir):
    """Area and area-weighted centroid of every area polygon."""
    return geo.centroids(ingest.area_layer(spark, sf_dir))


@register("crosswalk_within")
def crosswalk_within(spark, sf_dir):
    """Area -> zone by centroid within (left join, distinct pairs)."""
    return crosswalks.centroid_crosswalk(ingest.area_layer(spark, sf_dir), ingest.zone_layer(spark, sf_dir))


@register("crosswalk_intersects")
def crosswalk_intersects(spark, sf_dir):
    """Area -> zone for every touching or overlapping pair (left join)."""
    return crosswalks.intersects_crosswalk(ingest.area_layer(spark, sf_dir), ingest.zone_layer(spark, sf_dir))


def _districts(spark, sf_dir):
    return {name: ingest.district_layer(spark, sf_dir, name) for name in layers.DISTRICTS}


@register("crosswalk_within_tree")
def crosswalk_within_tree(spark, sf_dir):
    """C7/J8 by a packed R-tree instead of the grids."""
    return crosswalks.centroid_crosswalk(ingest.area_layer(spark, sf_dir), ingest.zone_layer(spark, sf_dir), index=geo.TREE)


@register("crosswalk_intersects_tree")
def crosswalk_intersects_tree(spark, sf_dir):
    """C8/J9 by packed R-trees over parts and edges instead of the grids."""
    return crosswalks.intersects_crosswalk(ingest.area_layer(spark, sf_dir), ingest.zone_layer(spark, sf_dir), index=geo.TREE)


@register("crosswalk_within_decimal")
def crosswalk_within_decimal(spark, sf_dir):
    """C7 on layers whose corners are no binary fractions."""
    d = _districts(spark, sf_dir)
    return crosswalks.centroid_crosswalk(d["community"], d["council"])


@register("crosswalk_set_within")
def crosswalk_set_within(spark, sf_dir):
    """The four centroid crosswalks of the four layers."""
    return crosswalks.centroid_crosswalks(_districts(spark, sf_dir))


@register("crosswalk_set_intersects")
def crosswalk_set_intersects(spark, sf_dir):
    """The six overlap crosswalks of the four layers."""
    return crosswalks.intersects_crosswalks(_districts(spark, sf_dir))


@register("crosswalk_standardize")
def crosswalk_standardize(spark, sf_dir):
    """Community->school and community->tract crosswalks, keys standardised."""
    school_xw = crosswalks.standardise_crosswalk(
        standins.community_to_school(spark, sf_dir),
        {"BoroCD": "community_district", "SchoolDist": "school_district"})
    tract_xw = crosswalks.standardise_crosswalk(
        standins.community_to_tract(spark, sf_dir),
        {"BoroCD": "community_district", "CT2020": "census_tract"})
    return school_xw.join(tract_xw, "community_district", "full")


# ---- sources and sinks -----------------------------------------------------

def _scratch(spark, name: str) -> str:
    return scratch_path(spark, "runs", f"{name}-{uuid.uuid4().hex[:12]}")


@register("geojson_roundtrip")
def geojson_roundtrip(spark, sf_dir):
    """Both layers written as GeoJSON, the folder read back as vertices with an attribute."""
    folder = _scratch(spark, "geojson")
    geojson.write_layers({"areas": ingest.area_layer(spark, sf_dir),
                          "zones": ingest.zone_layer(spark, sf_dir)}, folder)
    return geojson.vertices(geojson.read_layers(spark, f"{folder}/*.geojson").withColumn(
        "name", F.col("properties")["name"]), ["name"])


@register("csv_roundtrip")
def csv_roundtrip(spark, sf_dir):
    """The jobs table written as header CSV and read back with its schema."""
    jobs = _h(spark, sf_dir)
    path = tables.write_csv(jobs, _scratch(spark, "jobs-csv"))
    return tables.read_csv(spark, path, jobs.schema)


@register("table_replace")
def table_replace(spark, sf_dir):
    """A table path loaded once, then replaced by the cleaned buildings table."""
    path = _scratch(spark, "table")
    tables.replace_table(_h(spark, sf_dir), path)
    tables.replace_table(H.clean_affordable(_a(spark, sf_dir)), path)
    return tables.read_replaced(spark, path)


@register("housing_job")
def housing_job(spark, sf_dir):
    """The whole job, each stage written as a table and read back by the next."""
    return H.run_housing_job(_h(spark, sf_dir), _a(spark, sf_dir), out_dir=_scratch(spark, "job"))


# ---- C9: fact tables standardised ------------------------------------------

@register("std_fact_housing")
def std_fact_housing(spark, sf_dir):
    return crosswalks.standardise_fact_table(_h(spark, sf_dir), "housing")


@register("std_fact_affordable")
def std_fact_affordable(spark, sf_dir):
    """The buildings table in its CSV spelling (spaces in names become underscores)."""
    a = _a(spark, sf_dir).withColumnsRenamed({"community_district": "Community_Board",
                                              "council_district": "Council_District",
                                              "census_tract": "Census_Tract"})
    return crosswalks.standardise_fact_table(a, "affordable")


@register("std_fact_school")
def std_fact_school(spark, sf_dir):
    return crosswalks.standardise_fact_table(standins.school_capacity(spark, sf_dir), "school")


@register("std_fact_transit")
def std_fact_transit(spark, sf_dir):
    return crosswalks.standardise_fact_table(standins.transit_access(spark, sf_dir), "transit")
