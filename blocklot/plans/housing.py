"""Housing jobs x affordable buildings: cleaning, joins, roll-ups, metrics.

C1 ``clean_housing``        drop jobs without community/council, key text, years
C2 ``clean_affordable``     key text, years, units of lot-less buildings moved
C3 ``join_housing_affordable``  left join on community, council, lot
C4 ``housing_metrics``      rows, housing units, affordable units of C3
C5 ``join_by_lot_year``     new-construction buildings joined on lot + year
C6 ``units_rollup``         5-key group sums of the C5 join (+ grand totals)
C13 ``run_housing_job``     C1, C2 -> C3 -> C4, optionally writing each table
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates, keys
from ..operators import aggregates as agg
from ..operators import relational as rel
from ..operators.skew import HOT_KEY_ROWS, salted_join
from ..sources.tables import read_replaced, replace_table

JOIN_KEYS = ["community_district", "council_district", "BBL"]


def clean_housing(housing: DataFrame) -> DataFrame:
    """Jobs with a community and council district, keys as integer text."""
    t = {f.name: f.dataType for f in housing.schema.fields}
    h = rel.drop_null_keys(housing, ["CommntyDst", "CouncilDst"])
    return h.withColumns({
        "community_district": keys.int_key_text("CommntyDst", t["CommntyDst"]),
        "council_district": keys.int_key_text("CouncilDst", t["CouncilDst"]),
        "census_tract": keys.int_key_text("CenTract20", t["CenTract20"]),
        "year_of_completion": dates.strict_year("CompltYear"),
        "permit_year": dates.any_year("PermitYear", t["PermitYear"]),
    })


def standardise_affordable_keys(affordable: DataFrame) -> DataFrame:
    """Key formats of the affordable table (before redistribution)."""
    t = {f.name: f.dataType for f in affordable.schema.fields}
    staged = keys.with_community_board(affordable, "community_district")
    return staged.withColumns({
        "BBL": keys.int_key("BBL", t["BBL"]),
        "community_district": F.col("community_district").cast("string"),
        "council_district": keys.int_key_text("council_district", t["council_district"]),
        "census_tract": keys.int_key_text("census_tract", t["census_tract"]),
        "year_of_completion": dates.strict_year("Project_Completion_Date"),
    })


def clean_affordable(affordable: DataFrame) -> DataFrame:
    """Standardised keys, then units of lot-less buildings redistributed."""
    return agg.redistribute_missing(standardise_affordable_keys(affordable))


def join_housing_affordable(housing_clean: DataFrame, affordable_clean: DataFrame) -> DataFrame:
    """Every job with each matching building (many-to-many kept).

    Keys compare null-safe, as in the source join (a missing key meets a
    missing key). It also keeps the optimizer from deriving not-null filters
    on the building side and pushing the whole key standardisation into them.
    """
    return rel.key_join(housing_clean, affordable_clean, JOIN_KEYS, how="left", null_safe=True,
                        skew_rows=HOT_KEY_ROWS)


def housing_metrics_from_join(joined: DataFrame) -> DataFrame:
    """C4 over a materialised C3 table: one aggregate, three totals."""
    done = F.col("CompltYear").isNotNull()
    return joined.agg(
        F.count(F.lit(1)).alias("total_rows"),
        agg.zero_sum(F.when(done, F.col("ClassANet"))).alias("housing_units"),
        agg.zero_sum(F.when(done, F.col("All_Counted_Units"))).alias("affordable_units"),
    )


def housing_metrics(housing_clean: DataFrame, affordable_clean: DataFrame) -> DataFrame:
    """C4 without building the C3 pairs.

    Equal to ``housing_metrics_from_join(join_housing_affordable(h, a))``:
    each side is first reduced to one row per join key (partial aggregation,
    so a hot key is combined map-side), then the two key tables are joined.
    A job with ``m`` partner buildings stands for ``max(m, 1)`` joined rows;
    the affordable units of a key count once per completed job.
    """
    done = F.col("CompltYear").isNotNull()
    h = (housing_clean.groupBy(*JOIN_KEYS)
         .agg(F.count(F.lit(1)).alias("h_rows"),
              F.count_if(done).alias("h_done"),
              agg.zero_sum(F.when(done, F.col("ClassANet"))).alias("h_units")))
    a = (affordable_clean.groupBy(*JOIN_KEYS)
         .agg(F.count(F.lit(1)).alias("a_rows"),
              agg.zero_sum("All_Counted_Units").alias("a_units")))
    on = [h[k].eqNullSafe(a[k]) for k in JOIN_KEYS]
    joined = h.join(a, on[0] & on[1] & on[2], how="left").select(
        "h_rows", "h_done", "h_units", "a_rows", "a_units")
    fan = F.greatest(F.coalesce(F.col("a_rows"), F.lit(0)), F.lit(1))
    return joined.agg(
        F.coalesce(F.sum(F.col("h_rows") * fan), F.lit(0)).alias("total_rows"),
        agg.zero_sum(F.col("h_units") * fan).alias("housing_units"),
        agg.zero_sum(F.col("h_done") * F.coalesce(F.col("a_units"), F.lit(0.0))).alias("affordable_units"),
    )


def _new_construction(affordable: DataFrame) -> DataFrame:
    """No preservation projects; a completion date, a year, an integer lot."""
    t = {f.name: f.dataType for f in affordable.schema.fields}
    a = rel.exclude_value(affordable, "Reporting_Construction_Type", "Preservation")
    a = rel.drop_null_keys(a, ["Project_Completion_Date"])
    return a.withColumns({
        "year_of_completion": dates.any_year("Project_Completion_Date"),
        "BBL": keys.int_key("BBL", t["BBL"]),
    })


def prepare_new_construction(affordable: DataFrame) -> DataFrame:
    """C5 affordable side: new construction, units of lot-less buildings redistributed."""
    return agg.redistribute_missing(_new_construction(affordable))


def prepare_completed_jobs(housing: DataFrame) -> DataFrame:
    """C5 housing side: completed jobs with a year and an integer lot."""
    t = {f.name: f.dataType for f in housing.schema.fields}
    h = rel.drop_null_keys(housing, ["CompltYear"])
    return h.withColumns({
        "year_of_completion": dates.any_year("CompltYear"),
        "BBL": keys.int_key("BBL", t["BBL"]),
    })


def join_by_lot_year(housing: DataFrame, affordable: DataFrame) -> DataFrame:
    """Completed jobs left-joined to new-construction buildings on (lot, year).

    Keys are compared null-safe (a job without a lot meets buildings without
    one). Shared non-key columns get ``_x``/``_y``; community and council
    keep the job's plain names.
    """
    h = prepare_completed_jobs(housing)
    a = prepare_new_construction(affordable)
    rel.check_key_types(h, a, ["BBL", "year_of_completion"], ["BBL", "year_of_completion"])
    joined = rel.key_join(h, a, ["BBL", "year_of_completion"], how="left", null_safe=True,
                          skew_rows=HOT_KEY_ROWS)
    return rel.rename_columns(joined, {"community_district_x": "community_district",
                                       "council_district_x": "council_district"})


def unmatched_jobs(housing: DataFrame, affordable: DataFrame) -> DataFrame:
    """Completed jobs with no building on the same (lot, year).

    Only the buildings' (lot, year) pairs matter, so nothing is redistributed:
    redistribution changes units, and drops the buildings without a lot.
    """
    h = prepare_completed_jobs(housing)
    built = rel.drop_null_keys(_new_construction(affordable), ["BBL"]).select("BBL", "year_of_completion").distinct()
    return rel.unmatched_rows(h, built, ["BBL", "year_of_completion"], null_safe=True, skew_rows=HOT_KEY_ROWS)


def join_quality_report(housing: DataFrame, affordable: DataFrame) -> DataFrame:
    """C5's counts: rows before and after each step, gaps in the keys, unjoined jobs, unit totals.

    One aggregate per side and the anti join of J7; the joined rows are not
    built. A joined row without a partner is a job without one: every building
    that is left has a completion date, a column that jobs do not have (P12).
    """
    h, a = prepare_completed_jobs(housing), _new_construction(affordable)
    no_lot, no_year = F.col("BBL").isNull(), F.col("year_of_completion").isNull()
    jobs = h.agg(
        F.count(F.lit(1)).alias("housing_rows_completed"), F.count_if(no_lot).alias("housing_missing_lot"),
        F.count_if(no_year).alias("housing_missing_year"), agg.zero_sum("ClassANet").alias("housing_units"))
    spread = agg.redistribute_missing(a)
    built = a.agg(F.count(F.lit(1)).alias("affordable_rows_new"), F.count_if(no_lot).alias("affordable_missing_lot"))
    left = spread.agg(F.count(F.lit(1)).alias("affordable_rows_left"), F.count_if(no_year).alias("affordable_missing_year"),
                      agg.zero_sum("All_Counted_Units").alias("affordable_units"))
    raw_h = housing.agg(F.count(F.lit(1)).alias("housing_rows"))
    raw_a = affordable.agg(F.count(F.lit(1)).alias("affordable_rows"))
    alone = unmatched_jobs(housing, affordable).agg(F.count(F.lit(1)).alias("unjoined_rows"))
    rows = raw_h
    for one in (raw_a, jobs, built, left, alone):
        rows = rows.unionByName(one, allowMissingColumns=True)
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns])  # one row of each, side by side


def rows_without_partner(joined: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of a built left join whose columns from ``right`` alone are all NULL (P12 names them)."""
    gap = None
    for c in rel.columns_not_in(right, left):
        term = F.col(c).isNull()
        gap = term if gap is None else gap & term
    return joined.where(gap) if gap is not None else joined.limit(0)


ROLLUP_KEYS = ["community_district", "council_district", "year_of_completion", "ZoningDst1", "FloorsProp"]
ROLLUP_SUMS = {"ClassANet_sum": "ClassANet", "AllCountedUnits_sum": "All_Counted_Units"}


def standardise_job_keys(housing: DataFrame) -> DataFrame:
    """C9 on jobs: rename raw key columns and apply the standardisers."""
    h = rel.rename_columns(housing, {"CommntyDst": "community_district", "CouncilDst": "council_district",
                                     "CenTract20": "census_tract"})
    t = {f.name: f.dataType for f in h.schema.fields}
    h = keys.with_community_board(h, "community_district")
    return h.withColumns({
        "council_district": keys.council_district("council_district", t["council_district"]),
        "census_tract": keys.census_tract("census_tract", t["census_tract"]),
    })


def units_rollup(merged: DataFrame, order: bool = False) -> DataFrame:
    """Group sums by five keys; rows with a NULL key are left out."""
    return agg.group_sums(merged, ROLLUP_KEYS, ROLLUP_SUMS, order=order)


def units_rollup_from_sources(housing: DataFrame, affordable: DataFrame, order: bool = False) -> DataFrame:
    """C6 over the C5 join, without building the job x building pairs.

    The buildings are reduced to one row per (lot, year) with their count
    ``m`` and units ``U``, the jobs to one row per (lot, roll-up keys) with
    their count ``j`` and ``ClassANet`` sum. The two meet in a many-to-one
    join: such a row stands for ``max(m, 1)`` joined rows per job, and ``j U``
    units. Both reductions combine map-side before their shuffle. Equal to
    ``units_rollup(join_by_lot_year(standardise_job_keys(housing), affordable))``.
    """
    jobs = prepare_completed_jobs(standardise_job_keys(housing)).select(
        "BBL", "year_of_completion", *[k for k in ROLLUP_KEYS if k != "year_of_completion"], "ClassANet")
    jobs = rel.drop_null_keys(jobs, ROLLUP_KEYS).groupBy("BBL", *ROLLUP_KEYS).agg(
        F.count(F.lit(1)).alias("__j"), agg.zero_sum("ClassANet").alias("ClassANet"))
    per_key = prepare_new_construction(affordable).groupBy("BBL", "year_of_completion").agg(
        F.count(F.lit(1)).alias("__m"), agg.zero_sum("All_Counted_Units").alias("__u"))
    met = salted_join(jobs, per_key, ["BBL", "year_of_completion"], how="left", null_safe=True, other_unique=True)
    fan = F.greatest(F.coalesce(F.col("__m"), F.lit(0)), F.lit(1))
    out = met.groupBy(*ROLLUP_KEYS).agg(
        agg.zero_sum(F.col("ClassANet") * fan).alias("ClassANet_sum"),
        agg.zero_sum(F.col("__j") * F.col("__u")).alias("AllCountedUnits_sum"))
    return out.orderBy(*ROLLUP_KEYS) if order else out


def units_rollup_totals(rollup: DataFrame) -> DataFrame:
    """Grand totals of the roll-up table."""
    return agg.grand_totals(rollup, list(ROLLUP_SUMS))


def run_housing_job(housing: DataFrame, affordable: DataFrame, out_dir: str | None = None) -> DataFrame:
    """C1 and C2, then C3, then the C4 metrics row.

    With ``out_dir`` each stage is written as a replaced table and the next
    stage reads the written copy (lineage is cut at each step, so a lost
    executor only repeats the current stage).
    """
    h, a = clean_housing(housing), clean_affordable(affordable)
    if out_dir is None:
        return housing_metrics(h, a)
    spark = housing.sparkSession
    h = read_replaced(spark, replace_table(h, f"{out_dir}/housing_processed"))
    a = read_replaced(spark, replace_table(a, f"{out_dir}/affordable_processed"))
    j = read_replaced(spark, replace_table(join_housing_affordable(h, a), f"{out_dir}/housing_main"))
    return housing_metrics_from_join(j)
