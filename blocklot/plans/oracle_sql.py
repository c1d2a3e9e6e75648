"""DuckDB SQL for each registered query, over the driver's pre-registered views.

Written independently of the Spark code (plain SQL on the same tables), so
the comparison checks the semantics and not a shared implementation.
Column names and types match the Spark output.
"""

from __future__ import annotations

from ..sources.layers import DISTRICTS

HOUSING_FX = """
housing_fx AS (
 SELECT o_orderkey AS Job_ID,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST((1 + (o_custkey + CASE WHEN o_orderkey % 19 = 0 THEN 1 ELSE 0 END) % 5) * 100 + 1 + o_custkey % 12 AS DOUBLE) END AS CommntyDst,
  CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE CAST(1 + o_custkey % 51 AS DOUBLE) END AS CouncilDst,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(100 * (1 + o_custkey % 900) AS DOUBLE) END AS CenTract20,
  CASE WHEN o_orderkey % 29 = 0 THEN NULL ELSE 1000000000 + o_custkey + CASE WHEN o_orderkey % 4 = 0 THEN 500000 ELSE 0 END END AS BBL,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL
       WHEN o_orderkey % 3 = 1 THEN CAST(month(o_orderdate) AS VARCHAR) || '/' || CAST(day(o_orderdate) AS VARCHAR) || '/' || CAST(year(o_orderdate) AS VARCHAR)
       ELSE CAST(year(o_orderdate) AS VARCHAR) END AS CompltYear,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(year(o_orderdate) AS VARCHAR) END AS PermitYear,
  CAST(1 + o_orderkey % 40 AS DOUBLE) AS ClassANet,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderpriority END AS ZoningDst1,
  CAST(1 + o_orderkey % 9 AS DOUBLE) AS FloorsProp
 FROM orders)"""

AFFORDABLE_FX = """
affordable_fx AS (
 SELECT CASE WHEN l_orderkey % 31 = 0 THEN NULL ELSE l_orderkey % 5000 END AS Project_ID,
  CASE WHEN (l_orderkey + l_linenumber) % 5 = 0 THEN NULL ELSE CAST(1000000000 + l_partkey % 1500 AS DOUBLE) END AS BBL,
  CASE (l_partkey % 1500) % 5 WHEN 0 THEN 'MN' WHEN 1 THEN ' bx ' WHEN 2 THEN 'BK' WHEN 3 THEN 'Qn' ELSE 'SI' END
    || '-' || lpad(CAST(1 + (l_partkey % 1500) % 12 AS VARCHAR), 2, '0') AS community_district,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE CAST(1 + (l_partkey % 1500) % 51 AS DOUBLE) END AS council_district,
  CASE WHEN l_linenumber = 6 THEN NULL ELSE CAST(100 * (1 + (l_partkey % 1500) % 900) AS DOUBLE) END AS census_tract,
  CASE WHEN l_linenumber = 5 THEN NULL ELSE lpad(CAST(month(l_shipdate) AS VARCHAR), 2, '0') || '/' || lpad(CAST(day(l_shipdate) AS VARCHAR), 2, '0') || '/' || CAST(year(l_shipdate) AS VARCHAR) END AS Project_Completion_Date,
  CASE l_returnflag WHEN 'A' THEN 'Preservation' WHEN 'N' THEN 'New Construction' ELSE NULL END AS Reporting_Construction_Type,
  l_quantity AS All_Counted_Units
 FROM lineitem)"""

# Integer text of a float key, NULL when it has a fraction.
def _int_text(c: str) -> str:
    return f"CASE WHEN {c} = floor({c}) THEN CAST(CAST({c} AS BIGINT) AS VARCHAR) END"


def _int(c: str) -> str:
    return f"CASE WHEN {c} = floor({c}) THEN CAST({c} AS BIGINT) END"


def _strict_year(c: str) -> str:
    return (f"CASE WHEN regexp_full_match({c}, '[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}') "
            f"THEN CAST(year(try_strptime({c}, '%m/%d/%Y')) AS BIGINT) END")


def _any_year(c: str) -> str:
    return (f"CASE WHEN regexp_full_match(trim({c}), '[0-9]{{4}}') THEN CAST(trim({c}) AS BIGINT) "
            f"WHEN regexp_full_match(trim({c}), '[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}') "
            f"THEN CAST(year(try_strptime(trim({c}), '%m/%d/%Y')) AS BIGINT) "
            f"WHEN regexp_full_match(trim({c}), '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}') "
            f"THEN CAST(year(try_strptime(trim({c}), '%Y-%m-%d')) AS BIGINT) END")


# Python-style strip of whitespace.
def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


NUMBER_RE = "[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?"


def _trunc_text(c: str) -> str:
    s = _strip(c)
    return (f"CASE WHEN regexp_full_match({s}, '{NUMBER_RE}') "
            f"THEN CAST(trunc(CAST({s} AS DOUBLE)) AS BIGINT) END")


def _board(c: str) -> str:
    s = _strip(c)
    prefix = f"upper({_strip(f'split_part({s}, ' + chr(39) + '-' + chr(39) + ', 1)')})"
    rest = _strip(f"substr({s}, strpos({s}, '-') + 1)")
    digit = f"(CASE {prefix} WHEN 'MN' THEN 1 WHEN 'BX' THEN 2 WHEN 'BK' THEN 3 WHEN 'QN' THEN 4 WHEN 'SI' THEN 5 END)"
    n = f"TRY_CAST({rest} AS BIGINT)"
    width = f"greatest(2, length(CAST({n} AS VARCHAR)))"
    coded = f"{digit} * CAST(pow(10, {width}) AS BIGINT) + {n}"
    return (f"CASE WHEN {c} IS NULL THEN NULL "
            f"WHEN strpos({s}, '-') = 0 THEN {_trunc_text(c)} "
            f"WHEN regexp_full_match({rest}, '[+-]?[0-9]+') AND {n} >= 0 THEN {coded} END")


def _tract_from_text(s: str) -> str:
    tail = f"(CASE WHEN length({s}) > 6 THEN right({s}, 6) ELSE {s} END)"
    return (f"CASE WHEN {s} IS NULL THEN NULL WHEN length({tail}) >= 6 THEN {tail} "
            f"WHEN {tail} LIKE '-%' OR {tail} LIKE '+%' THEN left({tail}, 1) || lpad(substr({tail}, 2), 5, '0') "
            f"ELSE lpad({tail}, 6, '0') END")


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


HOUSING_CLEAN = f"""
housing_clean AS (
 SELECT *, {_int_text('CommntyDst')} AS community_district, {_int_text('CouncilDst')} AS council_district,
  {_int_text('CenTract20')} AS census_tract, {_strict_year('CompltYear')} AS year_of_completion,
  {_any_year('PermitYear')} AS permit_year
 FROM housing_fx WHERE CommntyDst IS NOT NULL AND CouncilDst IS NOT NULL)"""

AFFORDABLE_STD = f"""
affordable_std AS (
 SELECT Project_ID, {_int('BBL')} AS BBL, CAST({_board('community_district')} AS VARCHAR) AS community_district,
  {_int_text('council_district')} AS council_district, {_int_text('census_tract')} AS census_tract,
  Project_Completion_Date, Reporting_Construction_Type, All_Counted_Units,
  {_strict_year('Project_Completion_Date')} AS year_of_completion
 FROM affordable_fx)"""

AFFORDABLE_CLEAN = """
missing AS (
 SELECT Project_ID, coalesce(sum(All_Counted_Units), 0) AS missing_units
 FROM affordable_std WHERE BBL IS NULL AND Project_ID IS NOT NULL GROUP BY Project_ID),
affordable_clean AS (
 SELECT a.Project_ID, a.BBL, a.community_district, a.council_district, a.census_tract,
  a.Project_Completion_Date, a.Reporting_Construction_Type,
  a.All_Counted_Units + coalesce(m.missing_units, 0) AS All_Counted_Units, a.year_of_completion
 FROM affordable_std a LEFT JOIN missing m ON a.Project_ID = m.Project_ID
 WHERE a.BBL IS NOT NULL)"""

JOINED = """
joined AS (
 SELECT h.Job_ID, h.CommntyDst, h.CouncilDst, h.CenTract20, h.BBL, h.CompltYear, h.PermitYear, h.ClassANet,
  h.ZoningDst1, h.FloorsProp, h.community_district, h.council_district, h.census_tract AS census_tract_x,
  h.year_of_completion AS year_of_completion_x, h.permit_year,
  a.Project_ID, a.census_tract AS census_tract_y, a.Project_Completion_Date, a.Reporting_Construction_Type,
  a.All_Counted_Units, a.year_of_completion AS year_of_completion_y
 FROM housing_clean h LEFT JOIN affordable_clean a
  ON h.community_district = a.community_district AND h.council_district = a.council_district AND h.BBL = a.BBL)"""

METRICS = """
SELECT count(*) AS total_rows,
 coalesce(sum(CASE WHEN CompltYear IS NOT NULL THEN ClassANet END), 0) AS housing_units,
 coalesce(sum(CASE WHEN CompltYear IS NOT NULL THEN All_Counted_Units END), 0) AS affordable_units
FROM joined"""

BASE = _with(HOUSING_FX, AFFORDABLE_FX)
CLEAN = _with(HOUSING_FX, AFFORDABLE_FX, HOUSING_CLEAN, AFFORDABLE_STD, AFFORDABLE_CLEAN)
CLEAN_JOINED = _with(HOUSING_FX, AFFORDABLE_FX, HOUSING_CLEAN, AFFORDABLE_STD, AFFORDABLE_CLEAN, JOINED)

# C5 sides: completed jobs; new-construction buildings with units redistributed.
NEW_CONSTRUCTION = f"""
nc AS (
 SELECT Project_ID, {_int('BBL')} AS BBL, community_district, council_district, census_tract,
  Project_Completion_Date, Reporting_Construction_Type, All_Counted_Units,
  {_any_year('Project_Completion_Date')} AS year_of_completion
 FROM affordable_fx
 WHERE Reporting_Construction_Type IS DISTINCT FROM 'Preservation' AND Project_Completion_Date IS NOT NULL),
nc_missing AS (
 SELECT Project_ID, coalesce(sum(All_Counted_Units), 0) AS missing_units
 FROM nc WHERE BBL IS NULL AND Project_ID IS NOT NULL GROUP BY Project_ID),
nc_kept AS (
 SELECT n.Project_ID, n.BBL, n.community_district, n.council_district, n.census_tract,
  n.Project_Completion_Date, n.Reporting_Construction_Type,
  n.All_Counted_Units + coalesce(m.missing_units, 0) AS All_Counted_Units, n.year_of_completion
 FROM nc n LEFT JOIN nc_missing m ON n.Project_ID = m.Project_ID WHERE n.BBL IS NOT NULL)"""

COMPLETED_JOBS = f"""
jobs AS (
 SELECT *, {_any_year('CompltYear')} AS year_of_completion FROM housing_fx WHERE CompltYear IS NOT NULL)"""

LOT_YEAR = COMPLETED_JOBS + "," + NEW_CONSTRUCTION

JOB_STD = f"""
jobs_std AS (
 SELECT Job_ID, CAST(trunc(CommntyDst) AS BIGINT) AS community_district,
  CAST(trunc(CouncilDst) AS BIGINT) AS council_district,
  {_tract_from_text("CAST(CAST(trunc(CenTract20) AS BIGINT) AS VARCHAR)")} AS census_tract,
  BBL, CompltYear, PermitYear, ClassANet, ZoningDst1, FloorsProp
 FROM housing_fx),
jobs AS (
 SELECT *, {_any_year('CompltYear')} AS year_of_completion FROM jobs_std WHERE CompltYear IS NOT NULL)"""


def _rollup_sql(tail: str) -> str:
    return _with(HOUSING_FX, AFFORDABLE_FX, JOB_STD, NEW_CONSTRUCTION) + """,
merged AS (
 SELECT j.community_district, j.council_district, j.year_of_completion, j.ZoningDst1, j.FloorsProp,
  j.ClassANet, k.All_Counted_Units
 FROM jobs j LEFT JOIN nc_kept k ON j.BBL IS NOT DISTINCT FROM k.BBL
  AND j.year_of_completion IS NOT DISTINCT FROM k.year_of_completion),
rollup AS (
 SELECT community_district, council_district, year_of_completion, ZoningDst1, FloorsProp,
  coalesce(sum(ClassANet), 0) AS ClassANet_sum, coalesce(sum(All_Counted_Units), 0) AS AllCountedUnits_sum
 FROM merged
 WHERE community_district IS NOT NULL AND council_district IS NOT NULL AND year_of_completion IS NOT NULL
  AND ZoningDst1 IS NOT NULL AND FloorsProp IS NOT NULL
 GROUP BY ALL)
""" + tail


MESSY = """
messy AS (
 SELECT l_orderkey AS line_order, l_linenumber AS line_no,
  (l_partkey % 1500) AS lot,
  1 + (l_partkey % 1500) % 5 AS boro, 1 + (l_partkey % 1500) % 12 AS dist,
  CASE (l_partkey % 1500) % 5 WHEN 0 THEN 'MN' WHEN 1 THEN ' bx ' WHEN 2 THEN 'BK' WHEN 3 THEN 'Qn' ELSE 'SI' END AS spelling,
  l_quantity
 FROM lineitem),
raw_keys AS (
 SELECT line_order, line_no,
  CASE line_no WHEN 1 THEN spelling || '-' || lpad(CAST(dist AS VARCHAR), 2, '0')
   WHEN 2 THEN lower(spelling) || ' - ' || CAST(dist AS VARCHAR)
   WHEN 3 THEN CAST(CAST(boro * 100 + dist AS DOUBLE) AS VARCHAR)
   WHEN 4 THEN 'XX-' || CAST(dist AS VARCHAR)
   WHEN 5 THEN spelling || '-x' || CAST(dist AS VARCHAR)
   WHEN 6 THEN spelling || '--' || CAST(dist AS VARCHAR)
   ELSE '-' || CAST(boro * 100 + dist AS VARCHAR) END AS board_text,
  CASE WHEN line_no <= 2 THEN CAST(CAST(1 + lot % 51 AS DOUBLE) AS VARCHAR)
   WHEN line_no = 3 THEN ' ' || CAST(1 + lot % 51 AS VARCHAR) || ' '
   WHEN line_no = 4 THEN CAST(l_quantity / 4 AS VARCHAR)
   WHEN line_no = 5 THEN 'x'
   WHEN line_no = 6 THEN NULL
   ELSE CAST(1 + lot % 51 AS VARCHAR) || 'e0' END AS council_text,
  CASE WHEN line_no = 6 THEN NULL
   WHEN line_no = 7 THEN CAST(36061000000 + 100 * (1 + lot % 900) AS DOUBLE)
   ELSE CAST(100 * (1 + lot % 900) + line_no % 3 AS DOUBLE) END AS tract_number,
  CASE WHEN line_no <= 2 THEN lpad(CAST(100 * (1 + lot % 900) AS VARCHAR), 6, '0')
   WHEN line_no = 3 THEN ' ' || CAST(1 + lot % 900 AS VARCHAR) || ' '
   WHEN line_no = 4 THEN CAST(36061000000 + 100 * (1 + lot % 900) AS VARCHAR)
   WHEN line_no = 5 THEN CAST(CAST(100 * (1 + lot % 900) AS DOUBLE) AS VARCHAR)
   WHEN line_no = 6 THEN NULL
   ELSE '-' || CAST(lot % 97 AS VARCHAR) END AS tract_text
 FROM messy)"""

SCHOOL_XW = """
xw AS (
 SELECT BoroCD, CASE WHEN BoroCD % 13 = 0 THEN NULL ELSE CAST(1 + (BoroCD * 7) % 32 AS DOUBLE) END AS SchoolDist
 FROM (SELECT DISTINCT (1 + c_custkey % 5) * 100 + 1 + c_custkey % 12 AS BoroCD FROM customer)),
schools AS (
 SELECT s_suppkey AS School_ID, 1 + s_suppkey % 32 AS Geo_Dist, 500 + (s_suppkey * 37) % 700 AS Org_Target_Cap,
  400 + (s_suppkey * 53) % 800 AS Org_Enroll,
  (500 + (s_suppkey * 37) % 700) - (400 + (s_suppkey * 53) % 800) AS SchoolCapacity
 FROM supplier),
bridge AS (
 SELECT h.*, x.BoroCD, x.SchoolDist, s.School_ID, s.Geo_Dist, s.Org_Target_Cap, s.Org_Enroll, s.SchoolCapacity
 FROM housing_fx h LEFT JOIN xw x ON h.CommntyDst = x.BoroCD LEFT JOIN schools s ON x.SchoolDist = s.Geo_Dist)"""

ORACLE_SQL: dict[str, str] = {
    "housing_metrics": CLEAN_JOINED + METRICS,
    "housing_metrics_join_form": CLEAN_JOINED + METRICS,
    "housing_clean": _with(HOUSING_FX, HOUSING_CLEAN) + "SELECT * FROM housing_clean",
    "affordable_clean": CLEAN + "SELECT * FROM affordable_clean",
    "housing_affordable_join": CLEAN_JOINED + "SELECT * FROM joined",
    "units_reconciliation": CLEAN + """
SELECT (SELECT count(*) FROM affordable_std) AS rows_before,
 (SELECT coalesce(sum(All_Counted_Units), 0) FROM affordable_std) AS units_before,
 (SELECT count(*) FROM affordable_std WHERE BBL IS NOT NULL) AS rows_with_lot_before,
 (SELECT coalesce(sum(All_Counted_Units), 0) FROM affordable_std WHERE BBL IS NOT NULL) AS units_with_lot_before,
 (SELECT count(*) FROM affordable_clean) AS rows_after,
 (SELECT coalesce(sum(All_Counted_Units), 0) FROM affordable_clean) AS units_after""",
    "units_by_project": BASE + """
SELECT Project_ID, coalesce(sum(All_Counted_Units), 0) AS missing_units
FROM affordable_fx WHERE BBL IS NULL AND Project_ID IS NOT NULL GROUP BY Project_ID""",
    "new_construction_only": BASE + """
SELECT * FROM affordable_fx WHERE Reporting_Construction_Type IS DISTINCT FROM 'Preservation'""",
    "join_bbl_year": BASE + "," + LOT_YEAR.lstrip() + """
SELECT j.Job_ID, j.CommntyDst, j.CouncilDst, j.CenTract20, j.BBL, j.CompltYear, j.PermitYear, j.ClassANet,
 j.ZoningDst1, j.FloorsProp, j.year_of_completion,
 k.Project_ID, k.community_district, k.council_district, k.census_tract, k.Project_Completion_Date,
 k.Reporting_Construction_Type, k.All_Counted_Units
FROM jobs j LEFT JOIN nc_kept k ON j.BBL IS NOT DISTINCT FROM k.BBL
 AND j.year_of_completion IS NOT DISTINCT FROM k.year_of_completion""",
    "unmatched_housing": BASE + "," + LOT_YEAR.lstrip() + """
SELECT j.* FROM jobs j WHERE NOT EXISTS (
 SELECT 1 FROM nc_kept k WHERE j.BBL IS NOT DISTINCT FROM k.BBL
  AND j.year_of_completion IS NOT DISTINCT FROM k.year_of_completion)""",
    "units_rollup_5dim": _rollup_sql("SELECT * FROM rollup"),
    "units_rollup_sorted": _rollup_sql("SELECT * FROM rollup"),
    "units_rollup_join_form": _rollup_sql("SELECT * FROM rollup"),
    "units_rollup_total": _rollup_sql(
        "SELECT coalesce(sum(ClassANet_sum), 0) AS ClassANet_sum, "
        "coalesce(sum(AllCountedUnits_sum), 0) AS AllCountedUnits_sum FROM rollup"),
    "school_bridge": BASE + "," + SCHOOL_XW.lstrip() + "\nSELECT * FROM bridge",
    "std_community_board": BASE + "," + MESSY.lstrip() + f"""
SELECT board_text, {_board('board_text')} AS community_district
FROM (SELECT board_text FROM raw_keys UNION ALL SELECT community_district FROM affordable_fx)""",
    "std_council": _with(MESSY) + f"""
SELECT council_text, {_trunc_text('council_text')} AS council_district FROM raw_keys""",
    "std_school": """
SELECT BoroCD, SchoolDist, CAST(trunc(SchoolDist) AS BIGINT) AS school_district
FROM (SELECT BoroCD, CASE WHEN BoroCD % 13 = 0 THEN NULL ELSE CAST(1 + (BoroCD * 7) % 32 AS DOUBLE) END AS SchoolDist
      FROM (SELECT DISTINCT (1 + c_custkey % 5) * 100 + 1 + c_custkey % 12 AS BoroCD FROM customer))""",
    "std_tract": _with(MESSY) + f"""
SELECT tract_number, tract_text,
 {_tract_from_text("CAST(CAST(trunc(tract_number) AS BIGINT) AS VARCHAR)")} AS tract_from_number,
 {_tract_from_text(_strip('tract_text'))} AS tract_from_text
FROM raw_keys""",
    "year_strict": BASE + f"""
SELECT date_text, {_strict_year('date_text')} AS year FROM (
 SELECT CompltYear AS date_text FROM housing_fx UNION ALL SELECT Project_Completion_Date FROM affordable_fx)""",
    "year_any": BASE + f"""
SELECT date_text, {_any_year('date_text')} AS year FROM (
 SELECT CompltYear AS date_text FROM housing_fx UNION ALL SELECT PermitYear FROM housing_fx
 UNION ALL SELECT Project_Completion_Date FROM affordable_fx)""",
    "int_key_text": BASE + f"""
SELECT 'housing' AS source, Job_ID AS row_id, {_int_text('CommntyDst')} AS community_text,
 {_int_text('CenTract20')} AS tract_text, {_int('CouncilDst')} AS council_int FROM housing_fx
UNION ALL
SELECT 'affordable', Project_ID, {_int_text('(All_Counted_Units / 4)')}, {_int_text('census_tract')}, {_int('BBL')}
FROM affordable_fx""",
    "distinct_pairs": BASE + "SELECT DISTINCT CommntyDst, CouncilDst FROM housing_fx",
    "preview_head": _with(HOUSING_FX, HOUSING_CLEAN) + "SELECT * FROM housing_clean ORDER BY Job_ID LIMIT 20",
    "sample_rows": BASE + """
SELECT * FROM housing_fx ORDER BY md5(CAST(Job_ID AS VARCHAR) || ':42'), Job_ID LIMIT 10""",
}


def _council_summary() -> str:
    """Brute force: build the full null-safe council join, then count."""
    return BASE + """,
a AS (SELECT council_district, count(*) AS affordable_rows FROM affordable_fx GROUP BY council_district),
h AS (SELECT CouncilDst, count(*) AS housing_rows FROM housing_fx GROUP BY CouncilDst),
pairs AS (
 SELECT h.CouncilDst, count(*) AS joined_rows, coalesce(sum(h.ClassANet), 0) AS housing_units,
  coalesce(sum(af.All_Counted_Units), 0) AS affordable_units
 FROM housing_fx h LEFT JOIN affordable_fx af ON h.CouncilDst IS NOT DISTINCT FROM af.council_district
 GROUP BY h.CouncilDst)
SELECT p.CouncilDst, h.housing_rows, coalesce(a.affordable_rows, 0) AS affordable_rows, p.joined_rows,
 p.housing_units, p.affordable_units
FROM pairs p JOIN h ON p.CouncilDst IS NOT DISTINCT FROM h.CouncilDst
 LEFT JOIN a ON p.CouncilDst IS NOT DISTINCT FROM a.council_district"""


ORACLE_SQL["council_cross_join"] = _council_summary()


# ---- profiling -------------------------------------------------------------

JOB_COLUMNS = [("Job_ID", "bigint"), ("CommntyDst", "double"), ("CouncilDst", "double"),
               ("CenTract20", "double"), ("BBL", "bigint"), ("CompltYear", "string"),
               ("PermitYear", "string"), ("ClassANet", "double"), ("ZoningDst1", "string"),
               ("FloorsProp", "double")]
CUSTOMER_COLUMNS = [("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"),
                    ("c_acctbal", "double"), ("c_mktsegment", "string")]
LINEITEM_NUMERIC = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                    "l_extendedprice", "l_discount", "l_tax"]


def _profile_sql(source: str, columns) -> str:
    """Per column: brute-force distinct list, bounds, gaps and z-score outliers."""
    parts = []
    for i, (c, kind) in enumerate(columns):
        numeric = kind in ("bigint", "int", "double")
        gap_text = "nan" if numeric else "None"
        listed = (f"(SELECT string_agg(v, ',' ORDER BY v) FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v "
                  f"FROM {source} WHERE {c} IS NOT NULL))")
        n_values = f"(SELECT count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) FROM {source})"
        gaps = f"(SELECT count(*) FROM {source} WHERE {c} IS NULL)"
        if kind == "string":
            other = "'many str values'"
        else:
            other = (f"(SELECT 'bounds: ' || CAST(min({c}) AS VARCHAR) || '-' || CAST(max({c}) AS VARCHAR) "
                     f"FROM {source})")
        sample = (f"CASE WHEN {n_values} <= 10 THEN concat_ws(',', {listed}, "
                  f"CASE WHEN {gaps} > 0 THEN '{gap_text}' END) ELSE {other} END")
        if numeric:
            outliers = (f"(SELECT count(*) FROM {source}, (SELECT avg({c}) m, stddev_pop({c}) s FROM {source}) st "
                        f"WHERE st.s > 0 AND abs(({c} - st.m) / st.s) > 3)")
        else:
            outliers = "CAST(NULL AS BIGINT)"
        parts.append(f"SELECT {i} AS position, '{c}' AS column_name, '{kind}' AS dtype, {sample} AS sample, "
                     f"{gaps} AS missing, {outliers} AS outliers")
    return "\nUNION ALL\n".join(parts)


def _dataset_sql(source: str, columns) -> str:
    gap = " OR ".join(f"{c} IS NULL" for c in columns)
    keys = ", ".join(columns)
    return f"""
SELECT CAST(sum(n) AS BIGINT) AS total_rows,
 CAST(coalesce(sum(CASE WHEN n > 1 THEN n END), 0) AS BIGINT) AS duplicated_rows,
 CAST(coalesce(sum(CASE WHEN gap THEN n END), 0) AS BIGINT) AS rows_with_missing,
 CAST({len(columns)} AS BIGINT) AS columns
FROM (SELECT count(*) AS n, bool_or({gap}) AS gap FROM {source} GROUP BY {keys})"""


ORACLE_SQL["profile_columns"] = BASE + _profile_sql("housing_fx", JOB_COLUMNS)
ORACLE_SQL["profile_customer"] = _profile_sql("customer", CUSTOMER_COLUMNS)
ORACLE_SQL["profile_dataset"] = BASE + _dataset_sql("housing_fx", [c for c, _ in JOB_COLUMNS[1:]])
ORACLE_SQL["profile_dataset_jobs"] = BASE + _dataset_sql("housing_fx", [c for c, _ in JOB_COLUMNS])
ORACLE_SQL["profile_dataset_lineitem"] = _dataset_sql(
    "lineitem", ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"])
ORACLE_SQL["null_counts"] = BASE + "\nUNION ALL\n".join(
    f"SELECT {i} AS position, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS missing FROM housing_fx"
    for i, (c, _) in enumerate(JOB_COLUMNS))
ORACLE_SQL["zscore_outliers"] = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, (SELECT count(*) FROM lineitem, "
    f"(SELECT avg({c}) m, stddev_pop({c}) s FROM lineitem) st WHERE st.s > 0 AND abs(({c} - st.m) / st.s) > 3) AS outliers"
    for c in LINEITEM_NUMERIC)


# ---- geometry ---------------------------------------------------------------

def _template_values() -> str:
    from ..sources.layers import AREA_SHAPES
    rows = []
    for shape, rings in AREA_SHAPES.items():
        for ring_no, ring in enumerate(rings):
            for seq, (ux, uy) in enumerate(ring):
                rows.append(f"({shape}, {ring_no}, {seq}, {ux}, {uy})")
    return ", ".join(rows)


GEO_LAYERS = f"""
area_tpl(shape, ring, seq, ux, uy) AS (VALUES {_template_values()}),
areas_v AS (
 SELECT c_custkey AS key, t.ring, t.seq,
  CAST((c_custkey % 50) * 100 + 10 + t.ux * (5 + c_custkey % 16) AS DOUBLE) AS x,
  CAST((c_custkey // 50) * 100 + 10 + t.uy * (5 + (c_custkey // 7) % 16) AS DOUBLE) AS y
 FROM customer JOIN area_tpl t ON t.shape = (c_custkey + c_nationkey) % 4),
zone_tpl(part, ring, seq, use_far_x, dx, use_far_y, dy) AS (VALUES
 (0, 0, 0, false, 0, false, 0), (0, 0, 1, true, 0, false, 0), (0, 0, 2, true, 0, true, 0), (0, 0, 3, false, 0, true, 0),
 (0, 0, 4, false, 0, false, 0),
 (0, 1, 0, false, 30, false, 20), (0, 1, 1, false, 30, false, 60), (0, 1, 2, false, 70, false, 60),
 (0, 1, 3, false, 70, false, 20), (0, 1, 4, false, 30, false, 20),
 (1, 0, 0, true, 10, false, 10), (1, 0, 1, true, 25, false, 10), (1, 0, 2, true, 25, false, 25),
 (1, 0, 3, true, 10, false, 25), (1, 0, 4, true, 10, false, 10)),
zone_corners AS (
 SELECT s_suppkey AS key, ((s_suppkey * 7) % 50) * 100 + 40 AS x0, s_suppkey * 30 - 25 AS y0,
  ((s_suppkey * 7) % 50) * 100 + 40 + 100 * (2 + s_suppkey % 4) AS x1,
  s_suppkey * 30 - 25 + 100 * (1 + s_suppkey % 3) AS y1
 FROM supplier),
zones_v AS (
 SELECT z.key, t.part, t.ring, t.seq,
  CAST(CASE WHEN t.use_far_x THEN z.x1 ELSE z.x0 END + t.dx AS DOUBLE) AS x,
  CAST(CASE WHEN t.use_far_y THEN z.y1 ELSE z.y0 END + t.dy AS DOUBLE) AS y
 FROM zone_corners z JOIN zone_tpl t ON CASE WHEN t.part = 1 THEN z.key % 7 = 0 ELSE t.ring = 0 OR z.key % 5 = 0 END),
area_edges AS (
 SELECT * FROM (SELECT key, ring, x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2
  FROM areas_v WINDOW w AS (PARTITION BY key, ring ORDER BY seq)) WHERE x2 IS NOT NULL),
zone_edges AS (
 SELECT * FROM (SELECT key, ring, x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2
  FROM zones_v WINDOW w AS (PARTITION BY key, part, ring ORDER BY seq)) WHERE x2 IS NOT NULL),
ring_sums AS (
 SELECT key, ring, sum(x1 * y2 - x2 * y1) AS s, sum((x1 + x2) * (x1 * y2 - x2 * y1)) AS sx,
  sum((y1 + y2) * (x1 * y2 - x2 * y1)) AS sy
 FROM area_edges GROUP BY key, ring),
cent AS (
 SELECT key, sum(f * s) / 2 AS area, sum(f * sx) / (sum(f * s) * 3) AS cx, sum(f * sy) / (sum(f * s) * 3) AS cy
 FROM (SELECT *, CASE WHEN ring = 0 THEN sign(s) ELSE -sign(s) END AS f FROM ring_sums) GROUP BY key),
area_box AS (SELECT key, min(x) AS minx, min(y) AS miny, max(x) AS maxx, max(y) AS maxy FROM areas_v WHERE ring = 0 GROUP BY key),
zone_box AS (SELECT key, min(x) AS minx, min(y) AS miny, max(x) AS maxx, max(y) AS maxy FROM zones_v WHERE ring = 0 GROUP BY key)"""


def _ray_tests(points: str, edges: str) -> str:
    """(pkey, zkey, crossings, on_edge) for candidate (point, polygon) pairs."""
    d = "((e.x2 - e.x1) * (p.py - e.y1) - (p.px - e.x1) * (e.y2 - e.y1))"
    return f"""
 SELECT p.pkey, p.zkey,
  sum(CASE WHEN ((e.y1 > p.py) <> (e.y2 > p.py)) AND (({d} > 0) = (e.y2 > e.y1)) THEN 1 ELSE 0 END) AS crossings,
  bool_or({d} = 0 AND p.px BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)
          AND p.py BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2)) AS on_edge
 FROM {points} p JOIN {edges} e ON e.key = p.zkey GROUP BY p.pkey, p.zkey"""


def _orient(ax, ay, bx, by, cx, cy) -> str:
    return f"sign(({bx} - {ax}) * ({cy} - {ay}) - ({by} - {ay}) * ({cx} - {ax}))"


def _on_seg(x1, y1, x2, y2, px, py) -> str:
    return (f"({px} BETWEEN least({x1}, {x2}) AND greatest({x1}, {x2}) "
            f"AND {py} BETWEEN least({y1}, {y2}) AND greatest({y1}, {y2}))")


WITHIN_SQL = _with(GEO_LAYERS) + f""",
cand AS (
 SELECT c.key AS pkey, z.key AS zkey, c.cx AS px, c.cy AS py FROM cent c JOIN zone_box z
 ON c.cx BETWEEN z.minx AND z.maxx AND c.cy BETWEEN z.miny AND z.maxy),
tests AS ({_ray_tests('cand', 'zone_edges')}),
inside AS (SELECT pkey, zkey FROM tests WHERE crossings % 2 = 1 AND NOT on_edge)
SELECT DISTINCT c.key AS area_key, i.zkey AS zone_key FROM cent c LEFT JOIN inside i ON c.key = i.pkey"""

_SEG = " OR ".join([
    f"({_orient('a.x1', 'a.y1', 'a.x2', 'a.y2', 'z.x1', 'z.y1')} * {_orient('a.x1', 'a.y1', 'a.x2', 'a.y2', 'z.x2', 'z.y2')} < 0 "
    f"AND {_orient('z.x1', 'z.y1', 'z.x2', 'z.y2', 'a.x1', 'a.y1')} * {_orient('z.x1', 'z.y1', 'z.x2', 'z.y2', 'a.x2', 'a.y2')} < 0)",
    f"({_orient('a.x1', 'a.y1', 'a.x2', 'a.y2', 'z.x1', 'z.y1')} = 0 AND {_on_seg('a.x1', 'a.y1', 'a.x2', 'a.y2', 'z.x1', 'z.y1')})",
    f"({_orient('a.x1', 'a.y1', 'a.x2', 'a.y2', 'z.x2', 'z.y2')} = 0 AND {_on_seg('a.x1', 'a.y1', 'a.x2', 'a.y2', 'z.x2', 'z.y2')})",
    f"({_orient('z.x1', 'z.y1', 'z.x2', 'z.y2', 'a.x1', 'a.y1')} = 0 AND {_on_seg('z.x1', 'z.y1', 'z.x2', 'z.y2', 'a.x1', 'a.y1')})",
    f"({_orient('z.x1', 'z.y1', 'z.x2', 'z.y2', 'a.x2', 'a.y2')} = 0 AND {_on_seg('z.x1', 'z.y1', 'z.x2', 'z.y2', 'a.x2', 'a.y2')})",
])

INTERSECTS_SQL = _with(GEO_LAYERS) + f""",
pairs AS (
 SELECT a.key AS akey, z.key AS zkey FROM area_box a JOIN zone_box z
 ON a.minx <= z.maxx AND z.minx <= a.maxx AND a.miny <= z.maxy AND z.miny <= a.maxy),
edge_hits AS (
 SELECT DISTINCT p.akey, p.zkey FROM pairs p JOIN area_edges a ON a.key = p.akey JOIN zone_edges z ON z.key = p.zkey
 WHERE {_SEG}),
a_first AS (SELECT p.akey AS pkey, p.zkey, v.x AS px, v.y AS py FROM pairs p JOIN areas_v v
            ON v.key = p.akey AND v.ring = 0 AND v.seq = 0),
z_first AS (SELECT p.zkey AS pkey, p.akey AS zkey, v.x AS px, v.y AS py FROM pairs p JOIN zones_v v
            ON v.key = p.zkey AND v.ring = 0 AND v.seq = 0),
a_in_z AS (SELECT pkey AS akey, zkey FROM ({_ray_tests('a_first', 'zone_edges')}) WHERE crossings % 2 = 1 OR on_edge),
z_in_a AS (SELECT zkey AS akey, pkey AS zkey FROM ({_ray_tests('z_first', 'area_edges')}) WHERE crossings % 2 = 1 OR on_edge),
hits AS (SELECT * FROM edge_hits UNION SELECT * FROM a_in_z UNION SELECT * FROM z_in_a)
SELECT DISTINCT a.key AS area_key, h.zkey AS zone_key FROM area_box a LEFT JOIN hits h ON a.key = h.akey"""

ORACLE_SQL["polygon_centroid"] = _with(GEO_LAYERS) + "SELECT key, area, cx, cy FROM cent"
ORACLE_SQL["crosswalk_within"] = ORACLE_SQL["crosswalk_within_tree"] = WITHIN_SQL
ORACLE_SQL["crosswalk_intersects"] = ORACLE_SQL["crosswalk_intersects_tree"] = INTERSECTS_SQL
ORACLE_SQL["crosswalk_standardize"] = f"""
WITH boro AS (SELECT DISTINCT (1 + c_custkey % 5) * 100 + 1 + c_custkey % 12 AS BoroCD FROM customer),
school_xw AS (
 SELECT BoroCD AS community_district,
  CAST(trunc(CASE WHEN BoroCD % 13 = 0 THEN NULL ELSE CAST(1 + (BoroCD * 7) % 32 AS DOUBLE) END) AS BIGINT) AS school_district
 FROM boro),
tract_xw AS (
 SELECT BoroCD AS community_district,
  {_tract_from_text("CAST(CAST(trunc(CASE WHEN BoroCD % 11 = 0 THEN NULL ELSE CAST(BoroCD * 211 AS DOUBLE) END) AS BIGINT) AS VARCHAR)")} AS census_tract
 FROM boro)
SELECT coalesce(s.community_district, t.community_district) AS community_district, s.school_district, t.census_tract
FROM school_xw s FULL JOIN tract_xw t ON s.community_district = t.community_district"""

ORACLE_SQL["geojson_roundtrip"] = _with(GEO_LAYERS) + """
SELECT 'areas' AS layer, key, 0 AS part, ring, seq, x, y, NULL AS name FROM areas_v
UNION ALL
SELECT 'zones' AS layer, key, part, ring, seq, x, y, 'zone ' || key AS name FROM zones_v"""
ORACLE_SQL["csv_roundtrip"] = BASE + "SELECT * FROM housing_fx"
ORACLE_SQL["table_replace"] = CLEAN + "SELECT * FROM affordable_clean"
ORACLE_SQL["housing_job"] = CLEAN_JOINED + METRICS

_CLEAN_JOB_COLUMNS = [c for c, _ in JOB_COLUMNS] + ["community_district", "council_district", "census_tract",
                                                    "year_of_completion", "permit_year"]
ORACLE_SQL["preview_transposed"] = _with(HOUSING_FX, HOUSING_CLEAN) + \
    ", first_job AS (SELECT * FROM housing_clean ORDER BY Job_ID LIMIT 1)\n" + "\nUNION ALL\n".join(
        f"SELECT {i} AS position, '{c}' AS column, CAST({c} AS VARCHAR) AS value FROM first_job"
        for i, c in enumerate(_CLEAN_JOB_COLUMNS))

# ---- C9 --------------------------------------------------------------------

ORACLE_SQL["std_fact_housing"] = BASE + f"""
SELECT Job_ID, CAST(trunc(CommntyDst) AS BIGINT) AS community_district,
 CAST(trunc(CouncilDst) AS BIGINT) AS council_district,
 {_tract_from_text("CAST(CAST(trunc(CenTract20) AS BIGINT) AS VARCHAR)")} AS census_tract,
 BBL, CompltYear, PermitYear, ClassANet, ZoningDst1, FloorsProp
FROM housing_fx"""
ORACLE_SQL["std_fact_affordable"] = BASE + f"""
SELECT Project_ID, BBL, {_board('community_district')} AS community_district,
 CAST(trunc(council_district) AS BIGINT) AS council_district,
 {_tract_from_text("CAST(CAST(trunc(census_tract) AS BIGINT) AS VARCHAR)")} AS census_tract,
 Project_Completion_Date, Reporting_Construction_Type, All_Counted_Units
FROM affordable_fx"""
ORACLE_SQL["std_fact_school"] = """
SELECT s_suppkey AS School_ID, 1 + s_suppkey % 32 AS school_district, 500 + (s_suppkey * 37) % 700 AS Org_Target_Cap,
 400 + (s_suppkey * 53) % 800 AS Org_Enroll
FROM supplier"""
ORACLE_SQL["std_fact_transit"] = f"""
SELECT {_tract_from_text(_strip("(CASE p_partkey % 5 WHEN 0 THEN '36005' WHEN 1 THEN '36047' WHEN 2 THEN '36061' WHEN 3 THEN '36081' ELSE '36085' END || lpad(CAST(100 * (1 + p_partkey % 900) + p_partkey % 3 AS VARCHAR), 6, '0'))"))} AS census_tract,
 p_retailprice AS Transit_Score
FROM part"""


# ---- school step by district, quality report, crosswalk sets ----------------

BY_DISTRICT = """,
district AS (SELECT Geo_Dist, count(*) AS schools, CAST(sum(SchoolCapacity) AS BIGINT) AS spare_seats
 FROM (SELECT 1 + s_suppkey % 32 AS Geo_Dist, (500 + (s_suppkey * 37) % 700) - (400 + (s_suppkey * 53) % 800) AS SchoolCapacity
  FROM supplier) GROUP BY Geo_Dist),
district_xw AS (SELECT BoroCD, CASE WHEN BoroCD % 13 = 0 THEN NULL ELSE CAST(1 + (BoroCD * 7) % 32 AS DOUBLE) END AS SchoolDist
 FROM (SELECT DISTINCT (1 + c_custkey % 5) * 100 + 1 + c_custkey % 12 AS BoroCD FROM customer)),
job_district AS (SELECT h.*, x.BoroCD, x.SchoolDist, d.Geo_Dist, d.schools, d.spare_seats FROM housing_fx h
 LEFT JOIN district_xw x ON h.CommntyDst = x.BoroCD LEFT JOIN district d ON x.SchoolDist = d.Geo_Dist)"""

ORACLE_SQL["school_bridge_by_district"] = BASE + BY_DISTRICT + "\nSELECT * FROM job_district"
ORACLE_SQL["fill_unknown"] = BASE + BY_DISTRICT + """
SELECT """ + ", ".join(
    f"coalesce(CAST({c} AS VARCHAR), 'Unknown') AS {c}" for c in
    [c for c, _ in JOB_COLUMNS] + ["BoroCD", "SchoolDist", "Geo_Dist", "schools", "spare_seats"]) + "\nFROM job_district"
ORACLE_SQL["council_school_summary"] = BASE + BY_DISTRICT + """,
built AS (SELECT council_district, count(*) AS a_rows, sum(All_Counted_Units) AS a_units FROM affordable_fx GROUP BY 1),
chain AS (SELECT j.CommntyDst, j.CouncilDst, j.SchoolDist, j.ClassANet, coalesce(b.a_rows, 0) AS a_rows,
 coalesce(b.a_units, 0) AS a_units, coalesce(j.schools, 0) AS schools, j.spare_seats,
 greatest(coalesce(b.a_rows, 0), 1) AS m, greatest(coalesce(j.schools, 0), 1) AS s
 FROM job_district j LEFT JOIN built b ON j.CouncilDst IS NOT DISTINCT FROM b.council_district)
SELECT CommntyDst, CouncilDst, SchoolDist, count(*) AS housing_rows, any_value(a_rows) AS affordable_rows,
 any_value(schools) AS schools, any_value(spare_seats) AS spare_seats, CAST(sum(m * s) AS BIGINT) AS joined_rows,
 sum(ClassANet * m * s) AS housing_units, sum(a_units * s) AS affordable_units
FROM chain GROUP BY CommntyDst, CouncilDst, SchoolDist"""

ORACLE_SQL["join_quality_report"] = BASE + "," + LOT_YEAR.lstrip() + """
SELECT (SELECT count(*) FROM housing_fx) AS housing_rows, (SELECT count(*) FROM affordable_fx) AS affordable_rows,
 (SELECT count(*) FROM jobs) AS housing_rows_completed, (SELECT count(*) FROM jobs WHERE BBL IS NULL) AS housing_missing_lot,
 (SELECT count(*) FROM jobs WHERE year_of_completion IS NULL) AS housing_missing_year,
 (SELECT coalesce(sum(ClassANet), 0) FROM jobs) AS housing_units,
 (SELECT count(*) FROM nc) AS affordable_rows_new, (SELECT count(*) FROM nc WHERE BBL IS NULL) AS affordable_missing_lot,
 (SELECT count(*) FROM nc_kept) AS affordable_rows_left,
 (SELECT count(*) FROM nc_kept WHERE year_of_completion IS NULL) AS affordable_missing_year,
 (SELECT coalesce(sum(All_Counted_Units), 0) FROM nc_kept) AS affordable_units,
 (SELECT count(*) FROM jobs j WHERE NOT EXISTS (SELECT 1 FROM nc_kept k WHERE j.BBL IS NOT DISTINCT FROM k.BBL
  AND j.year_of_completion IS NOT DISTINCT FROM k.year_of_completion)) AS unjoined_rows"""


def _rectangles(name: str) -> str:
    table, key, columns, spacing, ox, oy, sizes, least = DISTRICTS[name]
    x0 = f"(({key} % {columns}) * {spacing} + {ox} + ({key} * 37) % 301)"
    y0 = f"(({key} // {columns}) * {spacing} + {oy} + ({key} * 53) % 211)"
    w, h = f"(({key} % {sizes}) * 2 + {least})", f"((({key} // 3) % {sizes}) * 2 + {least + 2})"
    return (f"{name} AS (SELECT CAST({key} AS BIGINT) AS key, {x0} AS x0, {y0} AS y0, {x0} + {w} AS x1, {y0} + {h} AS y1 "
            f"FROM {table})")


# Whole hundredths: twice the centroid is a whole number, so everything is exact.
_WITHIN = "a.x0 + a.x1 > 2 * z.x0 AND a.x0 + a.x1 < 2 * z.x1 AND a.y0 + a.y1 > 2 * z.y0 AND a.y0 + a.y1 < 2 * z.y1"
_OVERLAP = "a.x0 <= z.x1 AND z.x0 <= a.x1 AND a.y0 <= z.y1 AND z.y0 <= a.y1"


def _pairs_sql(pairs, condition: str) -> str:
    return "WITH " + ", ".join(_rectangles(n) for n in DISTRICTS) + "\n" + "\nUNION ALL\n".join(
        f"SELECT '{a}_to_{z}' AS pair, a.key AS source_key, z.key AS target_key FROM {a} a LEFT JOIN {z} z ON {condition}"
        for a, z in pairs)


ORACLE_SQL["crosswalk_set_within"] = _pairs_sql(
    [("community", "tract"), ("council", "tract"), ("community", "school"), ("council", "school")], _WITHIN)
ORACLE_SQL["crosswalk_set_intersects"] = _pairs_sql(
    [("tract", "community"), ("community", "council"), ("tract", "council"), ("tract", "school"),
     ("community", "school"), ("council", "school")], _OVERLAP)
ORACLE_SQL["crosswalk_within_decimal"] = (
    "SELECT source_key AS area_key, target_key AS zone_key FROM (" + _pairs_sql([("community", "council")], _WITHIN) + ")")

# J5 as the chain of joins itself, every joined row built.
ORACLE_SQL["crosswalk_chain"] = BASE + "," + SCHOOL_XW.lstrip() + """,
tract_xw AS (SELECT DISTINCT (1 + c_custkey % 5) * 100 + 1 + c_custkey % 12 AS BoroCD FROM customer),
council_xw AS (SELECT DISTINCT (1 + c_custkey % 5) * 100 + 1 + c_custkey % 12 AS BoroCD, 1 + c_custkey % 51 AS CounDist FROM customer)
SELECT h.CommntyDst, x.SchoolDist, count(*) AS joined_rows, coalesce(sum(h.ClassANet), 0) AS housing_units,
 CAST(coalesce(sum(s.SchoolCapacity), 0) AS BIGINT) AS spare_seats, coalesce(sum(a.All_Counted_Units), 0) AS affordable_units
FROM housing_fx h
LEFT JOIN tract_xw t ON h.CommntyDst = t.BoroCD
LEFT JOIN council_xw c ON h.CommntyDst = c.BoroCD
LEFT JOIN xw x ON h.CommntyDst = x.BoroCD
LEFT JOIN schools s ON x.SchoolDist = s.Geo_Dist
LEFT JOIN affordable_fx a ON h.BBL = a.BBL
GROUP BY h.CommntyDst, x.SchoolDist"""

# The dates that the texts were written from.
ORACLE_SQL["dates_inferred"] = """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS us_date, CAST(o_orderdate AS DATE) AS eu_date,
 CASE WHEN o_orderkey % 9 NOT IN (0, 7) THEN CAST(o_orderdate AS DATE) END AS mixed_date,
 CASE WHEN o_orderkey % 9 NOT IN (0, 7) THEN year(o_orderdate) END AS mixed_year
FROM orders"""

ORACLE_SQL["profile_incremental"] = ORACLE_SQL["profile_dataset_lineitem"]
