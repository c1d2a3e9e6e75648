"""Stand-in housing tables derived from the driver's order tables.

The real inputs (new-construction jobs, affordable buildings, school
capacity, area crosswalks) are public downloads that are not shipped, so the
same shapes are derived row by row from ``orders``, ``lineitem``,
``supplier`` and ``customer``: their size grows with the scale factor and
their keys carry the same kinds of gaps and messy text as the real ones.
Each function only adds projections to a scan, so Catalyst prunes the scan to
the columns used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table


def _null_double():
    return F.lit(None).cast("double")


def _every(k, n: int):
    return (k % n) == 0


def housing_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New-construction jobs: one row per order."""
    o = read_table(spark, sf_dir, "orders")
    k, c, d = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    shifted = c + F.when(_every(k, 19), 1).otherwise(0)
    return o.select(
        k.alias("Job_ID"),
        F.when(_every(k, 17), _null_double())
         .otherwise(((1 + shifted % 5) * 100 + 1 + c % 12).cast("double")).alias("CommntyDst"),
        F.when(_every(k, 23), _null_double()).otherwise((1 + c % 51).cast("double")).alias("CouncilDst"),
        F.when(_every(k, 11), _null_double()).otherwise((100 * (1 + c % 900)).cast("double")).alias("CenTract20"),
        F.when(_every(k, 29), F.lit(None).cast("bigint"))
         .otherwise(1000000000 + c + F.when(_every(k, 4), 500000).otherwise(0)).alias("BBL"),
        F.when(_every(k, 3), F.lit(None).cast("string"))
         .when(k % 3 == 1, F.concat_ws("/", F.month(d).cast("string"), F.dayofmonth(d).cast("string"),
                                       F.year(d).cast("string")))
         .otherwise(F.year(d).cast("string")).alias("CompltYear"),
        F.when(_every(k, 7), F.lit(None).cast("string")).otherwise(F.year(d).cast("string")).alias("PermitYear"),
        (1 + k % 40).cast("double").alias("ClassANet"),
        F.when(_every(k, 13), F.lit(None).cast("string")).otherwise(F.col("o_orderpriority")).alias("ZoningDst1"),
        (1 + k % 9).cast("double").alias("FloorsProp"),
    )


# Spellings of the borough prefix used in the raw table,
# picked by (part mod 1500) mod 5.
BOROUGH_SPELLINGS = ["MN", " bx ", "BK", "Qn", "SI"]


def affordable_buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Affordable housing buildings: one row per order line."""
    li = read_table(spark, sf_dir, "lineitem")
    ok, ln, pk, sd = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_shipdate")
    lot = pk % 1500
    spelling = F.when(lot % 5 == 0, BOROUGH_SPELLINGS[0])
    for i, text in enumerate(BOROUGH_SPELLINGS[1:], start=1):
        spelling = spelling.when(lot % 5 == i, text)
    return li.select(
        F.when(_every(ok, 31), F.lit(None).cast("bigint")).otherwise(ok % 5000).alias("Project_ID"),
        F.when(_every(ok + ln, 5), _null_double()).otherwise((1000000000 + lot).cast("double")).alias("BBL"),
        F.concat(spelling, F.lit("-"), F.lpad((1 + lot % 12).cast("string"), 2, "0")).alias("community_district"),
        F.when(ln == 7, _null_double()).otherwise((1 + lot % 51).cast("double")).alias("council_district"),
        F.when(ln == 6, _null_double()).otherwise((100 * (1 + lot % 900)).cast("double")).alias("census_tract"),
        F.when(ln == 5, F.lit(None).cast("string"))
         .otherwise(F.concat_ws("/", F.lpad(F.month(sd).cast("string"), 2, "0"),
                                F.lpad(F.dayofmonth(sd).cast("string"), 2, "0"),
                                F.year(sd).cast("string"))).alias("Project_Completion_Date"),
        F.when(F.col("l_returnflag") == "A", "Preservation")
         .when(F.col("l_returnflag") == "N", "New Construction")
         .otherwise(F.lit(None).cast("string")).alias("Reporting_Construction_Type"),
        F.col("l_quantity").alias("All_Counted_Units"),
    )


def school_capacity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """School capacity report: one row per supplier, several per district."""
    s = read_table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(
        k.alias("School_ID"),
        (1 + k % 32).alias("Geo_Dist"),
        (500 + (k * 37) % 700).alias("Org_Target_Cap"),
        (400 + (k * 53) % 800).alias("Org_Enroll"),
    )


def community_to_school(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Community -> school district crosswalk, one row per community.

    Communities are the codes customers fall in; some have no school
    district (blank right key), as in a centroid crosswalk.
    """
    c = read_table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    boro_cd = (1 + key % 5) * 100 + 1 + key % 12
    pairs = c.select(boro_cd.alias("BoroCD")).distinct()
    return pairs.select(
        "BoroCD",
        F.when(F.col("BoroCD") % 13 == 0, _null_double())
         .otherwise((1 + (F.col("BoroCD") * 7) % 32).cast("double")).alias("SchoolDist"),
    )


def community_to_tract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Community -> census tract crosswalk with tract codes written as numbers."""
    c = read_table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    boro_cd = (1 + key % 5) * 100 + 1 + key % 12
    pairs = c.select(boro_cd.alias("BoroCD")).distinct()
    return pairs.select(
        "BoroCD",
        F.when(F.col("BoroCD") % 11 == 0, _null_double())
         .otherwise((F.col("BoroCD") * 211).cast("double")).alias("CT2020"),
    )


def community_to_council(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Community -> council crosswalk, many to many: the councils that customers of a community vote in."""
    key = F.col("c_custkey")
    return read_table(spark, sf_dir, "customer").select(
        ((1 + key % 5) * 100 + 1 + key % 12).alias("BoroCD"), (1 + key % 51).cast("double").alias("CounDist")).distinct()


def transit_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transit access per census tract: 11-digit text census ids, one row per part."""
    p = read_table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    county = F.when(k % 5 == 0, "36005").when(k % 5 == 1, "36047").when(k % 5 == 2, "36061") \
        .when(k % 5 == 3, "36081").otherwise("36085")
    return p.select(
        F.concat(county, F.lpad((100 * (1 + k % 900) + k % 3).cast("string"), 6, "0")).alias("Census_ID"),
        F.col("p_retailprice").alias("Transit_Score"),
    )
