"""Raw key text in the forms the source tables actually hold.

Derived per row from ``lineitem`` so that every standardiser sees clean
codes, spacing and case variants, numbers written as floats, unknown
prefixes and broken districts, at a volume that grows with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .standins import BOROUGH_SPELLINGS
from .tables import read_table


def raw_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    ok, ln, pk = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    lot = pk % 1500
    boro = 1 + lot % 5
    dist = 1 + lot % 12
    spelling = F.when(lot % 5 == 0, BOROUGH_SPELLINGS[0])
    for i, text in enumerate(BOROUGH_SPELLINGS[1:], start=1):
        spelling = spelling.when(lot % 5 == i, text)
    dist_s = dist.cast("string")
    board = (F.when(ln == 1, F.concat(spelling, F.lit("-"), F.lpad(dist_s, 2, "0")))
             .when(ln == 2, F.concat(F.lower(spelling), F.lit(" - "), dist_s))
             .when(ln == 3, (boro * 100 + dist).cast("double").cast("string"))
             .when(ln == 4, F.concat(F.lit("XX-"), dist_s))
             .when(ln == 5, F.concat(spelling, F.lit("-x"), dist_s))
             .when(ln == 6, F.concat(spelling, F.lit("--"), dist_s))
             .otherwise(F.concat(F.lit("-"), (boro * 100 + dist).cast("string"))))
    council = (F.when(ln <= 2, (1 + lot % 51).cast("double").cast("string"))
               .when(ln == 3, F.concat(F.lit(" "), (1 + lot % 51).cast("string"), F.lit(" ")))
               .when(ln == 4, (F.col("l_quantity") / 4).cast("string"))
               .when(ln == 5, F.lit("x"))
               .when(ln == 6, F.lit(None).cast("string"))
               .otherwise(F.concat((1 + lot % 51).cast("string"), F.lit("e0"))))
    tract_num = (F.when(ln == 6, F.lit(None).cast("double"))
                 .when(ln == 7, (36061000000 + 100 * (1 + lot % 900)).cast("double"))
                 .otherwise((100 * (1 + lot % 900) + ln % 3).cast("double")))
    tract_text = (F.when(ln <= 2, F.lpad((100 * (1 + lot % 900)).cast("string"), 6, "0"))
                  .when(ln == 3, F.concat(F.lit(" "), (1 + lot % 900).cast("string"), F.lit(" ")))
                  .when(ln == 4, (36061000000 + 100 * (1 + lot % 900)).cast("string"))
                  .when(ln == 5, (100 * (1 + lot % 900)).cast("double").cast("string"))
                  .when(ln == 6, F.lit(None).cast("string"))
                  .otherwise(F.concat(F.lit("-"), (lot % 97).cast("string"))))
    return li.select(
        ok.alias("line_order"), ln.alias("line_no"),
        board.alias("board_text"), council.alias("council_text"),
        tract_num.alias("tract_number"), tract_text.alias("tract_text"),
    )


def raw_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as text: one column month first, one day first, one in every other layout (and some that are no dates)."""
    o = read_table(spark, sf_dir, "orders")
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp")

    def written(pattern: str):
        return F.date_format(day, pattern)
    mixed = F.when(key % 9 == 1, written("MMM d, yyyy")).when(key % 9 == 2, written("d MMMM yyyy")).when(
        key % 9 == 3, written("yyyyMMdd")).when(key % 9 == 4, written("yyyy/M/d")).when(
        key % 9 == 5, written("yyyy-MM-dd'T'HH:mm:ss'+05:30'")).when(key % 9 == 6, written("dd-MMM-yy")).when(
        key % 9 == 7, F.lit("not a date")).when(key % 9 == 8, written("E, dd MMM yyyy"))
    return o.select(
        key.alias("o_orderkey"),
        F.when(key % 3 == 0, written("M/d/yyyy")).when(key % 3 == 1, written("MM/dd/yyyy")).otherwise(written("M/d/yyyy h:mm a")).alias("us_text"),
        F.when(key % 2 == 0, written("d/M/yyyy")).otherwise(written("dd/MM/yyyy HH:mm")).alias("eu_text"), mixed.alias("mixed_text"))
