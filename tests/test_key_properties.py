"""Randomised checks: the Spark key expressions against a small Python spec.

The spec states the documented rules in plain Python; hypothesis generates
batches of messy codes (one Spark job per batch).
"""

import math
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql.types import StringType

from blocklot.functions import keys

BOROUGHS = {"MN": 1, "BX": 2, "BK": 3, "QN": 4, "SI": 5}
NUMBER = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
WS = " \t\n\r\f\v"


def spec_number(s):
    s = s.strip(WS)
    if not re.fullmatch(NUMBER, s):
        return None
    f = float(s)
    if math.isinf(f) or math.isnan(f) or abs(f) >= 9.2e18:
        return None
    return int(f)


def spec_board(v):
    if v is None:
        return None
    s = v.strip(WS)
    if "-" not in s:
        return spec_number(s)
    prefix, dist = s.split("-", 1)
    boro = BOROUGHS.get(prefix.strip(WS).upper())
    dist = dist.strip(WS)
    if boro is None or not re.fullmatch(r"[+-]?[0-9]+", dist):
        return None
    n = int(dist)
    return None if n < 0 else int(f"{boro}{n:02d}")


def spec_tract(v):
    if v is None:
        return None
    s = v.strip(WS)
    return s[-6:].zfill(6)


pieces = st.sampled_from(["MN", "mn", "Bx", " bk ", "QN", "si", "XX", "M N", "-", "--", " - ", "+", ".", "e",
                          "0", "7", "12", "05", "123", "4567", " ", "\t", "x", "1e2", ".5"])
codes = st.lists(st.one_of(st.none(), st.lists(pieces, min_size=0, max_size=5).map("".join)),
                 min_size=1, max_size=60)
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def _run(spark, fn, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(fn("v", StringType()).alias("o")).collect()]


@SETTINGS
@given(values=codes)
def test_community_board_matches_spec(spark, values):
    assert _run(spark, keys.community_board, values) == [spec_board(v) for v in values]


@SETTINGS
@given(values=codes)
def test_council_matches_spec(spark, values):
    assert _run(spark, keys.council_district, values) == [None if v is None else spec_number(v) for v in values]


@SETTINGS
@given(values=codes)
def test_tract_text_matches_spec(spark, values):
    assert _run(spark, keys.census_tract, values) == [spec_tract(v) for v in values]
