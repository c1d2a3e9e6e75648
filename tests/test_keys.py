"""Key and year standardisers, case by case (text and numeric inputs)."""

import pytest
from pyspark.sql.types import DoubleType, StringType

from blocklot.functions import dates, keys


def _apply(spark, fn, values, dtype):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype.simpleString()}")
    return [r[0] for r in df.select(fn("v", dtype).alias("o")).collect()]


BOARD_CASES = [
    ("MN-11", 111), (" bk - 3 ", 303), ("si-1", 501), ("QN-123", 4123), ("101.0", 101),
    ("XX-01", None), ("MN-xx", None), ("MN--5", None), ("-101", None), ("", None), (None, None),
    ("MN-+5", 105), ("MN-0", 100), ("\tBX-04\n", 204), ("1e-5", None), ("inf", None), ("nan", None),
]


@pytest.mark.parametrize("raw,expected", BOARD_CASES)
def test_community_board_text(spark, raw, expected):
    assert _apply(spark, keys.community_board, [raw], StringType()) == [expected]


def test_community_board_staged_equals_single_expression(spark):
    df = spark.createDataFrame([(r,) for r, _ in BOARD_CASES], "v string")
    staged = keys.with_community_board(df, "v", "o").select("v", "o")
    single = df.select("v", keys.community_board("v", StringType()).alias("o"))
    assert sorted(map(tuple, staged.collect()), key=str) == sorted(map(tuple, single.collect()), key=str)


def test_community_board_numeric(spark):
    assert _apply(spark, keys.community_board, [101.0, 8.9, None, float("nan")], DoubleType()) == [101, 8, None, None]


@pytest.mark.parametrize("raw,expected", [("8.0", 8), ("8.9", 8), ("x", None), (None, None), (" 12 ", 12),
                                          ("-3", -3), ("1e1", 10), ("nan", None), ("inf", None)])
def test_council_text(spark, raw, expected):
    assert _apply(spark, keys.council_district, [raw], StringType()) == [expected]


def test_council_and_school_numeric(spark):
    assert _apply(spark, keys.council_district, [8.0, 8.9, None], DoubleType()) == [8, 8, None]
    assert _apply(spark, keys.school_district, [27.0, None], DoubleType()) == [27, None]


def test_tract_numeric(spark):
    got = _apply(spark, keys.census_tract, [86400.0, 242.0, 36061024200.0, None], DoubleType())
    assert got == ["086400", "000242", "024200", None]


def test_tract_text(spark):
    got = _apply(spark, keys.census_tract, [" 123 ", "36061024200", "242.0", "-12", None], StringType())
    assert got == ["000123", "024200", "0242.0", "-00012", None]


def test_int_key_text(spark):
    assert _apply(spark, keys.int_key_text, [101.0, 2.5, None, float("nan"), float("inf")], DoubleType()) == \
        ["101", None, None, None, None]


def test_int_key_strict_raises(spark):
    df = spark.createDataFrame([(2.5,)], "v double")
    with pytest.raises(Exception):
        df.select(keys.int_key("v", DoubleType(), strict=True)).collect()


@pytest.mark.parametrize("raw,strict,free", [
    ("1/5/2020", 2020, 2020), ("01/05/2020", 2020, 2020), ("13/1/2020", None, None), ("2015", None, 2015),
    ("2020-01-05", None, 2020), ("x", None, None), (None, None, None), ("2/30/2020", None, None),
    ("2020-01-05T10:00:00", None, 2020)])
def test_years(spark, raw, strict, free):
    df = spark.createDataFrame([(raw,)], "v string")
    row = df.select(dates.strict_year("v").alias("s"), dates.any_year("v", StringType()).alias("a")).first()
    assert (row["s"], row["a"]) == (strict, free)


def test_zero_pad_and_joined_values(spark):
    df = spark.createDataFrame([("7",), ("123",), ("7",), ("45",)], "v string")
    assert [r[0] for r in df.select(keys.zero_pad("v", 2)).collect()] == ["07", "123", "07", "45"]
    assert df.agg(keys.joined_values("v")).first()[0] == "123,45,7"
