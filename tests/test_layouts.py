"""Dates in inferred layouts, against the dates they were written from and against pandas."""

import datetime
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from blocklot.functions import layouts


def parsed(spark, texts, how=None):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, d string")
    how = how or layouts.infer(df, ["d"])["d"]
    return [r.x for r in df.select("i", how.date("d").alias("x")).orderBy("i").collect()]


def days(n, seed=1):
    rng = random.Random(seed)
    return [datetime.date(rng.randint(1970, 2060), 1, 1) + datetime.timedelta(rng.randint(0, 364)) for _ in range(n)]


FORMATS = ["%m/%d/%Y", "%d/%m/%Y", "%Y/%m/%d", "%Y-%m-%d", "%m-%d-%Y", "%d-%m-%Y", "%d.%m.%Y", "%Y%m%d", "%b %d, %Y", "%B %d, %Y",
           "%d %b %Y", "%d %B %Y", "%d-%b-%Y", "%a, %d %b %Y", "%Y-%b-%d", "%m/%d/%Y %H:%M", "%m/%d/%Y %I:%M:%S %p", "%Y-%m-%dT%H:%M:%S",
           "%Y-%m-%dT%H:%M:%S.123Z", "%Y-%m-%d %H:%M:%S+02:00", "%Y%m%d 10:11:12", "%d/%m/%y", "%m/%d/%y", "%d-%b-%y", "%A, %B %d, %Y"]


@pytest.mark.parametrize("form", FORMATS)
def test_a_column_in_one_layout(spark, form):
    want = [d for d in days(60) if "%y" not in form or 1970 <= d.year < 2060]
    texts = [datetime.datetime(d.year, d.month, d.day, 13, 5, 9).strftime(form) for d in want]
    bare = [t.replace("/0", "/").lstrip("0") if "%d/%m" in form or "%m/%d" in form else t for t in texts]
    assert parsed(spark, texts) == want and ("%y" in form or parsed(spark, bare) == want)


@pytest.mark.parametrize("form", ["%m/%d/%Y", "%Y-%m-%d", "%b %d, %Y", "%d %B %Y", "%Y%m%d", "%Y-%m-%dT%H:%M:%S", "%m/%d/%Y %I:%M:%S %p"])
def test_equals_pandas(spark, form):
    texts = [datetime.datetime(d.year, d.month, d.day, 3, 4, 5).strftime(form) for d in days(40, 2)]
    assert parsed(spark, texts) == [x.date() for x in pd.to_datetime(pd.Series(texts))]
    if form == "%m/%d/%Y":
        eu = [d.strftime("%d/%m/%Y") for d in days(40, 2)]
        assert parsed(spark, eu) == [x.date() for x in pd.to_datetime(pd.Series(eu), dayfirst=True)]


def test_the_column_decides_what_a_text_cannot(spark):
    d = datetime.date
    assert parsed(spark, ["3/4/2020", "25/4/2020"]) == [d(2020, 4, 3), d(2020, 4, 25)]
    assert parsed(spark, ["3/4/2020", "4/25/2020"]) == [d(2020, 3, 4), d(2020, 4, 25)]
    assert parsed(spark, ["3/4/2020"]) == [d(2020, 3, 4)]
    # Both kinds: what can tell is read as it is, the rest goes by the majority; a tie is month first.
    assert parsed(spark, ["3/4/2020", "25/4/2020", "26/4/2020", "4/27/2020"]) == [
        d(2020, 4, 3), d(2020, 4, 25), d(2020, 4, 26), d(2020, 4, 27)]
    assert parsed(spark, ["3/4/2020", "25/4/2020", "4/27/2020"])[0] == d(2020, 3, 4)
    # Separators are told apart.
    assert parsed(spark, ["3/4/2020", "4/25/2020", "3.4.2020", "25.4.2020"]) == [
        d(2020, 3, 4), d(2020, 4, 25), d(2020, 4, 3), d(2020, 4, 25)]


def test_what_is_no_date(spark):
    texts = [None, "", " ", "x", "2020", "13/13/2020", "2/30/2020", "2/29/2021", "0/1/2020", "2020-13-01", "20201301", "Foo 3, 2020", "Mai 3, 2020",
             "1/2/3/2020", "1/2-2020", "1/2/202", "12020-01-01", "2020-01-01T", "2020-01-01x", "2020-001-01", "4/31/99", "1/2/2020 25"]
    assert parsed(spark, texts) == [None] * len(texts)
    assert parsed(spark, [" 2/29/2020 ", "Sept. 3rd, 2020", "MAY 1st 2021", "31-dec-99"]) == [
        datetime.date(2020, 2, 29), datetime.date(2020, 9, 3), datetime.date(2021, 5, 1), datetime.date(1999, 12, 31)]


def test_years_and_several_columns_in_one_pass(spark):
    df = spark.createDataFrame([("25/1/2019", "1/25/2018", "2017"), ("3/4/2019", "3/4/2018", "Jan 2, 2016")], "a string, b string, c string")
    found = layouts.infer(df, ["a", "b", "c"])
    assert found["a"].day_first["/"] and not found["b"].day_first["/"]
    got = df.select(found["a"].date("a"), found["b"].date("b"), found["c"].year("c")).collect()
    assert [tuple(r) for r in got] == [(datetime.date(2019, 1, 25), datetime.date(2018, 1, 25), 2017),
                                       (datetime.date(2019, 4, 3), datetime.date(2018, 3, 4), 2016)]
    assert layouts.infer(df, []) == {}
    assert layouts.infer(df.where(F.lit(False)), ["a"])["a"].day_first == {"/": False, "-": False, ".": False}
