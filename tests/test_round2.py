"""Edge semantics: strict years, wide integer keys, safe table replacement, hashed samples."""

import uuid

import pytest
from pyspark.sql import functions as F

from blocklot.functions import dates, keys
from blocklot.operators import preview
from blocklot.session import scratch_path
from blocklot.sources import tables


@pytest.mark.parametrize("text,year", [("1/5/2020", 2020), (" 1/5/2020", None), ("1/5/2020 ", None), ("13/1/2020", None),
                                       ("2015", None), (None, None)])
def test_strict_year_takes_no_spaces(spark, text, year):
    df = spark.createDataFrame([(text,)], "d string")
    assert df.select(dates.strict_year("d")).first()[0] == year
    padded = text.strip() if text and text.strip() == "1/5/2020" else None
    if padded:
        assert df.select(dates.any_year("d")).first()[0] == 2020


@pytest.mark.parametrize("value", [9007199254740993, -9007199254740993, 9223372036854775807, 0, None])
def test_integer_keys_pass_through(spark, value):
    df = spark.createDataFrame([(value,)], "k bigint")
    t = df.schema["k"].dataType
    row = df.select(keys.int_key("k", t), keys.truncated_int("k", t), keys.int_key_text("k", t)).first()
    assert tuple(row) == (value, value, None if value is None else str(value))


def test_failed_replace_leaves_the_old_table(spark):
    path = scratch_path(spark, "t", uuid.uuid4().hex)
    tables.replace_table(spark.createDataFrame([(1,)], "a bigint"), path)
    broken = spark.range(10).select(F.when(F.col("id") == 7, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).alias("a"))
    with pytest.raises(Exception, match="broken"):
        tables.replace_table(broken, path)
    assert [tuple(r) for r in tables.read_replaced(spark, path).collect()] == [(1,)]
    for k in range(4):
        tables.replace_table(spark.createDataFrame([(k, "x")], "b bigint, c string"), path)
        assert [tuple(r) for r in tables.read_replaced(spark, path).collect()] == [(k, "x")]
    with pytest.raises(FileNotFoundError):
        tables.read_replaced(spark, path + "-none")


def test_sample_is_no_lattice_and_takes_any_key(spark):
    df = spark.range(10_000).withColumn("name", F.concat(F.lit("n"), F.col("id")))
    ids = sorted(r.id for r in preview.seeded_sample(df, 100, "id", seed=3).collect())
    gaps = {b - a for a, b in zip(ids, ids[1:])}
    assert len(ids) == 100 and len(gaps) > 40
    assert ids == sorted(r.id for r in preview.seeded_sample(df.repartition(7), 100, "id", seed=3).collect())
    assert len(preview.seeded_sample(df, 5, "name").collect()) == 5
