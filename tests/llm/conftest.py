import os

import duckdb
import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for name in ("documents", "benchmark", "labels", "pages", "conversations", "embeddings"):
        con.sql(f"create view {name} as select * from '{SMALL}/{name}.parquet'")
    return con


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, with columns whose names clash with the operators' own."""
    def make(rows, lang="en"):
        return spark.createDataFrame([(i, t, lang, "src", len(t or ""), "x", 1) for i, t in rows],
                                     "doc_id long, text string, lang string, source string, n_chars long, "
                                     "digest string, FP int")
    return make


@pytest.fixture
def rows_of():
    def get(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)
    return get
