"""The raw (ingest) layer: stand-in source tables written once as parquet.

The pipelines read raw housing tables (and polygon layers) the way the
source job reads its warehouse ``ingest`` dataset and its boundary files. Here those tables are derived from the driver
tables by a Spark job and written once per application into the shared
scratch folder; every query then scans plain parquet columns (column
pruning, predicate pushdown and small generated code, instead of re-deriving
each raw column inside every filter the optimizer pushes down).
"""

from __future__ import annotations

import hashlib
import threading
from functools import partial
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.joins import spread
from ..session import scratch_path
from . import layers, messy, standins

_LOCK = threading.Lock()
_WRITTEN: dict[tuple[str, str, str], str] = {}

DERIVATIONS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "housing_jobs": standins.housing_jobs,
    "affordable_buildings": standins.affordable_buildings,
    "raw_keys": messy.raw_keys,
    "area_layer": layers.area_layer,
    "zone_layer": layers.zone_layer,
    **{f"{name}_layer": partial(layers.district_layer, name=name) for name in layers.DISTRICTS},
}


def _tag(spark: SparkSession, sf_dir: str) -> str:
    """A name that changes when the files of ``sf_dir`` do, whatever store they are in."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = sorted((x.getPath().getName(), x.getModificationTime(), x.getLen()) for x in fs.listStatus(where))
    return hashlib.sha1(repr((sf_dir, found)).encode()).hexdigest()[:16]


def ingest_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The raw table ``name`` for ``sf_dir``, written on first use in this application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    with _LOCK:
        path = _WRITTEN.get(key)
        if path is None:
            path = scratch_path(spark, "ingest", _tag(spark, sf_dir), name)
            spread(DERIVATIONS[name](spark, sf_dir)).write.mode("overwrite").parquet(path)
            _WRITTEN[key] = path
    return spark.read.parquet(path)


def housing_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_table(spark, sf_dir, "housing_jobs")


def affordable_buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_table(spark, sf_dir, "affordable_buildings")


def raw_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_table(spark, sf_dir, "raw_keys")


def area_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_table(spark, sf_dir, "area_layer")


def zone_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_table(spark, sf_dir, "zone_layer")


def district_layer(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ingest_table(spark, sf_dir, f"{name}_layer")


__all__ = ["district_layer", "ingest_table", "housing_jobs", "affordable_buildings", "raw_keys", "area_layer", "zone_layer"]
