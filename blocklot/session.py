"""Spark session defaults and the shared scratch folder.

Everything in the library works on a caller's session; ``get_session`` is a
convenience for scripts and tests. The settings that matter at scale are the
AQE ones: partition coalescing, runtime broadcast conversion (which measures
the real size of a shuffled side before broadcasting it) and skew-join
splitting of oversized shuffle partitions.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str = "local[*]", shuffle_partitions: int = 8,
                app_name: str = "blocklot", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", "8g")
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for written intermediates and reliable checkpoints.

    On a cluster this is the folder named by ``spark.checkpoint.dir`` (a
    shared file system every executor can reach). Only when that setting is
    absent and the master is ``local`` (one machine, as in tests), a private
    folder is made and registered, so ``DataFrame.checkpoint()`` works the same
    way in both settings; on a cluster a missing setting is an error.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="blocklot-scratch-")
    sc.setCheckpointDir(conf_dir)
    return sc._jsc.sc().getCheckpointDir().get()


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared scratch folder (not created here)."""
    return os.path.join(scratch_dir(spark), *parts)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.

    Cuts the lineage: what reads it reads files, a lost executor costs no earlier
    step, and a plan that uses it several times doesn't compute it several times.
    The files belong to the application; who owns ``spark.checkpoint.dir`` removes
    them when it has ended.
    """
    path = scratch_path(df.sparkSession, "written", f"{label}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
