"""Table scans and sinks (parquet, CSV) with explicit schemas.

Scans stay lazy: callers select columns and filter afterwards and Catalyst
pushes both into the parquet reader (``ReadSchema`` / ``PushedFilters``).
A replaced table is a series of versions; only a complete one is ever read.
"""

from __future__ import annotations

import os
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Full table scan of one driver table (column pruning happens downstream)."""
    return spark.read.parquet(table_path(sf_dir, name))


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Header CSV scan with a declared schema (keys stay text, no inference pass)."""
    return (spark.read.option("header", True).option("mode", "PERMISSIVE")
            .option("nullValue", "").schema(schema).csv(path))


def write_csv(df: DataFrame, path: str) -> str:
    """Header CSV sink, replacing what is at ``path``."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def _filesystem(spark: SparkSession, path: str):
    """(Hadoop file system, Hadoop path) of ``path``."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


#: A version's marker, and the folders that loads write to.
READY, DATA = "_ready-", "load-"
#: How long a replaced version can still be read, at least.
KEEP_SECONDS = 3600.0


def _create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Creates a small file unless it exists; whether this call made it.

    Creation is atomic: on HDFS by the name node, on a local file system by the
    operating system. On an object store it takes one with conditional writes.
    """
    fs, where = _filesystem(spark, path)
    jvm = spark.sparkContext._jvm
    try:
        if fs.getUri().getScheme() == "file":
            jvm.java.nio.file.Files.createFile(
                jvm.java.nio.file.Paths.get(fs.makeQualified(where).toUri().getPath(), spark.sparkContext._gateway.new_array(jvm.String, 0)),
                spark.sparkContext._gateway.new_array(jvm.java.nio.file.attribute.FileAttribute, 0))
            stream = fs.create(where, True)
        else:
            stream = fs.create(where, False)
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    stream.write(bytearray(text.encode()))
    stream.close()
    return True


def _read_text(spark: SparkSession, path: str) -> str:
    fs, where = _filesystem(spark, path)
    stream = fs.open(where)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions that were published or are about to be, in order."""
    fs, where = _filesystem(spark, path)
    if not fs.exists(where):
        return []
    names = [x.getPath().getName() for x in fs.listStatus(where)]
    return sorted(int(n[len(READY):]) for n in names if n.startswith(READY))


def load(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    """Writes ``df`` to a folder of its own below ``path``; its name. Nobody reads it before ``publish``."""
    spark, name = df.sparkSession, f"{DATA}{uuid.uuid4().hex}"
    target = os.path.join(path, name)
    writer = df.write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.save(target)
    except Exception:
        fs, where = _filesystem(spark, target)
        fs.delete(where, True)
        raise
    return name


def publish(spark: SparkSession, path: str, name: str, keep_seconds: float = KEEP_SECONDS) -> int:
    """Makes the folder ``name`` the table at ``path``; its version.

    The version's marker is created only if it is not there, with the next number
    where another load was faster: every load gets a version of its own, and the one that
    is published last is the table. Older versions are kept for readers that have begun on them: the
    one before always, the others until they have been replaced for ``keep_seconds``.
    """
    known = _versions(spark, path)
    number = (known[-1] if known else 0) + 1
    while not _create_new(spark, os.path.join(path, f"{READY}{number}"), name):
        number += 1
    done = [n for n in _versions(spark, path) if n < number and _folder(spark, path, n)]
    for old, newer in zip(done, done[1:]):
        fs, marker = _filesystem(spark, os.path.join(path, f"{READY}{newer}"))
        if not fs.exists(marker) or time.time() - fs.getFileStatus(marker).getModificationTime() / 1000 < keep_seconds:
            continue
        for what in (f"{READY}{old}", _folder(spark, path, old)):
            fs, where = _filesystem(spark, os.path.join(path, what))
            fs.delete(where, True)
    return number


def _folder(spark: SparkSession, path: str, number: int) -> str:
    """The data folder of a version; empty while its marker is being written, or if another load has removed it."""
    try:
        return _read_text(spark, os.path.join(path, f"{READY}{number}"))
    except Py4JJavaError as e:
        if "FileNotFound" in e.java_exception.getClass().getName():
            return ""
        raise


def replace_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  keep_seconds: float = KEEP_SECONDS) -> str:
    """Replace-table sink: the old table can be read until the new one is complete.

    Several loads may run at once: each writes to a folder that only it knows, and
    publishes it by one atomic step. A load that fails leaves the table as it was.
    """
    publish(df.sparkSession, path, load(df, path, partition_by), keep_seconds)
    return path


def read_replaced(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table written by ``replace_table``, whole: later loads don't change what is read."""
    for number in reversed(_versions(spark, path)):
        name = _folder(spark, path, number)
        if name:  # a marker without a name: a load that is not published yet, or was killed there
            return spark.read.parquet(os.path.join(path, name))
    raise FileNotFoundError(f"no complete table at {path}")
