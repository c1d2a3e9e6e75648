"""Duplicate and gap counts of a table that grows load by load.

The state is one row per different row of the table so far: a 128-bit hash, how often the row
came and whether it has a gap. It is stored as a table bucketed and sorted by the hash.
A load is hashed and counted on its own (combined before its shuffle) and merged bucket by bucket: only the load
is shuffled, into the buckets of the state; the stored side is read where it lies, without an
exchange or a sort. So a load costs its own size in shuffles, and one pass over 33 bytes a row of state.

Rows are told apart by their hash alone: two 64-bit hashes with different seeds, which two different
rows of 2**48 share with a probability of about 2**-33. ``profile.dataset_checks`` compares whole
rows; it reads the whole table each time.

Every merge writes a new version beside the old one, so a load that fails or is repeated leaves the
state as it was. The versions are tables over the shared scratch folder, or ``folder``.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .profile import missing_value

HASH = ("hash_a", "hash_b")


def row_hashes(df: DataFrame) -> DataFrame:
    """(hash_a, hash_b, gap) of each row of ``df``."""
    gap = F.lit(False)
    for c in df.columns:
        gap = gap | missing_value(df, c)
    columns = [F.col(f"`{c}`") for c in df.columns]
    return df.select(F.xxhash64(*columns).alias("hash_a"), F.xxhash64(F.lit(1), *columns).alias("hash_b"), gap.alias("gap"))


class DuplicateState:
    """Counts of the different rows of a table, over all loads so far."""

    def __init__(self, spark: SparkSession, columns: Sequence[str], buckets: int = 64, folder: str | None = None):
        self.spark, self.columns, self.buckets = spark, list(columns), buckets
        self.folder = folder or scratch_path(spark, "duplicates")
        self.name: str | None = None

    def _save(self, rows: DataFrame) -> None:
        name = f"duplicates_{uuid.uuid4().hex}"
        (rows.select(*HASH, "n", "gap").write.format("parquet").option("path", f"{self.folder}/{name}")
         .bucketBy(self.buckets, *HASH).sortBy(*HASH).saveAsTable(name))
        self.name = name

    def table(self) -> DataFrame:
        if self.name is None:
            return self.spark.createDataFrame([], "hash_a bigint, hash_b bigint, n bigint, gap boolean")
        return self.spark.table(self.name)

    def merged(self, load: DataFrame) -> DataFrame:
        """The state after ``load``, not yet written."""
        if load.columns != self.columns:
            raise ValueError(f"a load has the columns {self.columns}, not {load.columns}")
        own = row_hashes(load).groupBy(*HASH).agg(F.count(F.lit(1)).alias("n"), F.max("gap").alias("gap"))
        if self.name is None:
            return own
        new = own.select(*HASH, F.col("n").alias("more"), F.col("gap").alias("new_gap"))
        return self.table().join(new, list(HASH), "full").select(
            *HASH, (F.coalesce("n", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("n"),
            F.coalesce("gap", "new_gap").alias("gap"))

    def add(self, load: DataFrame) -> DuplicateState:
        """Merges ``load`` into the state."""
        self._save(self.merged(load))
        return self

    def report(self) -> DataFrame:
        """One row: total rows, rows in duplicate groups (all copies), rows with a gap, columns."""
        n = F.col("n")
        return self.table().agg(
            F.coalesce(F.sum(n), F.lit(0)).alias("total_rows"),
            F.coalesce(F.sum(F.when(n > 1, n)), F.lit(0)).alias("duplicated_rows"),
            F.coalesce(F.sum(F.when(F.col("gap"), n)), F.lit(0)).alias("rows_with_missing"),
            F.lit(len(self.columns)).cast("bigint").alias("columns"))
