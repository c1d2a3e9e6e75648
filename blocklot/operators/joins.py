"""Dimension look-ups that broadcast behind a size check, and spreading of small inputs.

``lookup_join`` reads the optimizer's size of a plan. That is an estimate, from
the compressed bytes of the files scanned, so it is multiplied by
``EXPANSION`` before it is compared with the limit; and it only picks the plan,
never the result. Beyond the limit the join is a salted shuffle join, and AQE,
which measures the real size of each shuffled side, may still broadcast it
(``spark.sql.adaptive.autoBroadcastJoinThreshold``).

``fan_out_join`` is the same join for a dimension with many rows a key, where the
time goes into the rows that come out, not into those that go in.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024
#: Bytes in memory per compressed byte on disk that are allowed for.
EXPANSION = 10
#: Rows of a join's result that a task makes, and rows of a dimension packed into one array. Arrays whose length can be
#: divided by 8 repeat on whole bytes in a columnar file; a page of one (20,000 rows in parquet) should hold many of them.
BUILT_ROWS = 10_000_000
PACKED_ROWS = 256
#: Rows of a join's result for a row of the large side, on average, from which on they are put in order for writing.
ORDERED_FAN = 64


def estimated_bytes(df: DataFrame) -> int:
    """Optimizer size estimate of ``df`` in bytes (no job is run)."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin ``df`` over at least ``min_partitions`` tasks when it has fewer.

    A small input file is one scan task; CPU-heavy per-row work (geometry,
    text keys) over it would then run on one core. At scale an input already
    spans thousands of splits and this is a no-op (no shuffle is added).
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    current = df._jdf.rdd().getNumPartitions()
    return df.repartition(target) if current < target else df


def lookup_join(big: DataFrame, dim: DataFrame, big_key: str, dim_key: str,
                max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Left join of a fact table to a dimension on ``big_key == dim_key`` (both columns kept).

    The dimension is broadcast when its estimated size is at most
    ``max_bytes``; beyond that it is a salted shuffle join, so a fact key
    holding a large share of the rows is still split over several tasks
    (a dimension built by an aggregate is not covered by AQE's skew split).
    """
    if estimated_bytes(dim) * EXPANSION <= max_bytes:
        return big.join(F.broadcast(dim), big[big_key] == dim[dim_key], "left")
    from .skew import salted_join
    key_type = big.schema[big_key].dataType
    left = big.withColumn("__lookup", F.col(big_key))
    right = dim.withColumn("__lookup", F.col(dim_key).cast(key_type))
    return salted_join(left, right, ["__lookup"], how="left").drop("__lookup")


def _fan_out(big: DataFrame, dim: DataFrame, big_key: str, dim_key: str) -> tuple[int, int]:
    """Rows of ``big`` and of its left join to ``dim``; no pair is built."""
    big_rows = big.groupBy(F.col(big_key).alias("big_key")).agg(F.count(F.lit(1)).alias("big_rows"))
    dim_rows = dim.where(F.col(dim_key).isNotNull()).groupBy(F.col(dim_key).alias("dim_key")).agg(
        F.count(F.lit(1)).alias("dim_rows"))
    met = big_rows.join(dim_rows, F.col("big_key") == F.col("dim_key"), "left")
    rows, built = met.agg(F.sum("big_rows"), F.sum(F.col("big_rows") * F.coalesce("dim_rows", F.lit(1)))).first()
    return rows or 0, built or 0


def fan_out_join(big: DataFrame, dim: DataFrame, big_key: str, dim_key: str, max_bytes: int = DEFAULT_BROADCAST_BYTES,
                 built_rows: int = BUILT_ROWS, packed_rows: int = PACKED_ROWS) -> DataFrame:
    """``lookup_join`` for a dimension with many rows a key: the same rows, made faster, by more tasks, small when written.

    A broadcast dimension is packed into arrays of ``packed_rows`` of its rows of one
    key, and a row of ``big`` meets arrays, which are expanded then: going through
    an array costs less than going through the hash table row by row. ``big`` is dealt
    over as many tasks as the result has ``built_rows``, unless its scan has that many.
    A task takes one array after the other, each with all of its rows of ``big``: in the result
    the same rows of the dimension come again and again, which a columnar file writes in little space.
    """
    from .skew import free_prefix
    if estimated_bytes(dim) * EXPANSION > max_bytes:
        return lookup_join(big, dim, big_key, dim_key, max_bytes)
    rows, built = _fan_out(big, dim, big_key, dim_key)
    p = free_prefix(big, dim)
    # Numbered and packed in one stage, a key in one task (a dimension that is broadcast is small): a task that is run
    # again makes all arrays of its keys anew.
    place = F.row_number().over(Window.partitionBy(dim_key).orderBy(
        *[f.name for f in dim.schema if isinstance(f.dataType, AtomicType)]))
    packed = (dim.where(F.col(dim_key).isNotNull())
              .withColumn(f"{p}part", F.floor((place - 1) / packed_rows))
              .groupBy(F.col(dim_key).alias(f"{p}key"), f"{p}part")
              .agg(F.collect_list(F.struct(*dim.columns)).alias(f"{p}rows")))
    parts = dim.where(F.col(dim_key).isNotNull()).groupBy(F.col(dim_key).alias(f"{p}match")).agg(
        F.ceil(F.count(F.lit(1)) / packed_rows).alias(f"{p}parts"))
    if built > built_rows:
        big = spread(big, ceil(built / built_rows))
    each = (big.join(F.broadcast(parts), big[big_key] == parts[f"{p}match"], "left")
            .withColumn(f"{p}at", F.explode(F.sequence(F.lit(0), F.coalesce(f"{p}parts", F.lit(1)) - 1)))
            .drop(f"{p}match", f"{p}parts"))
    if built >= ORDERED_FAN * rows:
        # The filter, which every row passes, is there because the optimizer drops a sort right below a join.
        each = each.sortWithinPartitions(big_key, f"{p}at").where(F.monotonically_increasing_id() >= 0)
    met = (each[big_key] == packed[f"{p}key"]) & (each[f"{p}at"] == packed[f"{p}part"])
    joined = each.join(F.broadcast(packed), met, "left")
    return joined.select("*", F.inline_outer(f"{p}rows")).drop(*[p + c for c in ("at", "key", "part", "rows")])
