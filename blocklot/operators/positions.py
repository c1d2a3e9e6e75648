"""Places of rows in an order, without bringing a group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written


def numbered(df: DataFrame, order: Sequence[str], name: str, group: Sequence[str] = ()) -> DataFrame:
    """``df`` with ``name``: the place (from 0) of each row in the order of ``order`` within its ``group``.

    Rows are range-partitioned by (group, order) and written. A row's place is its place in its
    partition and group, a window over what one task holds, plus the group's rows in the
    partitions before, from one count per (partition, group). Rows that are equal in ``order`` get
    different places, in any order among themselves.
    """
    part, own, base = (f"{name}_{x}" for x in ("part", "own", "base"))
    by = [F.col(c) for c in [*group, *order]]
    dealt = written(df.repartitionByRange(*by).withColumn(part, F.spark_partition_id()), "dealt")
    within = Window.partitionBy(part, *group).orderBy(*[F.col(c) for c in order])
    counts = dealt.groupBy(part, *group).agg(F.count(F.lit(1)).alias(own))
    before = Window.partitionBy(*[F.col(g) for g in group]) if group else Window.partitionBy()
    before = before.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # one row for each partition of the range sort
    bases = counts.select(part, *group, F.coalesce(F.sum(own).over(before), F.lit(0)).alias(base))
    ranked = dealt.withColumn(own, F.row_number().over(within) - 1)
    on: Column = F.col(f"a.{part}") == F.col(f"b.{part}")
    for g in group:
        on = on & F.col(f"a.{g}").eqNullSafe(F.col(f"b.{g}"))
    return ranked.alias("a").join(bases.alias("b"), on).select(
        *[F.col(f"a.`{c}`") for c in df.columns], (F.col(f"a.{own}") + F.col(f"b.{base}")).alias(name))
