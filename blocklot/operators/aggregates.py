"""Grouped sums, reconciliation totals and units redistribution.

Group sums follow the source semantics: rows with a NULL group key are left
out and the sum of a group whose values are all NULL is 0.

Redistribution is written as aggregate-then-join, not as a window over the
project: the per-project sum is a partial (map-side) aggregate, so a project
holding a third of all rows costs one row per map task in the shuffle. The
join back to the one-row-per-project sums is a ``salted_join``: a project
with more than ``rows_per_task`` buildings is split over several tasks (AQE's
own skew split does not apply to a join fed by an aggregate). AQE still
turns it into a broadcast join when the measured sums are small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .relational import drop_null_keys
from .skew import HOT_KEY_ROWS, salted_join


def zero_sum(c) -> Column:
    """Sum where an all-NULL (or empty) group gives 0."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.sum(col), F.lit(0))


def group_sums(df: DataFrame, keys: Sequence[str], sums: dict[str, str],
               order: bool = False) -> DataFrame:
    """``groupBy(keys)`` with named zero-sums; rows with any NULL key dropped."""
    out = (drop_null_keys(df, keys).groupBy(*keys)
           .agg(*[zero_sum(src).alias(name) for name, src in sums.items()]))
    return out.orderBy(*keys) if order else out


def grand_totals(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row of zero-sums over ``columns``."""
    return df.agg(*[zero_sum(c).alias(c) for c in columns])


def missing_key_sums(df: DataFrame, group: str, lot: str, measure: str,
                     out: str = "missing_units") -> DataFrame:
    """Per group, the sum of ``measure`` over rows whose ``lot`` is NULL."""
    return (df.where(F.col(lot).isNull() & F.col(group).isNotNull())
            .groupBy(group).agg(zero_sum(measure).alias(out)))


def redistribute_missing(df: DataFrame, group: str = "Project_ID", lot: str = "BBL",
                         measure: str = "All_Counted_Units", rows_per_task: int = HOT_KEY_ROWS) -> DataFrame:
    """Move the measure of rows without a lot onto the group's rows with a lot.

    Each row with a lot gets the group's whole missing sum added (so a group
    with several lots counts it several times); rows without a lot are
    dropped, and so is the measure of groups with no lot at all.
    """
    missing = missing_key_sums(df, group, lot, measure, "__missing")
    kept = df.where(F.col(lot).isNotNull())
    joined = salted_join(kept, missing, [group], how="left", rows_per_task=rows_per_task, other_unique=True)
    cols = [(F.col(c) + F.coalesce(F.col("__missing"), F.lit(0))).alias(c) if c == measure else F.col(c)
            for c in df.columns]
    return joined.select(cols)


def units_reconciliation(before: DataFrame, after: DataFrame, lot: str = "BBL",
                         measure: str = "All_Counted_Units") -> DataFrame:
    """One-row report: rows and measure totals before and after redistribution."""
    tagged = (before.select(F.lit(True).alias("__before"), F.col(lot), F.col(measure))
              .unionByName(after.select(F.lit(False).alias("__before"), F.col(lot), F.col(measure))))
    is_before, has_lot = F.col("__before"), F.col(lot).isNotNull()
    return tagged.agg(
        F.count_if(is_before).alias("rows_before"),
        zero_sum(F.when(is_before, F.col(measure))).alias("units_before"),
        F.count_if(is_before & has_lot).alias("rows_with_lot_before"),
        zero_sum(F.when(is_before & has_lot, F.col(measure))).alias("units_with_lot_before"),
        F.count_if(~is_before).alias("rows_after"),
        zero_sum(F.when(~is_before, F.col(measure))).alias("units_after"))
