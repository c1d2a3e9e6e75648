"""Previews and samples: first rows, first row transposed, seeded sample.

All three keep a limit because showing a few rows is the feature. Ordering
makes them repeatable; ``orderBy(...).limit(n)`` plans as a top-n
(``TakeOrderedAndProject``): each partition keeps n rows, no full sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def head(df: DataFrame, n: int = 20, order_by: Sequence[str] | None = None) -> DataFrame:
    ordered = df.orderBy(*order_by) if order_by else df
    return ordered.limit(n)


def first_row_transposed(df: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """The first row as ``(column, value)`` text pairs, in column order."""
    first = head(df, 1, order_by)
    as_text = first.select([F.col(c).cast("string").alias(c) for c in df.columns])
    pairs = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), F.col(c).alias("value"))
                      for i, c in enumerate(df.columns)])
    return as_text.select(F.inline(pairs))


def sample_rank(key: str, seed: int) -> Column:
    """A repeatable pseudo-random rank of a key of any type: neighbouring keys land far apart."""
    return F.md5(F.concat_ws(":", F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(str(seed))).cast("binary"))


def seeded_sample(df: DataFrame, n: int, key: str, seed: int = 0) -> DataFrame:
    """n rows picked by a seeded hash of ``key`` (same rows on every run)."""
    return df.withColumn("__rank", sample_rank(key, seed)).orderBy("__rank", key).limit(n).drop("__rank")
