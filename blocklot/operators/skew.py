"""Joins that stay spread out when one key holds a large share of the rows of either side.

AQE's skew-join rule only splits a join whose inputs are plain shuffles, and
of a left outer join only the left side; a join back to an aggregate
(redistribution) is not covered at all. ``split_join`` handles hot keys
explicitly:

1. each side is counted per key by one aggregate over the key columns (combined
   before its shuffle); keys with more than ``rows_per_task`` rows are hot and get
   ``ceil(rows / rows_per_task)`` splits. At most ``rows / rows_per_task`` keys
   of a side qualify, so the list has a proven bound; it is collected once and
   broadcast. A side that has each key once (an aggregate by the key) needs no count, the
   caller says so. Without hot keys the join is the plain join;
2. rows of a hot key get a salt on their own side and are repeated once per
   salt of the other side: a key that is hot on both sides becomes a grid of
   (left splits x right splits) tasks;
3. the join runs on (keys, salts). A pair of rows meets in exactly one place.

*Salts survive a lost executor.* The salt comes from a row number, so equal rows are
spread too. A number drawn while the plan runs would differ when a task is run again on
rows that a shuffle brought in another order; some pairs would then be lost and others
doubled. So a side with hot keys is written once with its numbers, and every task, first or
repeated, reads them back. The written copy also spares the side's plan a further run.

A left outer join must not report a left row as unmatched because it met an
empty salt: keys that are hot on the right exist there, so their left rows all
match, and are joined in an inner join of their own.

Helper columns get names that the tables don't have.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import written

HOT_KEY_ROWS = 2_000_000
SEMI = ("left_semi", "semi", "leftsemi")
ANTI = ("left_anti", "anti", "leftanti")
LEFT = ("left", "left_outer", "leftouter")


def free_prefix(*tables: DataFrame) -> str:
    """A prefix that no column of ``tables`` has (names compare without case, as Spark does)."""
    names = [c.lower() for t in tables for c in t.columns]
    prefix = "__"
    while any(c.startswith(prefix) for c in names):
        prefix += "_"
    return prefix


def hot_keys(df: DataFrame, keys: Sequence[str], rows_per_task: int = HOT_KEY_ROWS, splits: str = "__splits") -> DataFrame:
    """Keys of ``df`` with more than ``rows_per_task`` rows, and their split count."""
    n = free_prefix(df) + "rows"
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n)).where(F.col(n) > rows_per_task)
    return counts.select(*keys, F.ceil(F.col(n) / F.lit(rows_per_task)).cast("int").alias(splits))


def _hot_list(df: DataFrame, keys: Sequence[str], rows_per_task: int) -> dict[tuple, int]:
    found = hot_keys(df.select(*keys), keys, rows_per_task).collect()
    return {tuple(r)[:-1]: tuple(r)[-1] for r in found}


def _numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` written with a number for each row, which stays whatever task reads it."""
    return written(df.withColumn(name, F.monotonically_increasing_id()), "numbered")


def _salted(df: DataFrame, keys: Sequence[str], table: DataFrame, own: str, other: str, own_hot: bool = True,
            prefix: str = "__") -> DataFrame:
    """``df`` with ``l`` and ``r`` salts (behind ``prefix``), its own drawn and the other side's repeated, and ``r_hot``."""
    number, splits = prefix + "id", {s: F.coalesce(F.col(f"{prefix}{s}_splits"), F.lit(1)) for s in ("l", "r")}
    rows = _numbered(df, number) if own_hot else df.withColumn(number, F.lit(0))
    # Null-safe on purpose: a hot group of NULL keys is spread too, even in a
    # join where NULL matches nothing (the salts never change which rows meet).
    cond = None
    for i, k in enumerate(keys):
        term = F.col(k).eqNullSafe(F.col(f"{prefix}hot{i}"))
        cond = term if cond is None else cond & term
    return rows.join(F.broadcast(table), cond, "left").select(
        *df.columns, (splits["r"] > 1).alias(f"{prefix}r_hot"),
        F.pmod(F.col(number), splits[own]).cast("int").alias(f"{prefix}{own}"),
        F.explode(F.sequence(F.lit(0), splits[other] - 1)).alias(f"{prefix}{other}"))


def split_join(left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str],
               how: str = "inner", null_safe: bool = False, rows_per_task: int = HOT_KEY_ROWS,
               right_unique: bool = False) -> DataFrame:
    """``left.join(right, keys, how)`` with hot keys of both sides split over several tasks.

    ``how`` is inner or a left-type join. The two sides share no column name;
    all columns of both are kept (of ``left`` only, in a semi or anti join).
    ``right_unique`` says that ``right`` has each key once, so it is not counted.
    """
    if how in SEMI + ANTI:
        right, right_unique = right.select(*right_keys).distinct(), True
    hot_left = _hot_list(left, left_keys, rows_per_task)
    hot_right = {} if right_unique else _hot_list(right, right_keys, rows_per_task)
    if not null_safe:
        hot_right = {k: n for k, n in hot_right.items() if None not in k}
    on = None
    for lk, rk in zip(left_keys, right_keys):
        term = F.col(lk).eqNullSafe(F.col(rk)) if null_safe else F.col(lk) == F.col(rk)
        on = term if on is None else on & term
    if not hot_left and not hot_right:
        return left.join(right, on, how)
    p = free_prefix(left, right)
    kinds = ", ".join(f"{p}hot{i} {left.schema[k].dataType.simpleString()}" for i, k in enumerate(left_keys))
    table = left.sparkSession.createDataFrame(
        [(*k, hot_left.get(k, 1), hot_right.get(k, 1)) for k in hot_left.keys() | hot_right.keys()],
        f"{kinds}, {p}l_splits int, {p}r_splits int")
    ls = _salted(left, left_keys, table, "l", "r", bool(hot_left), p)
    rs = _salted(right, right_keys, table, "r", "l", bool(hot_right), p).select(
        *right.columns, F.col(f"{p}r_hot").alias(f"{p}hot_too"), F.col(f"{p}l").alias(f"{p}l2"), F.col(f"{p}r").alias(f"{p}r2"))
    on = on & (F.col(f"{p}l") == F.col(f"{p}l2")) & (F.col(f"{p}r") == F.col(f"{p}r2"))
    if how in LEFT and hot_right:
        rest = ls.where(~F.col(f"{p}r_hot")).join(rs.where(~F.col(f"{p}hot_too")), on, how)
        joined = rest.unionByName(ls.where(F.col(f"{p}r_hot")).join(rs.where(F.col(f"{p}hot_too")), on, "inner"))
    else:
        joined = ls.join(rs, on, how)
    return joined.select(*left.columns, *([] if how in SEMI + ANTI else right.columns))


def salted_join(big: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "left",
                null_safe: bool = False, rows_per_task: int = HOT_KEY_ROWS, other_unique: bool = False) -> DataFrame:
    """``big.join(other, keys, how)`` with hot keys split over several tasks (``split_join``).

    Shared key columns appear once, from ``big``.
    """
    p = free_prefix(big, other) + "o_"
    renamed = other.select(*[F.col(c).alias(f"{p}{c}") for c in other.columns])
    joined = split_join(big, renamed, keys, [f"{p}{k}" for k in keys], how, null_safe, rows_per_task, other_unique)
    if how in SEMI + ANTI:
        return joined
    rest = [c for c in other.columns if c not in keys]
    return joined.select(*big.columns, *[F.col(f"{p}{c}").alias(c) for c in rest])
