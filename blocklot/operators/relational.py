"""Row filters, column helpers and the key join used by every pipeline.

Null rules follow the source tables' semantics, not SQL's defaults:
``exclude_value`` keeps rows whose value is NULL (a plain ``!=`` would drop
them), and ``key_join(null_safe=True)`` lets NULL keys match each other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FractionalType

from .skew import split_join


def not_missing(df: DataFrame, column: str) -> Column:
    """``column`` is neither NULL nor (for floating types) NaN."""
    c = F.col(column)
    if isinstance(df.schema[column].dataType, FractionalType):
        return c.isNotNull() & ~F.isnan(c)
    return c.isNotNull()


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows with NULL (or NaN) in any of ``keys``.

    Written as ``IsNotNull`` conjuncts rather than ``dropna``: those reach the
    parquet reader as pushed filters (row groups without values are skipped),
    which the ``AtLeastNNonNulls`` predicate of ``dropna`` does not.
    """
    cond = None
    for k in keys:
        term = not_missing(df, k)
        cond = term if cond is None else cond & term
    return df.where(cond) if cond is not None else df


def exclude_value(df: DataFrame, column: str, value) -> DataFrame:
    """Rows whose ``column`` is not ``value``; NULLs are kept."""
    return df.where(~F.col(column).eqNullSafe(F.lit(value)))


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename by map; names that are not present are ignored."""
    present = {old: new for old, new in mapping.items() if old in df.columns}
    return df.withColumnsRenamed(present) if present else df


def fill_labels(df: DataFrame, label: str = "Unknown") -> DataFrame:
    """Every NULL becomes ``label``: non-text columns are cast to text first."""
    return df.select([F.coalesce(F.col(c).cast("string"), F.lit(label)).alias(c) for c in df.columns])


def columns_not_in(right: DataFrame, left: DataFrame) -> list[str]:
    """Columns of ``right`` that ``left`` does not have (case-insensitive)."""
    have = {c.lower() for c in left.columns}
    return [c for c in right.columns if c.lower() not in have]


def check_key_types(left: DataFrame, right: DataFrame, left_keys: Sequence[str],
                    right_keys: Sequence[str]) -> None:
    """Raise when paired join keys have different types."""
    for lk, rk in zip(left_keys, right_keys):
        lt, rt = left.schema[lk].dataType, right.schema[rk].dataType
        if lt != rt:
            raise TypeError(f"join key types differ: {lk} {lt.simpleString()} vs {rk} {rt.simpleString()}")


def _equal(a: Column, b: Column, null_safe: bool) -> Column:
    return a.eqNullSafe(b) if null_safe else a == b


def key_join(left: DataFrame, right: DataFrame, on: Sequence[str] | None = None, *,
             left_on: Sequence[str] | None = None, right_on: Sequence[str] | None = None,
             how: str = "left", suffixes: tuple[str, str] = ("_x", "_y"),
             null_safe: bool = False, check_types: bool = False,
             skew_rows: int | None = None) -> DataFrame:
    """Equi-join with one output column per shared key and suffixed overlaps.

    ``on`` names keys present on both sides (kept once, from the left for a
    left join). ``left_on``/``right_on`` pair keys with different names; both
    are kept. Other columns present on both sides get ``suffixes`` (names are
    compared case-insensitively, as Spark's resolver does). Key equality stays
    a hash-able equi-condition, null-safe or not, so the planner can pick a
    broadcast-hash or sort-merge join. With ``skew_rows``, a key holding more
    rows than that on either side is split over several tasks
    (``skew.split_join``); for inner and left-type joins only.
    """
    if on is not None:
        left_keys = right_keys = list(on)
    else:
        left_keys, right_keys = list(left_on), list(right_on)
    if check_types:
        check_key_types(left, right, left_keys, right_keys)
    shared = {k.lower() for k in left_keys} if on is not None else set()
    left_lower = {c.lower(): c for c in left.columns}
    right_lower = {c.lower(): c for c in right.columns}
    overlap = {n for n in left_lower if n in right_lower and n not in shared}

    def out_name(name: str, side: int) -> str:
        return name + suffixes[side] if name.lower() in overlap else name

    lsel = [F.col(c).alias(f"__l{i}") for i, c in enumerate(left.columns)]
    rsel = [F.col(c).alias(f"__r{i}") for i, c in enumerate(right.columns)]
    la, ra = left.select(lsel), right.select(rsel)
    lidx = {c: i for i, c in enumerate(left.columns)}
    ridx = {c: i for i, c in enumerate(right.columns)}
    cond = None
    for lk, rk in zip(left_keys, right_keys):
        term = _equal(F.col(f"__l{lidx[lk]}"), F.col(f"__r{ridx[rk]}"), null_safe)
        cond = term if cond is None else cond & term
    if skew_rows:
        joined = split_join(la, ra, [f"__l{lidx[k]}" for k in left_keys], [f"__r{ridx[k]}" for k in right_keys],
                            how, null_safe, skew_rows)
    else:
        joined = la.join(ra, cond, how)
    if how in ("left_semi", "left_anti", "semi", "anti", "leftsemi", "leftanti"):
        return joined.select([F.col(f"__l{i}").alias(c) for i, c in enumerate(left.columns)])
    out = []
    for i, c in enumerate(left.columns):
        if on is not None and c.lower() in shared and how in ("right", "outer", "full"):
            rk = right_keys[[k.lower() for k in left_keys].index(c.lower())]
            expr = F.coalesce(F.col(f"__l{i}"), F.col(f"__r{ridx[rk]}"))
        else:
            expr = F.col(f"__l{i}")
        out.append(expr.alias(out_name(c, 0)))
    for i, c in enumerate(right.columns):
        if on is not None and c.lower() in shared:
            continue
        out.append(F.col(f"__r{i}").alias(out_name(c, 1)))
    return joined.select(out)


def unmatched_rows(left: DataFrame, right: DataFrame, on: Sequence[str], null_safe: bool = False,
                   skew_rows: int | None = None) -> DataFrame:
    """Left rows with no partner on the right (anti join)."""
    return key_join(left, right, on, how="left_anti", null_safe=null_safe, skew_rows=skew_rows)


def distinct_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.select(a, b).distinct()
