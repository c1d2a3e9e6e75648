"""Table profile: dataset checks and one row per column.

Two aggregate passes over the table, whatever its width or size:

1. one ``agg`` with, per column, the NULL count, an HLL distinct estimate,
   min/max and (numeric columns) mean and population standard deviation;
2. one ``agg`` with exact distinct sets, only for columns whose estimate is
   small (so the set is bounded), and the z-score outlier counts.

Only the one-row result of pass 1 (a few numbers per column) comes back to
the driver, to become literals of pass 2. Duplicate rows are counted with a
group-by on two 64-bit hashes of the row; only rows that share both are compared
whole. Partial aggregation collapses repeated rows before either shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DateType, FractionalType, NumericType, StringType,
                               TimestampNTZType, TimestampType)

MAX_LISTED = 10          # a column with at most this many values (NULL counts as one) is listed
CANDIDATE_ESTIMATE = 100  # HLL estimate under which exact distinct sets are collected
Z_LIMIT = 3.0


def missing_value(df: DataFrame, name: str) -> Column:
    c = F.col(name)
    if isinstance(df.schema[name].dataType, FractionalType):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def _null_text(dtype) -> str:
    return "nan" if isinstance(dtype, NumericType) else "None"


def dataset_checks(df: DataFrame) -> DataFrame:
    """One row: total rows, rows in duplicate groups (all copies), rows with a gap, columns."""
    any_missing = None
    for c in df.columns:
        m = missing_value(df, c)
        any_missing = m if any_missing is None else (any_missing | m)
    # 16 bytes a row instead of the whole row; rows that share both hashes are then compared whole.
    hashed = df.select(F.xxhash64(*df.columns).alias("__h1"), F.xxhash64(F.lit(1), *df.columns).alias("__h2"),
                       any_missing.cast("int").alias("__gap"))
    groups = hashed.groupBy("__h1", "__h2").agg(F.count(F.lit(1)).alias("__n"), F.max("__gap").alias("__gap"))
    report = groups.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.when(F.col("__n") > 1, F.col("__n"))), F.lit(0)).alias("__suspects"),
        F.coalesce(F.sum(F.when(F.col("__gap") == 1, F.col("__n"))), F.lit(0)).alias("rows_with_missing"))
    repeated = groups.where("__n > 1").select("__h1", "__h2")
    suspects = df.withColumns({"__h1": F.xxhash64(*df.columns), "__h2": F.xxhash64(F.lit(1), *df.columns)}).join(
        repeated, ["__h1", "__h2"], "left_semi").groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    copies = suspects.agg(F.coalesce(F.sum(F.when(F.col("__n") > 1, F.col("__n"))), F.lit(0)).alias("duplicated_rows"))
    # The second pass is planned only if some rows share their hashes.
    first = report.first()
    dup = copies.first()["duplicated_rows"] if first["__suspects"] else 0
    return df.sparkSession.createDataFrame(
        [(first["total_rows"], dup, first["rows_with_missing"], len(df.columns))],
        "total_rows bigint, duplicated_rows bigint, rows_with_missing bigint, columns bigint")


def null_counts(df: DataFrame) -> DataFrame:
    """(column, missing) in column order, from one aggregate."""
    counts = df.agg(*[F.count_if(missing_value(df, c)).alias(f"m{i}") for i, c in enumerate(df.columns)])
    pairs = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"),
                               F.col(f"m{i}").alias("missing")) for i, c in enumerate(df.columns)])
    return counts.select(F.inline(pairs))


def _numeric(dtype) -> bool:
    return isinstance(dtype, NumericType) and not isinstance(dtype, BooleanType)


def _ranged(dtype) -> bool:
    return _numeric(dtype) or isinstance(dtype, (DateType, TimestampType, TimestampNTZType))


def _value(name: str, dtype) -> Column:
    c = F.col(name)
    if isinstance(dtype, FractionalType):
        return F.when(~F.isnan(c), c)
    return c


def column_stats(df: DataFrame) -> dict:
    """Pass 1 (one aggregate): per column missing, estimate, bounds, mean, std."""
    aggs = []
    for i, f in enumerate(df.schema.fields):
        v = _value(f.name, f.dataType)
        aggs += [F.count_if(missing_value(df, f.name)).alias(f"missing{i}"),
                 F.approx_count_distinct(v).alias(f"approx{i}")]
        if _ranged(f.dataType):
            aggs += [F.min(v).cast("string").alias(f"lo{i}"), F.max(v).cast("string").alias(f"hi{i}")]
        if _numeric(f.dataType):
            aggs += [F.avg(v.cast("double")).alias(f"mean{i}"),
                     F.stddev_pop(v.cast("double")).alias(f"std{i}")]
    return df.agg(*aggs).first().asDict()


def outlier_count(name: str, dtype, mean, std, propagate_nulls: bool = False,
                  missing: int = 0) -> Column:
    """Rows with |x - mean| / std > 3 (population std); a zero std gives 0."""
    if mean is None or std is None or std == 0 or (propagate_nulls and missing):
        return F.lit(0).cast("bigint")
    z = F.abs((_value(name, dtype).cast("double") - F.lit(mean)) / F.lit(std))
    return F.count_if(z > Z_LIMIT)


def profile_columns(df: DataFrame, propagate_nulls: bool = False) -> DataFrame:
    """One row per column: type, sample text, missing count, outlier count.

    ``sample`` lists the sorted distinct values (and ``nan``/``None`` for a
    gap) when there are at most ten, counting the gap as a value; else
    ``many str values`` for text, ``bounds: min-max`` for numbers and dates,
    ``Unknown`` otherwise. ``outliers`` is NULL for non-numeric columns.
    With ``propagate_nulls`` a numeric column with a gap has 0 outliers.
    """
    fields = df.schema.fields
    stats = column_stats(df)
    pass2 = []
    for i, f in enumerate(fields):
        if stats[f"approx{i}"] <= CANDIDATE_ESTIMATE:
            pass2.append(F.array_sort(F.collect_set(_value(f.name, f.dataType).cast("string"))).alias(f"set{i}"))
        if _numeric(f.dataType):
            pass2.append(outlier_count(f.name, f.dataType, stats[f"mean{i}"], stats[f"std{i}"],
                                       propagate_nulls, stats[f"missing{i}"]).alias(f"out{i}"))
    second = df.agg(*pass2) if pass2 else None
    rows = []
    for i, f in enumerate(fields):
        missing = F.lit(stats[f"missing{i}"]).cast("bigint")
        gap = F.lit(stats[f"missing{i}"] > 0)
        if f"set{i}" in (second.columns if second is not None else []):
            values = F.col(f"set{i}")
            listed = F.when(gap, F.array_append(values, F.lit(_null_text(f.dataType)))).otherwise(values)
            is_small = (F.size(values) + gap.cast("int")) <= MAX_LISTED
        else:
            listed, is_small = F.array().cast("array<string>"), F.lit(False)
        if isinstance(f.dataType, StringType):
            other = F.lit("many str values")
        elif _ranged(f.dataType):
            other = F.lit(f"bounds: {stats[f'lo{i}']}-{stats[f'hi{i}']}")
        else:
            other = F.lit("Unknown")
        sample = F.when(is_small, F.array_join(listed, ",")).otherwise(other)
        outliers = F.col(f"out{i}") if _numeric(f.dataType) else F.lit(None).cast("bigint")
        rows.append(F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                             F.lit(f.dataType.simpleString()).alias("dtype"), sample.alias("sample"),
                             missing.alias("missing"), outliers.alias("outliers")))
    base = second if second is not None else df.sparkSession.range(1)
    return base.select(F.inline(F.array(*rows)))


def zscore_outliers(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Per numeric column, mean, population std and rows with |z| > 3."""
    fields = [f for f in df.schema.fields if _numeric(f.dataType) and (columns is None or f.name in columns)]
    first = df.agg(*[x for i, f in enumerate(fields) for x in (
        F.avg(_value(f.name, f.dataType).cast("double")).alias(f"mean{i}"),
        F.stddev_pop(_value(f.name, f.dataType).cast("double")).alias(f"std{i}"))]).first()
    counts = df.agg(*[outlier_count(f.name, f.dataType, first[f"mean{i}"], first[f"std{i}"]).alias(f"out{i}")
                      for i, f in enumerate(fields)])
    rows = [F.struct(F.lit(f.name).alias("column_name"), F.col(f"out{i}").alias("outliers"))
            for i, f in enumerate(fields)]
    return counts.select(F.inline(F.array(*rows)))
