"""Year extraction from date text, as Column expressions.

``strict_year`` reads only month/day/year text. ``any_year`` also takes a
bare four-digit year and ISO dates; which rule applies is the caller's
choice, as the raw column's format is not known in advance.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from .keys import _col, strip_ws

# Accepted date layouts (Spark datetime patterns).
MONTH_DAY_YEAR = "M/d/yyyy"
ISO_DATE = "yyyy-M-d"
ISO_TIMESTAMP = "yyyy-M-d H:m:s"
ISO_TIMESTAMP_T = "yyyy-M-d'T'H:m:s"


def _year_of(text: Column, pattern: str) -> Column:
    return F.year(F.try_to_timestamp(text, F.lit(pattern)))


def strict_year(c) -> Column:
    """Year of ``M/d/yyyy`` text (one or two digit month and day); else NULL.

    Text with spaces around it is not in that format: NULL.
    """
    s = _col(c).cast("string")
    ok = s.rlike(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$")
    return F.when(ok, _year_of(s, MONTH_DAY_YEAR)).cast("bigint")


def any_year(c, dtype=None) -> Column:
    """Year of a bare year, ``M/d/yyyy`` text or an ISO date/timestamp."""
    if dtype is not None and isinstance(dtype, NumericType):
        v = _col(c).cast("double")
        return F.when((v == F.floor(v)) & (v >= 1000) & (v <= 9999), v.cast("bigint"))
    s = strip_ws(_col(c).cast("string"))
    return F.when(s.rlike(r"^[0-9]{4}$"), s.cast("bigint")) \
        .when(s.rlike(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$"), _year_of(s, MONTH_DAY_YEAR)) \
        .when(s.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), _year_of(s, ISO_DATE)) \
        .when(s.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2} "), _year_of(F.substring_index(s, ".", 1), ISO_TIMESTAMP)) \
        .when(s.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}T"), _year_of(F.substring_index(s, ".", 1), ISO_TIMESTAMP_T)) \
        .cast("bigint")
