"""Geography and lot key standardisers as Column expressions.

Each function maps a raw key column to one canonical form and returns NULL
for anything it cannot read. They are plain Catalyst expressions (no Python
per row), so they stay inside whole-stage codegen and push through filters.

Input type decides the path, as it does for values read from a typed table:
a numeric column is treated as numbers, a string column as text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, NumericType, StringType

# Borough prefixes of community board codes and their digit.
BOROUGH_DIGITS = {"MN": 1, "BX": 2, "BK": 3, "QN": 4, "SI": 5}

# Text accepted as a plain decimal number (what Python's float() reads,
# without the inf/nan/underscore forms, which are treated as bad input);
# surrounding whitespace is allowed.
NUMBER_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
# A community board code: borough prefix, dash, integer district.
BOARD_CODE = r"^\s*([A-Za-z]*)\s*-\s*([+-]?[0-9]+)\s*$"
WHITESPACE = " \t\n\r\f\u000b"
LARGEST_DOUBLE = 1.7976931348623157e308


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Trim leading/trailing whitespace (tabs and newlines too)."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def finite_double(c) -> Column:
    """Double value, with NaN and +-inf turned into NULL."""
    d = _col(c).cast("double")
    return F.when(F.abs(d) <= LARGEST_DOUBLE, d)


def number_from_text(c) -> Column:
    """Decimal text to double; NULL for anything that is not a finite number."""
    s = _col(c)
    return F.when(s.rlike(NUMBER_TEXT), finite_double(s.try_cast("double")))


def _as_double(c, dtype) -> Column:
    if isinstance(dtype, StringType):
        return number_from_text(c)
    return finite_double(c)


def int_key(c, dtype=None, strict: bool = False) -> Column:
    """Float-held integer key to bigint (``101.0`` -> 101).

    A value with a fraction (or NaN, inf) is NULL, or an error when ``strict``.
    ``floor`` of a double is a bigint, so ``floor(d) == d`` is the whole check.
    Integer columns pass through as they are: a double holds 53 bits only.
    """
    if isinstance(dtype, IntegralType):
        return _col(c).cast("bigint")
    d = _as_double(c, dtype) if isinstance(dtype, StringType) else _col(c).cast("double")
    whole = F.floor(d)
    if not strict:
        return F.when(whole == d, whole)
    bad = F.raise_error(F.concat(F.lit("non-integral key value: "), _col(c).cast("string")))
    return F.when(whole == d, whole).when(d.isNotNull(), bad.cast("bigint"))


def int_key_text(c, dtype=None, strict: bool = False) -> Column:
    """Float-held integer key to integer text (``101.0`` -> ``'101'``)."""
    return int_key(c, dtype, strict).cast("string")


LONG_LIMIT = 9.2e18


def truncated_int(c, dtype=None) -> Column:
    """Number or numeric text to bigint, truncating toward zero (``8.9`` -> 8).

    Integer columns pass through; a number beyond the bigint range is NULL, as
    no integer key can hold it.
    """
    if isinstance(dtype, IntegralType):
        return _col(c).cast("bigint")
    if isinstance(dtype, StringType):
        return number_from_text(c).try_cast("bigint")
    d = _col(c).cast("double")
    return F.when(F.abs(d) < LONG_LIMIT, d.cast("bigint"))


def borough_digit(prefix: Column) -> Column:
    lookup = F.create_map(*[x for code, digit in BOROUGH_DIGITS.items()
                            for x in (F.lit(code), F.lit(digit))])
    return F.try_element_at(lookup, F.upper(prefix))


def _board_from_parts(raw: Column, boro: Column, district: Column) -> Column:
    digits = district.cast("string")
    coded = F.concat(boro.cast("string"),
                     F.lpad(digits, F.greatest(F.length(digits), F.lit(2)), F.lit("0")))
    return F.when(F.instr(raw, "-") == 0, truncated_int(raw, StringType())) \
        .when(district >= 0, coded.try_cast("bigint"))


def community_board(c, dtype=None) -> Column:
    """Community board code to its three-digit number.

    ``'MN-11'`` -> 111, ``' bk - 3 '`` -> 303, ``'QN-123'`` -> 4123,
    ``'101.0'`` -> 101; unknown borough or bad district -> NULL.
    Inside a large projection prefer ``with_community_board``, which reads
    each piece of the code once.
    """
    if dtype is not None and isinstance(dtype, NumericType):
        return truncated_int(c, dtype)
    raw = _col(c)
    return _board_from_parts(raw, borough_digit(F.regexp_extract(raw, BOARD_CODE, 1)),
                             F.regexp_extract(raw, BOARD_CODE, 2).try_cast("bigint"))


def with_community_board(df, source: str, target: str | None = None):
    """``community_board`` as two projections: split the code, then combine.

    The second projection reads the split pieces several times; Catalyst
    keeps the two projections apart (it does not inline a costly expression
    that is read more than once), so each regular expression runs once per row.
    """
    target = target or source
    dtype = df.schema[source].dataType
    if isinstance(dtype, NumericType):
        return df.withColumn(target, truncated_int(source, dtype))
    raw = F.col(source)
    staged = df.withColumns({
        "__board_digit": borough_digit(F.regexp_extract(raw, BOARD_CODE, 1)),
        "__board_district": F.regexp_extract(raw, BOARD_CODE, 2).try_cast("bigint"),
    })
    out = staged.withColumn(target, _board_from_parts(F.col(source), F.col("__board_digit"),
                                                      F.col("__board_district")))
    return out.drop("__board_digit", "__board_district")


def council_district(c, dtype=None) -> Column:
    """Council district to bigint; bad text -> NULL; fractions truncate."""
    return truncated_int(c, dtype)


def school_district(c, dtype=None) -> Column:
    """School district to bigint, same rule as council districts."""
    return council_district(c, dtype)


def census_tract(c, dtype=None) -> Column:
    """Census tract to six-character text: last six characters, zero-filled.

    A number is first written as its truncated integer (``86400.0`` ->
    ``'086400'``); text is only trimmed. Zero-fill keeps a leading sign first.
    """
    if dtype is not None and isinstance(dtype, NumericType):
        s = truncated_int(c, dtype).cast("string")
    else:
        s = strip_ws(c)
    tail = F.right(s, F.lit(6))
    signed = tail.startswith("-") | tail.startswith("+")
    return F.when(F.length(tail) >= 6, tail) \
        .when(signed, F.concat(F.left(tail, F.lit(1)), F.lpad(F.substr(tail, F.lit(2)), 5, "0"))) \
        .otherwise(F.lpad(tail, 6, "0"))


def zero_pad(c, width: int) -> Column:
    """Left zero-pad to ``width`` without cutting longer values."""
    s = _col(c).cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def fill_zero(c) -> Column:
    """NULL -> 0 for a measure."""
    return F.coalesce(_col(c), F.lit(0))


def spare_capacity(target, enrolled) -> Column:
    """Seats left: target capacity minus enrolment."""
    return _col(target) - _col(enrolled)


def joined_values(c) -> Column:
    """Aggregate: distinct values as sorted, comma-separated text."""
    return F.array_join(F.array_sort(F.collect_set(_col(c).cast("string"))), ",")


STANDARDISERS = {
    "community_district": community_board,
    "council_district": council_district,
    "school_district": school_district,
    "census_tract": census_tract,
}
