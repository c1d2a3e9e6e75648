"""Dates in whatever layout a text column has them, as Column expressions.

The forms a date can be written in (with an optional time, AM/PM and zone after it):

* three numbers between slashes, dashes or dots: year first (four digits), or year last (four or two digits);
* eight digits, year first;
* a month's English name or its first letters, with the day before or after it and the year last, or the year first,
  between spaces, dashes or commas; a weekday before it and ``st``, ``nd``, ``rd``, ``th`` behind the day are skipped.

The forms exclude each other, so each text has at most one, but one question stays open: with the year last, is the
first number the day or the month? A single text often can't tell, a column can. ``infer`` lets every text vote
that can (a number above 12 is a day), for each separator apart, in one aggregate over any number of columns. Texts that can't tell go
by the majority, month first where nothing or a tie was voted; texts that can are read as they are.

A two-digit year below 69 is in this century, others in the last one. The date is the one that is written: a zone
doesn't move it. What has no form, or is no day of the calendar, is NULL.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATORS = ("/", "-", ".")
# English month names.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
TIME = r"(?:(?:[Tt]|\s+|,\s*)\d{1,2}:\d{2}(?::\d{2}(?:[.,]\d+)?)?(?:\s?[AaPp]\.?[Mm]\.?)?(?:\s?(?:Z|UTC|GMT|[+-]\d{2}(?::?\d{2})?))?)?$"
WEEKDAY = r"^(?:(?:[Mm]on|[Tt]ue|[Ww]ed|[Tt]hu|[Ff]ri|[Ss]at|[Ss]un)[a-z]*,?\s+)?"
NAME, DAY = r"([A-Za-z]{3,9})\.?", r"(\d{1,2})(?:st|nd|rd|th)?"
NUMBERS = r"^(\d{1,4})([/.-])(\d{1,2})\2(\d{1,4})" + TIME
COMPACT = r"^(\d{4})(\d{2})(\d{2})" + TIME
MONTH_DAY = WEEKDAY + NAME + r"\s+" + DAY + r",?\s+(\d{4})" + TIME
DAY_MONTH = WEEKDAY + DAY + r"[\s-]+" + NAME + r",?[\s-]+(\d{4}|\d{2})" + TIME
YEAR_MONTH = r"^(\d{4})[\s-]+" + NAME + r"[\s-]+(\d{1,2})" + TIME
PIVOT = 69


def _text(c) -> Column:
    return F.trim((F.col(c) if isinstance(c, str) else c).cast("string"))


def _number(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(text, pattern, group).try_cast("int")


def _month(name: Column) -> Column:
    """Number of a month's name, or of its first three letters (``sept`` too)."""
    pairs = [(m, k) for k, m in enumerate(MONTHS, 1)] + [(m[:3], k) for k, m in enumerate(MONTHS, 1) if m != "may"] + [("sept", 9)]
    table = F.create_map(*[F.lit(x) for pair in pairs for x in pair])
    return F.try_element_at(table, F.lower(name))


def _full_year(text: Column) -> Column:
    n = text.try_cast("int")
    return F.when(F.length(text) == 4, n).when(F.length(text) == 2, n + F.when(n < PIVOT, 2000).otherwise(1900))


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _parts(year: Column, month: Column, day: Column) -> Column:
    return F.struct(year.cast("int").alias("y"), month.cast("int").alias("m"), day.cast("int").alias("d"))


def _day_of(p: Column) -> Column:
    """The date of year, month and day, or NULL if the calendar has none."""
    leap = (p["y"] % 4 == 0) & ((p["y"] % 100 != 0) | (p["y"] % 400 == 0))
    last = F.when(p["m"].isin(4, 6, 9, 11), 30).when(p["m"] == 2, F.when(leap, 29).otherwise(28)).otherwise(31)
    return F.when(p["y"].between(1, 9999) & p["m"].between(1, 12) & p["d"].between(1, last), F.make_date(p["y"], p["m"], p["d"]))


@dataclass(frozen=True)
class Layouts:
    """What a column's texts say of its layout: whether the day comes first, by separator."""

    day_first: dict[str, bool] = field(default_factory=dict)

    def _three(self, t: Column) -> Column:
        """Year, month and day of three numbers: ``head``, ``second`` and ``tail`` as text, ``mark`` between them."""
        majority = F.lit(False)
        for mark, day_first in self.day_first.items():
            if day_first:
                majority = majority | (t["mark"] == mark)
        first, second = t["head"].try_cast("int"), t["second"].try_cast("int")
        swap = F.when((first > 12) & (second <= 12), True).when((second > 12) & (first <= 12), False).otherwise(majority)
        none = F.lit(None).cast("int")
        return F.when(F.length(t["head"]) == 4, F.when(F.length(t["tail"]) <= 2, _parts(first, second, t["tail"].try_cast("int")))).when(
            F.length(t["head"]) <= 2, _parts(_full_year(t["tail"]), F.when(swap, second).otherwise(first),
                                             F.when(swap, first).otherwise(second))).otherwise(_parts(none, none, none))

    def date(self, c) -> Column:
        """The date, as one small expression: a text is matched once by the form that it has."""
        def found(s: Column) -> Column:
            def part(pattern: str, group: int) -> Column:
                return F.regexp_extract(s, pattern, group)
            numbers = F.struct(*[part(NUMBERS, g).alias(n) for g, n in ((1, "head"), (2, "mark"), (3, "second"), (4, "tail"))])
            return (F.when(s.rlike(NUMBERS), _bound(numbers, self._three))
                    .when(s.rlike(COMPACT), _parts(*(_number(s, COMPACT, g) for g in (1, 2, 3))))
                    .when(s.rlike(MONTH_DAY), _parts(_number(s, MONTH_DAY, 3), _month(part(MONTH_DAY, 1)), _number(s, MONTH_DAY, 2)))
                    .when(s.rlike(DAY_MONTH), _parts(_full_year(part(DAY_MONTH, 3)), _month(part(DAY_MONTH, 2)), _number(s, DAY_MONTH, 1)))
                    .when(s.rlike(YEAR_MONTH), _parts(_number(s, YEAR_MONTH, 1), _month(part(YEAR_MONTH, 2)), _number(s, YEAR_MONTH, 3))))
        return _bound(_bound(_text(c), found), _day_of)

    def year(self, c) -> Column:
        """the year of a date in any of the forms, or a bare year."""
        s = _text(c)
        return F.when(s.rlike(r"^\d{4}$"), s.try_cast("bigint")).otherwise(F.year(self.date(c)).cast("bigint"))


def infer(df: DataFrame, columns: Sequence[str]) -> dict[str, Layouts]:
    """The layouts of date columns, from one aggregate over all texts of all of them."""
    votes = []
    for i, c in enumerate(columns):
        s = _text(F.col(f"`{c}`"))
        first, second, separator = _number(s, NUMBERS, 1), _number(s, NUMBERS, 3), F.regexp_extract(s, NUMBERS, 2)
        last = F.length(F.regexp_extract(s, NUMBERS, 1)) <= 2  # the year is last
        for k, mark in enumerate(SEPARATORS):
            own = last & (separator == mark)
            votes += [F.count_if(own & first.between(13, 31) & second.between(1, 12)).alias(f"d{i}_{k}"),
                      F.count_if(own & second.between(13, 31) & first.between(1, 12)).alias(f"m{i}_{k}")]
    if not columns:
        return {}
    row = df.agg(*votes).first()
    return {c: Layouts({mark: row[f"d{i}_{k}"] > row[f"m{i}_{k}"] for k, mark in enumerate(SEPARATORS)})
            for i, c in enumerate(columns)}
