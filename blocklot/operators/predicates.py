"""Exact orientation of three points, as Column expressions.

``orientation`` is the sign of the determinant

    (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)

of the coordinates as they are (binary doubles), without any rounding:

1. *Filter.* The determinant is computed in double precision. Its error is at most
   ``BOUND`` times the sum of the sizes of its two products; if it is larger than that, its
   sign is right. A product one of whose differences is zero is zero exactly (equal
   doubles are the only ones with that difference), so axis-parallel cases are decided here too.
2. *Expansion.* Otherwise the determinant is written as a sum of products of the
   coordinates themselves, six after cancelling, or of the two differences where all four are
   exact. Each product is split without error into two doubles (two-product by
   Veltkamp's splitting, no fused operation needed), and the parts are added one by one to an *expansion*, an
   array of doubles that don't overlap, smallest first, whose exact sum is the
   determinant (two-sum). The sign is that of its last part that isn't zero.

Exact while no product leaves the range of doubles: sizes between 1e-140 and 1e140, or zero.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Half a unit in the last place of 1, and the error bound of the determinant in double precision.
EPSILON = 2.0 ** -53
BOUND = (3 + 16 * EPSILON) * EPSILON
#: Veltkamp's constant for 53 bits.
SPLITTER = 2.0 ** 27 + 1


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def two_sum(a: Column, b: Column) -> Column:
    """(sum, error) of a + b: both together are exact."""
    def rest(total: Column) -> Column:
        of_b = total - a
        return F.struct(total.alias("sum"), ((a - (total - of_b)) + (b - of_b)).alias("error"))
    return _bound(a + b, rest)


def _halves(a: Column) -> Column:
    wide = a * SPLITTER
    return _bound(wide - (wide - a), lambda high: F.struct(high.alias("high"), (a - high).alias("low")))


def two_product(a: Column, b: Column) -> Column:
    """[error, product] of a * b: both together are exact."""
    def parts(x: Column) -> Column:
        p, u, v = x["p"], x["u"], x["v"]
        error = u["low"] * v["low"] - (((p - u["high"] * v["high"]) - u["low"] * v["high"]) - u["high"] * v["low"])
        return F.array(error, p)
    return _bound(F.struct((a * b).alias("p"), _halves(a).alias("u"), _halves(b).alias("v")), parts)


def grow(expansion: Column, value: Column) -> Column:
    """The expansion of the exact sum of ``expansion`` and ``value``."""
    def step(acc: Column, part: Column) -> Column:
        return _bound(two_sum(acc["sum"], part), lambda s: F.struct(
            s["sum"].alias("sum"), F.array_append(acc["out"], s["error"]).alias("out")))
    start = F.struct(value.alias("sum"), F.array().cast("array<double>").alias("out"))
    return F.aggregate(expansion, start, step, lambda acc: F.array_append(acc["out"], acc["sum"]))


def sign_of_products(pairs: Column) -> Column:
    """The exact sign (-1.0, 0.0 or 1.0) of the sum of the products of ``pairs`` (a, b)."""
    terms = F.flatten(F.transform(pairs, lambda p: two_product(p["a"], p["b"])))
    total = F.aggregate(terms, F.array().cast("array<double>"), grow)
    return F.aggregate(total, F.lit(0.0), lambda sign, x: F.when(x != 0, F.signum(x)).otherwise(sign))


def _pair(a: Column, b: Column) -> Column:
    return F.struct(a.alias("a"), b.alias("b"))


def _exact(ax, ay, bx, by, cx, cy) -> Column:
    whole = F.array(_pair(bx, cy), _pair(-bx, ay), _pair(-ax, cy), _pair(-by, cx), _pair(by, ax), _pair(ay, cx))
    near = F.array(_pair(bx - ax, cy - ay), _pair(-(by - ay), cx - ax))

    def exact(a: Column, b: Column) -> Column:
        """Whether b - a is exact."""
        return two_sum(b, -a)["error"] == 0
    same = exact(ax, bx) & exact(ay, cy) & exact(ay, by) & exact(ax, cx)
    return sign_of_products(F.when(same, near).otherwise(whole))


def orientation(ax: Column, ay: Column, bx: Column, by: Column, cx: Column, cy: Column) -> Column:
    """1.0 if a, b, c turn left, -1.0 if they turn right, 0.0 if they are on one line; exact."""
    left, right = (bx - ax) * (cy - ay), (by - ay) * (cx - ax)
    limit = (F.abs(left) + F.abs(right)) * BOUND
    flat = ((bx == ax) | (cy == ay)) & ((by == ay) | (cx == ax))
    return F.when(flat, F.lit(0.0)).when(F.abs(left - right) > limit, F.signum(left - right)).otherwise(
        _exact(ax, ay, bx, by, cx, cy))
