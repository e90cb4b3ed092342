"""Exact money and rate arithmetic: no floating point until the last division."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Fixed value: an amount whose digits without the point are its cents.
_TWO_DECIMALS = r"^[0-9]{1,16}[.][0-9]{2}\z"


def to_cents(yuan: Column) -> Column:
    """Decimal text in yuan -> whole cents, halves to even; NULL when it is no amount.

    Decimals of 38 digits are slow, so text with just two decimals goes without them.
    """
    exact = yuan.try_cast("decimal(38,18)")
    rounded = (F.bround(exact, 2) * 100).try_cast("bigint")
    digits = F.replace(yuan, F.lit("."), F.lit(""))
    return F.when(yuan.rlike(_TWO_DECIMALS), digits.try_cast("bigint")).otherwise(rounded)


def int_div(a: Column, b: Column) -> Column:
    """Division of integers truncated toward zero; NULL when the divisor is 0."""
    return F.call_function("div", a, F.nullif(b, F.lit(0)))


def exact_ratio(num: Column, den: Column, *, scale: int = 10_000, unit: int = 1) -> Column:
    """``num / den * unit`` rounded half away from zero to ``1/scale``, as a double.

    Rounding happens on integers, so the value does not depend on how an engine rounds
    doubles.  20-digit decimals keep sums over very large groups from overflowing, and the
    quotient stays a decimal: integer division of decimals would wrap beyond a BIGINT.
    NULL when ``den`` is 0 or either side is NULL.
    """
    n = F.abs(num.cast("decimal(20,0)"))
    d = F.nullif(F.abs(den.cast("decimal(20,0)")), F.lit(0).cast("decimal(20,0)"))
    twice = n * F.lit(2 * scale * unit) + d
    steps = ((twice - twice % (d * F.lit(2))) / (d * F.lit(2))).cast("decimal(38,0)")
    sign = F.when((num < 0) != (den < 0), -1).otherwise(1)
    return (steps * sign).cast("double") / F.lit(float(scale))
