"""Decimal arithmetic and exact half-up rounding.

Money is ``decimal(15,2)`` at the source; products are rounded half away
from zero to cents and stored as ``decimal(18,2)``.  Averages and ratios are
rounded exactly with integer arithmetic on ``decimal(38,0)``, so the result
does not depend on floating-point summation order, partitioning or engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CENTS = "decimal(18,2)"
TOTAL = "decimal(38,2)"
WIDE_INT = "decimal(38,0)"


def rounded_money(expr: Column, scale: int = 2, type_: str = CENTS) -> Column:
    """``ROUND(expr, scale)`` (half away from zero) with an explicit result type."""
    return F.round(expr, scale).cast(type_)


def cents(amount: Column) -> Column:
    """A 2-decimal amount as an integer number of cents."""
    return (amount * 100).cast(WIDE_INT)


def _floor_div(a: Column, b: Column) -> Column:
    """Exact ``a div b`` for non-negative integer-valued decimals, ``b > 0``."""
    return ((a - a % b) / b).cast(WIDE_INT)


def half_up_ratio(num: Column, den: Column, scale: int, type_: str = "double", num_scale: int = 0) -> Column:
    """``ROUND(num / 10^num_scale / den, scale)``, half away from zero, computed exactly.

    ``num`` and ``den`` must be integer-valued: counts, or amounts scaled to
    integers, ``num_scale`` giving the scaling of ``num`` (2 for cents).  A
    zero or NULL denominator yields NULL: the unguarded division of the
    original returns infinity in one engine and raises in Spark's ANSI mode.
    """
    factor = F.lit(10 ** scale).cast(WIDE_INT)
    n = num.cast(WIDE_INT)
    d = F.nullif(den.cast(WIDE_INT), F.lit(0).cast(WIDE_INT))
    if num_scale:
        d = d * F.lit(10 ** num_scale).cast(WIDE_INT)
    abs_d = F.abs(d)
    q = _floor_div(F.abs(n) * factor * 2 + abs_d, abs_d * 2)
    signed = F.when((n < 0) != (d < 0), -q).otherwise(q)
    if type_ == "double":
        return signed.cast("double") / F.lit(float(10 ** scale))
    return (signed.cast(f"decimal(38,{scale})") / factor).cast(type_)
