"""Exact money arithmetic.

Money is summed as ``decimal`` so that the order of addition cannot change a
total (double sums differ between engines and between runs, which flips
window ranks).  Results are rounded half-up to 2 places and handed out as
double, the type of the reference's result schemas.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
# Scale of a money x rate product (decimal(18,2) * decimal(4,2)), kept unrounded.
MONEY_PRODUCT = "decimal(18,4)"
# Intermediate scale for double quotients before the final half-up rounding.
_QUOTIENT = "decimal(38,10)"


def money(c: str | Column) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(MONEY)


# Minor units are split into a high and a low long (``u = hi * 2**20 + lo``,
# 0 <= lo < 2**20, integer shifts only) so that neither sum can overflow for
# any realistic row count.
_SHIFT = 20


def _unscaled(c: Column, scale: int) -> Column:
    return (c * F.lit(10 ** scale)).cast("long")


def exact_sum_parts(c: str | Column, name: str, scale: int) -> list[Column]:
    """Aggregate expressions summing a decimal of ``scale`` exactly as longs.

    Spark sums ``decimal(18,s)`` into a ``decimal(28,s)`` buffer, which is
    kept as a big number per row in the aggregation hash map; summing the
    integer minor units keeps the aggregate on primitive longs.  Combine the
    parts with :func:`exact_sum_value`, or re-aggregate partial results with
    :func:`merge_sum_parts`.
    """
    c = F.col(c) if isinstance(c, str) else c
    u = _unscaled(c, scale)
    return [
        F.sum(F.shiftright(u, _SHIFT)).alias(f"{name}__hi"),
        F.sum(u.bitwiseAND(F.lit((1 << _SHIFT) - 1))).alias(f"{name}__lo"),
    ]


def merge_sum_parts(name: str) -> list[Column]:
    return [F.sum(f"{name}__hi").alias(f"{name}__hi"), F.sum(f"{name}__lo").alias(f"{name}__lo")]


def exact_sum_value(name: str, scale: int) -> Column:
    """``decimal(38, scale)`` total from the two parts (null when no input row)."""
    hi = F.col(f"{name}__hi").cast("decimal(38,0)")
    lo = F.col(f"{name}__lo").cast("decimal(38,0)")
    total = hi * F.lit(1 << _SHIFT).cast("decimal(8,0)") + lo
    return (total / F.lit(10 ** scale).cast("decimal(10,0)")).cast(f"decimal(38,{scale})")


def r2(c: Column) -> Column:
    """Round a decimal half-up to 2 places and return it as double."""
    return F.round(c, 2).cast("double")


def r2_ratio(num: Column, den: Column, scale: float | None = None) -> Column:
    """``round(num / nullif(den, 0) [* scale], 2)`` as double.

    Numerator and denominator are cast to double before dividing; the
    quotient is fixed to 10 decimals before the half-up rounding so that the
    rounding does not depend on binary representation noise.
    """
    q = num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))
    if scale is not None:
        q = q * F.lit(float(scale))
    return F.round(q.cast(_QUOTIENT), 2).cast("double")
