"""Exact ratio and money rounding.

Ratios are rounded through integers so that an exact half rounds away from zero as
MySQL's ROUND on DECIMAL does, independent of floating point: ``round(a / b, 2)`` is
``sign(a) * ((2 * |a| * 100 + b) div (2 * b)) / 100`` for ``b > 0``.  Money stays
DECIMAL through every SUM (exact, order independent) and is cast to DOUBLE last.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

__all__ = ["money_sum", "money_units", "round_ratio", "round_money"]

MONEY_SUM_TYPE = DecimalType(18, 4)
WHOLE = DecimalType(28, 0)  # of exact ratios: times 2 * 10^4 it still fits 38 digits


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money_sum(c) -> Column:
    """Exact SUM of a money column as DECIMAL(18,4); empty -> NULL."""
    return F.sum(_c(c).cast(MONEY_SUM_TYPE))


def money_units(total) -> Column:
    """A DECIMAL(.,4) money amount as an integer count of 1/10000 units, beyond 64 bits too."""
    return (_c(total).cast(DecimalType(28, 4)) * F.lit(10000)).cast(WHOLE)


def round_ratio(num, den, digits: int = 2) -> Column:
    """round(num / den, digits) for integer num and integer den > 0; NULL otherwise."""
    wide = DecimalType(20, 0)
    num, den = _c(num).cast(WHOLE), _c(den).cast("bigint")
    scale = 10 ** digits
    x = F.abs(num) * F.lit(2 * scale).cast(DecimalType(7, 0)) + den.cast(wide)
    q = F.call_function("div", x, den.cast(wide) * F.lit(2).cast(wide))  # exact integer quotient
    return F.when(den > 0, F.signum(num) * q / F.lit(float(scale)))


def round_money(total, digits: int = 2) -> Column:
    """ROUND of an exact decimal sum, returned as DOUBLE."""
    return F.round(_c(total), digits).cast("double")

