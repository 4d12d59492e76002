"""Exact money arithmetic as Column expressions.

Silver amounts are DECIMAL(18, 4).  Rules judge the amount as it came
(``wide``: ten decimals, 28 integer digits), and only an accepted amount
is narrowed.  Sums run over decimals with a wide result, so they are
exact, independent of summation order and far from overflow; results
turn into DOUBLE only in the final projection.

Rounding is half away from zero, in exact integer steps of cents.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillscope.schema import MONEY

#: an amount as it came; beyond this the amount is no money at all
WIDE = "decimal(38,10)"
#: what sums read: MONEY's decimals, more integer digits
SUMMED = "decimal(28,4)"
INTEGER = "decimal(38,0)"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_money(col: Column | str) -> Column:
    """Any numeric as DECIMAL(18, 4); NULL when it does not fit."""
    return _c(col).try_cast(MONEY)


def wide(col: Column | str) -> Column:
    """Any numeric with ten decimals; NULL when it is NaN, infinite or beyond 28 integer digits."""
    return _c(col).try_cast(WIDE)


def lost(col: Column | str) -> Column:
    """True for an amount that is there but cannot be held as money."""
    c = _c(col)
    return c.isNotNull() & as_money(c).isNull()


def total_of(col: Column | str) -> Column:
    """Exact sum of amounts, as a wide decimal (an aggregate); amounts that do not fit are left out, see ``unsummed``."""
    return F.sum(_c(col).try_cast(SUMMED))


def unsummed(col: Column | str) -> Column:
    """Number of amounts that an exact sum cannot hold (an aggregate)."""
    c = _c(col)
    return F.count_if(c.isNotNull() & c.try_cast(SUMMED).isNull())


def _rounded_ratio(num: Column, den: Column) -> Column:
    """round(num / den) of whole numbers, half away from zero, by exact integer division."""
    n = F.abs(num).cast(INTEGER) * F.lit(2) + den.cast(INTEGER)
    d = den.cast(INTEGER) * F.lit(2)
    whole = ((n - n % d) / d).cast(INTEGER)
    return F.when(num < 0, -whole).otherwise(whole)


def _ten_thousandths(amount: Column) -> Column:
    return (amount.cast("decimal(38,4)") * F.lit(10000)).cast(INTEGER)


def round_to_cents(amount: Column) -> Column:
    """round(amount, 2); DOUBLE result."""
    return (_rounded_ratio(_ten_thousandths(amount), F.lit(100)).cast("decimal(38,2)") / F.lit(100)).cast("double")


def avg_to_cents(total: Column, count: Column) -> Column:
    """round(total / count, 2); DOUBLE, NULL for an empty group."""
    cents = _rounded_ratio(_ten_thousandths(total), F.greatest(count, F.lit(1)).cast(INTEGER) * F.lit(100))
    return F.when(count > 0, (cents.cast("decimal(38,2)") / F.lit(100)).cast("double"))


def pct_of_total(part: Column, total: Column) -> Column:
    """round(part / total * 100, 2) for non-negative counts; DOUBLE."""
    num, den = F.lit(20000) * part + total, F.lit(2) * total
    return F.call_function("div", num.cast("bigint"), den.cast("bigint")).cast("double") / F.lit(100.0)
