"""Exact money arithmetic.

Rates arrive as DOUBLE. Float sums depend on row order, and row order changes from run to run, so
rates become decimals first. RATE (8 + 9 digits) times AMOUNT (20 digits) is exactly DECIMAL(38, 9):
nothing is rounded until the one rounding to cents at the end, and a larger value raises an error
instead of losing digits. A rate that RATE cannot hold exactly is kept to 18 places (WIDE_RATE), and
its products to six.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

RATE = "decimal(17,9)"
WIDE_RATE = "decimal(38,18)"
AMOUNT = "decimal(20,0)"
PRICE = "decimal(18,2)"


def exact_rate(rate: Column) -> Column:
    """The rate as RATE, NULL if that would change it."""
    narrow = rate.try_cast(RATE)
    return F.when(narrow.cast("double") == rate, narrow)


def wide_rate(rate: Column) -> Column:
    """The rate as WIDE_RATE where RATE would change it; NULL too if it is out of range or became 0."""
    wide = rate.try_cast(WIDE_RATE)
    return F.when(exact_rate(rate).isNull() & (wide != 0), wide)


def converted(amount: Column, rate: Column) -> Column:
    """Minor units of the base currency, DECIMAL(38, 9)."""
    return amount.cast(AMOUNT) * rate.cast(RATE)


def converted_wide(amount: Column, rate: Column) -> Column:
    """The same for a WIDE_RATE, DECIMAL(38, 6)."""
    return amount.cast(AMOUNT) * rate.cast(WIDE_RATE)


def from_minor_units(total: Column) -> Column:
    """Divide by 100 and round half up to cents, in one rounding.

    ``total / 100`` would be cut to six digits first and rounded a second time by the cast. Without
    ANSI mode a value out of range becomes NULL, which the mart must not hold either.
    """
    cents = F.round(total, 0).cast(AMOUNT)
    return F.coalesce((cents * F.lit(Decimal("0.01"))).cast(PRICE),
                      F.raise_error(F.lit("turnover out of range")))


def whole_part(total: Column, n_products: Column, n_expected: Column) -> Column:
    """A part of a total, 0 where it has no addend; an error if an addend or the sum was out of range.

    Without ANSI mode such values become NULL, which sums pass over: absent and overflowed are told apart by
    the number of products there should be.
    """
    fits = (n_products == n_expected) & total.isNotNull()
    return (F.when(n_expected == 0, F.lit(Decimal(0))).when(fits, total)
            .otherwise(F.raise_error(F.lit("turnover out of range")).cast("decimal(38,9)")))


def turnover(exact: Column, wide: Column, n_wide: Column) -> Column:
    """Cents of the two parts of a total; without a wide part not a digit of the other is lost."""
    return F.when(n_wide == 0, from_minor_units(exact)).otherwise(from_minor_units(exact + wide))


def ratio(numerator: Column, denominator: Column) -> Column:
    return (numerator.cast("decimal(18,6)") / denominator).cast(PRICE)
