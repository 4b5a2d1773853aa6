from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

_LOW_BITS = 20
EXACT_DIGITS = 15      # digits that a double surely holds


def null_if_zero(value: Column) -> Column:
    return F.nullif(value, F.lit(0))


def cents_to_dollars(cents: Column, precision: int = 2) -> Column:
    return F.round(cents / F.lit(Decimal("100.0")), precision)


def safe_divide(numerator: Column, denominator: Column, default: float = 0) -> Column:
    """Quotient as a double; ``default`` where the denominator is zero or missing."""
    usable = denominator.isNotNull() & (denominator != 0)
    return F.when(usable, numerator.cast("double") / denominator).otherwise(F.lit(float(default)))


def exact_avg(amount: Column, scale: int, digits: int) -> Column:
    """Average of a decimal of at most 15 digits, rounded half up to ``digits``; the same however rows are split."""
    mean = exact_sum(amount, scale) / null_if_zero(F.count(amount))
    return mean.cast(f"decimal({digits + 10},{digits})")


def exact_sum(amount: Column, scale: int) -> Column:
    """Sum of a decimal of at most 15 digits and ``scale`` places, exact, as ``decimal(22, scale)``.

    An amount of more digits is an error, as a double could no longer hold it; that is looked at once per group, not per row.

    A plain sum of such a decimal keeps a 22-digit total, which costs an object per row. Here each amount is counted
    in whole units of its last digit, which a double holds exactly, and the high and low bits are added up in a long
    each. That is good for 2^43 rows, however the rows are spread over the groups.
    """
    units = F.floor(amount.cast("double") * 10**scale + 0.5)
    high = F.sum(F.shiftright(units, _LOW_BITS)).cast("decimal(20,0)")
    low = F.sum(units.bitwiseAND(F.lit((1 << _LOW_BITS) - 1))).cast("decimal(20,0)")
    total = (high * F.lit(Decimal(1 << _LOW_BITS)) + low).cast("decimal(30,0)") * F.lit(Decimal(1).scaleb(-scale))
    largest = F.max(F.abs(units))
    error = F.raise_error(F.concat(F.lit(f"more than {EXACT_DIGITS} digits: "), largest.cast("string"), F.lit(f" / 10^{scale}")))
    return F.when(largest >= F.lit(10**EXACT_DIGITS), error.cast(f"decimal(22,{scale})")).otherwise(
        total.cast(f"decimal(22,{scale})"))
