"""Sums and means of money that do not depend on the order in which rows are added.

Doubles added on many executors come out differently from run to run in the last digits.
For columns the contract names as money each value becomes a whole number of 10^-scale
units, and whole numbers add up to the same total on any partitioning and after any retry.
Other columns are added as they are, with all their digits. A group that holds a value
which is no such number (NaN, infinite, 9e18 units or more) is added as doubles too.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from salesflow.contracts import MONEY

# Units are summed in two halves, so that totals beyond 64 bits do not overflow.
_LOW_BITS = 20
# Window frames are a few rows long: below this their units add up in one 64-bit number.
_MOST_IN_FRAME = 2**50


def scale_of(value: Column | str) -> int | None:
    """Decimals of a money column, None for any other."""
    return MONEY.get(value) if isinstance(value, str) else None


def exact_sum(
    value: Column | str, scale: int | None = None, window: WindowSpec | None = None
) -> Column:
    """Sum as double; ``scale`` decimals are kept per row, by default as the contract says."""
    scale = scale_of(value) if scale is None else scale
    col = F.col(value) if isinstance(value, str) else value

    def over(total: Column) -> Column:
        return total if window is None else total.over(window)

    plain = over(F.sum(col))
    if scale is None:
        return plain
    units = F.rint(col * float(10**scale)).try_cast("bigint")
    if window is not None:
        units = F.when(F.abs(units) < _MOST_IN_FRAME, units)
        total = over(F.sum(units))
    else:
        high = F.sum(F.shiftright(units, _LOW_BITS)).cast("decimal(20,0)")
        low = F.sum(units.bitwiseAND(F.lit(2**_LOW_BITS - 1)))
        total = high * F.lit(2**_LOW_BITS).cast("decimal(8,0)") + low.cast("decimal(20,0)")
    whole = over(F.count(units)) == over(F.count(col))
    return F.when(whole, total.cast("double") / float(10**scale)).otherwise(plain)


def exact_mean(
    value: Column | str, scale: int | None = None, window: WindowSpec | None = None
) -> Column:
    """Mean of the non-null values, null where there are none."""
    count = F.count(value)
    return F.try_divide(
        exact_sum(value, scale, window), count if window is None else count.over(window)
    )
