"""Sums and means of floating values that do not depend on the order of addition."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A value is split into whole multiples of 2 ** -UNIT and a rest in multiples of 2 ** -(UNIT + REST).
UNIT = 20
REST = 43

# Bits of the lower halves that whole numbers and rests are added up in.
HALF = 32
HALF_REST = 21

# Values from here on have too many multiples for a long.
LIMIT = 2.0 ** (63 - UNIT)

# Sums below so many bits are put together as longs, larger ones as decimals.
PLAIN = 61


def exact_sum(value: Column, times: Column | None = None) -> Column:
    """Sum of a group's values; the same bits in whatever order, and however dealt, its rows are added.

    Each value is split into two whole numbers, and each of these into two halves of
    at most 32 bits, whose sums are exact in a long for up to 2 ** 31 values; only the
    four sums of a group are put together, as decimals where a long could not hold them.
    What lies below 2 ** -63 of a value is cut off. Groups that hold a value beyond the
    limit, an infinity or NaN are added up as floating numbers. NULL without values.
    ``times`` tells how often a row's value counts.
    """
    number = value.cast("double")
    fits = F.abs(number) < LIMIT
    scaled = F.when(fits, number * float(1 << UNIT))
    whole = F.floor(scaled)
    rest = F.floor((scaled - whole.cast("double")) * float(1 << REST))
    large, small = _sum_of_halves(whole, HALF, times), _sum_of_halves(rest, HALF_REST, times)
    total = large / float(1 << UNIT) + small / float(1 << (UNIT + REST))
    return F.when(F.coalesce(F.bool_and(fits), F.lit(True)), total).otherwise(
        F.sum(number if times is None else number * times))


def _sum_of_halves(part: Column, bits: int, times: Column | None) -> Column:
    """Sum of whole numbers as a double, from the sums of their upper halves and lowest ``bits``."""
    high, low = F.shiftright(part, bits), part.bitwiseAND(F.lit((1 << bits) - 1))
    upper, lower = (F.sum(half if times is None else half * times) for half in (high, low))
    fits = (F.abs(upper) < F.lit(1 << (PLAIN - bits))) & (lower < F.lit(1 << PLAIN))
    plain = F.shiftleft(upper, bits) + lower
    whole = upper.cast("decimal(20,0)") * F.lit(1 << bits).cast("decimal(10,0)") + lower.cast("decimal(20,0)")
    return F.when(fits, plain.cast("double")).otherwise(whole.cast("double"))


def exact_mean(value: Column, times: Column | None = None) -> Column:
    """Exact sum over the number of values."""
    count = F.count(value) if times is None else F.sum(F.when(value.isNotNull(), times))
    return exact_sum(value, times) / count
