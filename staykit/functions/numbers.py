"""Ratios, bands, exact sums and coercion."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Names of the ten bands, lowest first.
BANDS = ("10percent",) + tuple(f"{low}_{low + 10}percent" for low in range(10, 100, 10))
BAND_POINTS = tuple(k / 10 for k in range(1, 11))


def ratio(top: Column, bottom: Column) -> Column:
    """NULL, not an error, when the denominator is zero."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def count_where(test: Column) -> Column:
    """Number of rows that pass; a NULL test does not."""
    return F.sum(F.when(test, 1).otherwise(0))


def share_where(test: Column) -> Column:
    return F.avg(F.when(test, 1).otherwise(0))


def sum_where(test: Column, value: Column) -> Column:
    return F.sum(F.when(test, value).otherwise(0))


def fixed_point(value: Column, scale: int) -> Column:
    """``value`` in whole steps of 1/scale. Integer sums do not depend on the order of the rows, so a mean over the same
    rows is the same double whichever tasks they came from, and "above the peers' mean" never flips on a last bit."""
    return F.round(value * scale).cast("bigint")


def wide(value: Column) -> Column:
    """Room for a sum that would overflow a bigint."""
    return value.cast("decimal(20,0)")


# A whole number in two parts, so that sums of either part stay in a bigint for 10**12 rows and more.
_PART = 10**7


def whole_parts(value: Column) -> tuple[Column, Column]:
    """A bigint as (multiples of 10**7, rest); sum the parts, then put them together with ``joined_parts``."""
    high = F.floor(value / _PART)
    return high, value - high * _PART


def joined_parts(high: Column, low: Column) -> Column:
    """The exact sum from the sums of its parts."""
    return high.cast("decimal(28,0)") * _PART + low


def decile_band(value: Column, points: Column, first: int = 0) -> Column:
    """Band of ``value`` among ten percentile points. Bands share their edges and the lowest matching one wins.

    ``first`` is the index of the point that ends the lowest band (0). With 1 every band sits one point too high, which
    is the literal behaviour this was designed from.
    """
    band = F
    for step, name in enumerate(BANDS[1:-1]):
        band = band.when(value.between(F.get(points, F.lit(first + step)), F.get(points, F.lit(first + step + 1))), name)
    band = band.when(value > F.get(points, F.lit(first + len(BANDS) - 2)), BANDS[-1])
    return band.otherwise(BANDS[0])


def to_number(value: Column, is_boolean: bool = False, is_number: bool = False) -> Column:
    """Any column as a double; text that is no number, NaN and NULL become 0. With ``is_number``, for whole numbers and
    doubles, no text is made and parsed for each value."""
    if is_number:
        number = value.cast("double")
    else:
        number = value.cast("int").cast("double") if is_boolean else value.cast("string").try_cast("double")
    return F.coalesce(F.nanvl(number, F.lit(0.0)), F.lit(0.0))
