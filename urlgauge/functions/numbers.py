"""Rounding of doubles by their exact binary value, ties to the even digit."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_SPLIT = float(2 ** 27 + 1)


def exact_round(value: Column, digits: int) -> Column:
    """Nearest decimal with `digits` places to the double itself, not to its short text.

    The value is split into two halves whose products with the scale are exact, so
    the comparison with the midpoint between two candidates has no rounding error.
    """
    scale = 10.0 ** digits
    big = value * _SPLIT
    high = big - (big - value)
    low = value - high
    floor = F.floor(value * scale).cast("double")
    side = (high * (2 * scale) - (2 * floor + 1)) + low * (2 * scale)
    up = (side > 0) | ((side == 0) & (F.pmod(floor, F.lit(2.0)) == 1.0))
    return F.when(up, floor + 1).otherwise(floor) / scale


def fixed_text(value: Column, digits: int) -> Column:
    """`exact_round` as text with all its places. A formatter takes long, so plain sizes are put together from whole numbers."""
    rounded, scale = exact_round(value, digits), 10 ** digits
    whole = F.rint(rounded * scale).cast("long")
    plain = F.concat(F.floor(whole / scale).cast("string"), F.lit("."), F.lpad((whole % scale).cast("string"), digits, "0"))
    return F.when((value >= 0) & (value < 1e6), plain).otherwise(F.format_string(f"%.{digits}f", rounded))
