"""Rounding as the data contract has it: on the binary value, halves to even."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = 134217729.0  # 2 ** 27 + 1, halves a double's bits


def half_even(x: Column) -> Column:
    """The nearest whole number, halves to even, still a double."""
    return F.rint(x)


def half_even_int(x: Column) -> Column:
    return F.rint(x).cast("int")


def half_up_steps(x: Column) -> Column:
    """The nearest whole number, halves upward."""
    return F.floor(x + 0.5)


def round_exact(x: Column, digits: int) -> Column:
    """x rounded to so many decimals (7 at most), correctly for its binary value, halves to even.

    x * 10^digits may round onto a half that the exact product misses; the error of the
    product tells to which side the exact value lies. The power of ten has under 26 bits,
    so its products with the two halves of x's bits are exact. A tie is nudged by a quarter
    towards the exact value and rounded once, which keeps the expression short: it is
    inlined wherever x is.
    """
    if not 0 <= digits <= 7:
        raise ValueError(f"digits must be in [0, 7], got {digits}")
    c = F.lit(float(10**digits))
    p = x * c
    big = x * F.lit(_SPLIT)
    high = big - (big - x)
    error = (high * c - p) + (x - high) * c
    tie = F.abs(p - F.floor(p).cast("double") - 0.5) == 0.0
    return F.rint(p + F.when(tie, F.signum(error) * 0.25).otherwise(0.0)) / c
