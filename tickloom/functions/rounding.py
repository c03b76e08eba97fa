"""Rounding that gives the same digits whatever order a mean was summed in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(value: Column, digits: int) -> Column:
    """Round half away from zero.

    Means of two-decimal prices often sit exactly on a rounding tie, where the last
    bit of the sum decides. The nudge, far below the kept digits, settles those.
    """
    return F.round(value + F.signum(value) * F.lit(1e-9), digits)


def percent_change(start: Column, end: Column, digits: int = 4) -> Column:
    """Change from start to end in percent; null when start is null or 0."""
    return round_half_up((end - start) / F.nullif(start, F.lit(0.0)) * 100, digits)


def fixed_text(value: Column, digits: int) -> Column:
    """Fixed-point text without thousands separators."""
    return F.replace(F.format_number(value, digits), F.lit(","), F.lit(""))


def grouped_text(value: Column, digits: int = 0) -> Column:
    """Fixed-point text with thousands separators."""
    return F.format_number(value, digits)
