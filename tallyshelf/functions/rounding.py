"""Rounding rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(value: Column, digits: int | None) -> Column:
    """Half-up rounding of a report measure; ``None`` keeps the raw value."""
    return value if digits is None else F.round(value, digits)


def round_half_even(value: Column, digits: int) -> Column:
    """Half-even rounding of the exact binary value, as Python's ``round`` does.

    ``round`` and ``bround`` look at the decimal text of a double, so they see
    ties where the stored value lies beside one. ``format_number`` formats the
    exact value half-even. Meant for the few values of a KPI record.
    """
    return F.translate(F.format_number(value, digits), ",", "").try_cast("double")
