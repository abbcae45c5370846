"""Derived catalog columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyshelf.functions.casts import to_integral


def guarded_ratio(part: Column, rest: Column) -> Column:
    """``part / (part + rest)``, NULL when the sum is NULL or not positive."""
    total = F.try_add(part, rest)
    return F.when(total > 0, part / total)


def tokens(text: Column, delimiter: str) -> Column:
    """Tokens of a delimited text.

    ``split`` takes a pattern. Escaping alone keeps a one-character delimiter on
    Java's path without a regular expression; quoting it would not.
    """
    return F.split(text, re.escape(delimiter))


def token_count(text: Column, delimiter: str, null_count: int | None = None) -> Column:
    """Number of tokens, blanks included; ``null_count`` replaces the NULL of a NULL text."""
    count = F.size(tokens(text, delimiter))
    return count if null_count is None else F.coalesce(count, F.lit(null_count))


def interval_bounds(text: Column, delimiter: str) -> tuple[Column, Column]:
    """Both ends of a ``low-high`` text as bigint, fractions cut off, NULL where one is missing or bad."""
    ends = tokens(text, delimiter)
    return tuple(to_integral(F.get(ends, F.lit(i)), "bigint") for i in (0, 1))


def interval_middle(low: Column, high: Column) -> Column:
    """Whole-number middle of two bigints, cut off, not rounded."""
    return (F.try_add(low, high) / 2).cast("bigint")


def clamp_negative(amount: Column) -> Column:
    """Negative amounts become 0; NULL stays NULL (``greatest`` would skip it)."""
    return F.when(amount < 0, F.lit(0.0)).otherwise(amount)


def non_blank(text: Column) -> Column:
    return F.length(F.trim(text)) > 0
