"""Casts of feed text that give NULL, never an error, on malformed input.

Sessions keep ANSI mode on, where a plain cast of bad text fails the job. These
expressions give what a non-ANSI cast gives.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INTEGRAL = {"int", "integer", "bigint", "long"}


def to_integral(text: Column, type_name: str) -> Column:
    """Integer of a text; a decimal fraction is cut off, anything else bad is NULL.

    The pattern runs only for text that is not a plain integer.
    """
    pattern = r"^\s*(?<sign>[+-]?)(?<whole>\d*)\.\d*\s*$"
    whole = F.regexp_replace(text, pattern, "${sign}0${whole}")
    return F.coalesce(text.try_cast(type_name), whole.try_cast(type_name))


def to_double(text: Column) -> Column:
    return text.try_cast("double")


def to_day(text: Column, date_format: str) -> Column:
    """Date of a text in ``date_format``; a bad or impossible date is NULL."""
    return F.try_to_date(text, date_format)


def typed(column: Column, type_name: str) -> Column:
    """Feed text as ``type_name``."""
    if type_name in INTEGRAL:
        return to_integral(column, type_name)
    return column.try_cast(type_name)
