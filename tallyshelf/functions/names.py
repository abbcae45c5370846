"""Column names taken literally, whatever characters a feed's header has."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def named(name: str) -> Column:
    """The column called ``name``; dots and back quotes have no meaning in it."""
    return F.col(quoted(name))
