"""De-duplication with a defined survivor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyshelf.functions.names import named


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key: the lowest by ``order_by``, then by all other columns, NULLs last.

    ``dropDuplicates`` keeps whichever row a task sees first, which changes
    between runs and after a lost executor. The minimum over the whole row does
    not. It also combines before the shuffle, so a key that holds a third of all
    rows sends one row per map task. The price is a sort on either side of the
    exchange: a minimum over a row cannot be kept in a hash table. Ranking the
    rows of a key instead would sort once, but a hot key in one task. Columns must
    be orderable (no maps).
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    ordering = [c for c in order_by if c not in keys] + rest
    if not ordering:
        return df.distinct()
    ranked = [part for c in ordering for part in (named(c).isNull(), named(c))]
    row = F.struct(*[part.alias(str(i)) for i, part in enumerate(ranked)])
    lowest = df.groupBy(*map(named, keys)).agg(F.min(row).alias("_row"))
    at = {c: F.col("_row")[str(2 * i + 1)] for i, c in enumerate(ordering)}
    return lowest.select(*[at[c].alias(c) if c in at else named(c) for c in df.columns])
