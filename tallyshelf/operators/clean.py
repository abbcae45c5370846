"""Raw feed to clean catalog table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyshelf.functions.casts import to_day, typed
from tallyshelf.functions.derive import (
    clamp_negative,
    guarded_ratio,
    interval_bounds,
    interval_middle,
    non_blank,
    token_count,
)
from tallyshelf.functions.names import named
from tallyshelf.operators.dedup import first_per_key
from tallyshelf.spec import CatalogSpec


def cast_columns(raw: DataFrame, spec: CatalogSpec) -> DataFrame:
    """Give every column of ``spec`` its type; columns already typed stay as they are."""
    targets = {spec.key: spec.key_type, **spec.types}
    current = dict(raw.dtypes)

    def cast(name: str) -> Column:
        column = named(name)
        if name == spec.date and current[name] != "date":
            return to_day(column, spec.date_format).alias(name)
        if name in targets and current[name] != targets[name]:
            return typed(column, targets[name]).alias(name)
        return column

    return raw.select(*map(cast, raw.columns))


def derive_columns(items: DataFrame, spec: CatalogSpec, null_count: int | None = None) -> DataFrame:
    """Append the derived columns whose sources ``items`` has, and clamp the price.

    The free flag looks at the price before the clamp, so a negative price is
    not free although it ends at 0.
    """
    have = set(items.columns)
    derived: dict[str, Column] = {}
    if spec.date in have:
        derived[spec.year] = F.year(named(spec.date))
    if {spec.positive, spec.negative} <= have:
        positive, negative = named(spec.positive), named(spec.negative)
        derived[spec.total] = F.try_add(positive, negative)
        derived[spec.ratio] = guarded_ratio(positive, negative)
    if spec.price in have:
        derived[spec.free] = named(spec.price) == 0
    if spec.interval in have:
        low, high = interval_bounds(named(spec.interval), spec.interval_delimiter)
        derived[f"{spec.interval}_low"] = low
        derived[f"{spec.interval}_high"] = high
        derived[f"{spec.interval}_mid"] = interval_middle(low, high)
    for name, source in spec.token_counts.items():
        if source in have:
            derived[name] = token_count(named(source), spec.token_delimiter, null_count)
    for name, (source, word) in spec.flags.items():
        if source in have:
            derived[name] = named(source).contains(word)
    kept = [
        clamp_negative(named(c)).alias(c) if c == spec.price else named(c)
        for c in items.columns
    ]
    return items.select(*kept, *[e.alias(n) for n, e in derived.items()])


def valid_rows(items: DataFrame, spec: CatalogSpec) -> DataFrame:
    """Rows with a key and a label that is not blank."""
    return items.filter(named(spec.key).isNotNull() & non_blank(named(spec.label)))


def clean(
    raw: DataFrame,
    spec: CatalogSpec = CatalogSpec(),
    *,
    dedup: bool = True,
    partial: bool = False,
    null_count: int | None = None,
) -> DataFrame:
    """Typed, valid, de-duplicated catalog with derived columns.

    Casting and filtering are narrow. De-duplication is the only shuffle; it
    runs before the derivations so that only the feed's own columns move.
    ``dedup=False`` is for a feed whose key is known to be unique, ``partial``
    for one that lacks columns: what derives from them is then left out.
    ``null_count=-1`` gives token counts of NULL text the value they had with
    ANSI mode off.
    """
    missing = spec.inputs - set(raw.columns)
    if missing and not partial:
        raise ValueError(f"feed lacks columns {sorted(missing)}; see CatalogSpec")
    items = valid_rows(cast_columns(raw, spec), spec)
    if dedup:
        items = first_per_key(items, [spec.key])
    return derive_columns(items, spec, null_count)
