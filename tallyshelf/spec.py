"""What a catalog feed looks like: which raw columns get which type and derivation."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class CatalogSpec:
    """Column roles of a catalog feed.

    The defaults are the column names of the store feed. Columns that no role
    names pass through unchanged.
    """

    # Raw and clean column names of the store feed, its date
    # format, its delimiters and its platform names.
    key: str = "appid"
    key_type: str = "int"
    label: str = "name"
    types: Mapping[str, str] = field(
        default_factory=lambda: {
            "english": "int",
            "required_age": "int",
            "achievements": "int",
            "positive_ratings": "bigint",
            "negative_ratings": "bigint",
            "average_playtime": "int",
            "median_playtime": "int",
            "price": "double",
        }
    )
    date: str = "release_date"
    date_format: str = "yyyy-MM-dd"
    year: str = "release_year"
    positive: str = "positive_ratings"
    negative: str = "negative_ratings"
    total: str = "total_ratings"
    ratio: str = "positive_ratio"
    price: str = "price"
    free: str = "is_free"
    interval: str = "owners"
    interval_delimiter: str = "-"
    token_delimiter: str = ";"
    token_counts: Mapping[str, str] = field(
        default_factory=lambda: {
            "num_genres": "genres",
            "num_categories": "categories",
            "num_platforms": "platforms",
        }
    )
    flags: Mapping[str, tuple[str, str]] = field(
        default_factory=lambda: {
            "on_windows": ("platforms", "windows"),
            "on_mac": ("platforms", "mac"),
            "on_linux": ("platforms", "linux"),
        }
    )

    @property
    def inputs(self) -> set[str]:
        """Every raw column the cleaning step reads by name."""
        return {
            self.key,
            self.label,
            self.date,
            self.positive,
            self.negative,
            self.price,
            self.interval,
            *self.types,
            *self.token_counts.values(),
            *(source for source, _ in self.flags.values()),
        }
