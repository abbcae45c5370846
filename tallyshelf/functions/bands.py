"""Ordered value bands: a label and a position for each."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bands:
    """Bands tried from first to last; ``otherwise`` labels the rest, NULL included.

    Grouping goes by the integer position, which hashes and shuffles cheaper
    than the label and carries the display order. The label is looked up after
    the aggregation, for one row per band.
    """

    tests: Sequence[tuple[str, Callable[[Column], Column]]]
    otherwise: str

    @property
    def labels(self) -> list[str]:
        return [label for label, _ in self.tests] + [self.otherwise]

    def position(self, value: Column) -> Column:
        """0-based position of the band ``value`` falls in."""
        chain = F
        for i, (_, test) in enumerate(self.tests):
            chain = chain.when(test(value), F.lit(i))
        return chain.otherwise(F.lit(len(self.tests)))

    def label_at(self, position: Column) -> Column:
        return F.get(F.array(*map(F.lit, self.labels)), position)

    def label(self, value: Column) -> Column:
        return self.label_at(self.position(value))


def below(first: str, edges: Sequence[tuple[str, float]], otherwise: str) -> Bands:
    """A band for exactly 0, then left-closed bands up to each edge."""
    return Bands(
        [(first, lambda v: v == 0)] + [(label, lambda v, e=edge: v < e) for label, edge in edges],
        otherwise,
    )


def up_to(first: str, edges: Sequence[tuple[str, float]], otherwise: str) -> Bands:
    """A band for exactly 0, then right-closed bands up to each edge."""
    return Bands(
        [(first, lambda v: v == 0)] + [(label, lambda v, e=edge: v <= e) for label, edge in edges],
        otherwise,
    )


# Labels and edges of the published reports.
PRICE_BANDS = below("0 Free", [("<5", 5), ("5-10", 10), ("10-20", 20), ("20-40", 40)], "40+")
PRICE_TIERS = below("free", [("low", 10), ("mid", 30)], "high")
ACHIEVEMENT_BANDS = up_to("0", [("1-10", 10), ("11-50", 50), ("51-100", 100)], "100+")
