"""The analysis questions over a clean catalog (``items``) and its long tag table (``tags``).

Every report groups before it sorts, so only partial sums travel, at most one
row per group and task; a hot group costs no more than a cold one. Reports with
a ``digits`` parameter round the finished measure; ``None`` gives the raw value.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyshelf.functions.bands import ACHIEVEMENT_BANDS, PRICE_BANDS, PRICE_TIERS, Bands
from tallyshelf.functions.names import quoted
from tallyshelf.functions.rounding import round_half_even, rounded
from tallyshelf.operators.grouped import by_band, last_by, ranked, top_k
from tallyshelf.operators.histogram import equal_width_histogram
from tallyshelf.operators.quantile import exact_quantile
from tallyshelf.operators.reshape import explode_tokens, melt_measures, transpose_row

# Platform flags and the names of their shares.
PLATFORM_SHARES = {"win": "on_windows", "mac": "on_mac", "linux": "on_linux"}
PLATFORM_RATES = {"mac": "on_mac", "linux": "on_linux"}
KPI_SHARES = {"win_pct": "on_windows", "mac_pct": "on_mac", "linux_pct": "on_linux"}


def _mean(column: str, digits: int | None) -> Column:
    return rounded(F.avg(column), digits)


def _rate(flag: str, digits: int | None) -> Column:
    return rounded(F.avg(F.col(flag).cast("int")), digits)


def _hours(minutes: str, digits: int | None) -> Column:
    return rounded(F.avg(minutes) / 60, digits)


# Releases over time


def releases_by_year(
    items: DataFrame, first: int = 1997, last: int = 2019, *, year: str = "release_year"
) -> DataFrame:
    """Items per year of an inclusive range, by year."""
    return _per_year(items, first, last, year).orderBy(year)


def years_ranked(
    items: DataFrame, first: int = 2014, last: int = 2019, *, year: str = "release_year"
) -> DataFrame:
    """Items per year of an inclusive range, most items first."""
    return ranked(_per_year(items, first, last, year), "n_games", year)


def last_years(items: DataFrame, k: int, *, year: str = "release_year") -> DataFrame:
    """The ``k`` most recent years that have items."""
    counts = items.filter(F.col(year).isNotNull()).groupBy(year).agg(F.count("*").alias("n_games"))
    return last_by(counts, year, k)


def peak_year(items: DataFrame, *, year: str = "release_year") -> DataFrame:
    """The year with most items, the earliest of several."""
    counts = items.filter(F.col(year).isNotNull()).groupBy(year).agg(F.count("*").alias("n_games"))
    return top_k(counts, "n_games", 1, year)


def share_since(
    items: DataFrame, cut: int, *, year: str = "release_year", digits: int | None = 4
) -> DataFrame:
    """Items of year ``cut`` or later, and their share of all that have a year."""
    recent = F.col(year) >= cut
    return items.agg(
        F.count_if(recent).alias("n_since"),
        rounded(F.avg(recent.cast("int")), digits).alias("share"),
    )


def _per_year(items: DataFrame, first: int, last: int, year: str) -> DataFrame:
    span = items.filter(F.col(year).between(first, last))
    return span.groupBy(year).agg(F.count("*").alias("n_games"))


# Genres


def genre_stats(
    items: DataFrame,
    k: int = 12,
    *,
    genres: str = "genres",
    ratio: str = "positive_ratio",
    digits: int | None = 3,
) -> DataFrame:
    """The ``k`` genres with most items, with their mean ratio."""
    by_genre = explode_tokens(items, genres, "genre").groupBy("genre")
    stats = by_genre.agg(F.count("*").alias("n"), _mean(ratio, digits).alias("avg_ratio"))
    return top_k(stats, "n", k, "genre")


def genre_playtime(
    items: DataFrame,
    k: int = 12,
    *,
    min_ratings: int = 50,
    min_items: int = 30,
    genres: str = "genres",
    total: str = "total_ratings",
    playtime: str = "average_playtime",
    digits: int | None = 2,
    with_minutes: bool = False,
) -> DataFrame:
    """The ``k`` genres played longest among well-rated-often items.

    ``with_minutes`` adds the mean in minutes before the mean in hours.
    """
    rated = items.filter(F.col(total) >= min_ratings)
    minutes = [F.avg(playtime).alias("avg_min")] if with_minutes else []
    stats = (
        explode_tokens(rated, genres, "genre")
        .groupBy("genre")
        .agg(F.count("*").alias("n"), *minutes, _hours(playtime, digits).alias("avg_hours"))
        .filter(F.col("n") >= min_items)
    )
    return top_k(stats, "avg_hours", k, "genre")


# Prices


def price_band_stats(
    items: DataFrame,
    *,
    bands: Bands = PRICE_BANDS,
    price: str = "price",
    ratio: str = "positive_ratio",
    owners: str = "owners_mid",
    ratio_digits: int | None = 3,
    owner_digits: int | None = 0,
    position: str | None = None,
    keep_empty: bool = False,
) -> DataFrame:
    """Items, mean ratio and mean owners per price band.

    ``position`` adds the band's place and sorts by it; ``keep_empty`` shows
    bands without items too.
    """
    measures = {"avg_ratio": _mean(ratio, ratio_digits), "avg_owners": _mean(owners, owner_digits)}
    stats = by_band(
        items, price, bands, "price_band", measures, position=position, keep_empty=keep_empty
    )
    return stats.orderBy(position) if position else stats


def price_tier_stats(
    items: DataFrame,
    *,
    bands: Bands = PRICE_TIERS,
    price: str = "price",
    ratio: str = "positive_ratio",
    digits: int | None = 3,
) -> DataFrame:
    """Items and mean ratio per price tier, best first."""
    stats = by_band(items, price, bands, "tier", {"avg_ratio": _mean(ratio, digits)})
    return ranked(stats, "avg_ratio", "tier")


def price_histogram(
    items: DataFrame, above: float = 0, up_to: float = 60, bins: int = 40, *, price: str = "price"
) -> DataFrame:
    """Equal-width histogram of the prices in (above, up_to]."""
    paid = items.filter((F.col(price) > above) & (F.col(price) <= up_to))
    return equal_width_histogram(paid, price, bins).orderBy("bin")


def free_paid_split(items: DataFrame, *, free: str = "is_free") -> DataFrame:
    """Free items, and paid ones counted twice: flagged not free, and all but the free.

    The two differ by the items whose price is unknown.
    """
    counts = items.agg(
        F.count_if(F.col(free)).alias("n_free"),
        F.count_if(~F.col(free)).alias("n_not_free"),
        F.count("*").alias("n_total"),
    )
    return counts.withColumn("n_rest", F.col("n_total") - F.col("n_free"))


def median_price(items: DataFrame, *, price: str = "price") -> DataFrame:
    """The exact median of all prices, free items included, in the prices' type."""
    value = exact_quantile(items, price, 0.5)
    kind = T.StructType([T.StructField("median_price", items.schema[price].dataType)])
    return items.sparkSession.createDataFrame([(value,)], kind)


# Makers


def top_developers(items: DataFrame, k: int = 12, *, developer: str = "developer") -> DataFrame:
    """Developers with most items. The name is one group, joint names unsplit."""
    known = items.filter(F.col(developer).isNotNull())
    return top_k(known.groupBy(developer).agg(F.count("*").alias("n")), "n", k, developer)


def top_publishers(
    items: DataFrame,
    k: int = 12,
    *,
    publisher: str = "publisher",
    positive: str = "positive_ratings",
) -> DataFrame:
    """Publishers with most positive ratings."""
    known = items.filter(F.col(publisher).isNotNull())
    return top_k(known.groupBy(publisher).agg(F.sum(positive).alias("pos")), "pos", k, publisher)


# Platforms


def platform_share(
    items: DataFrame,
    flags: Mapping[str, str] = PLATFORM_SHARES,
    *,
    digits: int | None = 3,
) -> DataFrame:
    """Share of all items per platform, one row per platform."""
    shares = items.agg(*[_rate(flag, None).alias(name) for name, flag in flags.items()])
    return transpose_row(shares, list(flags), "platform", "share", digits)


def platform_rate_by_year(
    items: DataFrame,
    first: int = 2008,
    last: int = 2019,
    flags: Mapping[str, str] = PLATFORM_RATES,
    *,
    year: str = "release_year",
    digits: int | None = 3,
) -> DataFrame:
    """Share of a year's items per platform, one column per platform."""
    span = items.filter(F.col(year).between(first, last))
    rates = span.groupBy(year).agg(*[_rate(flag, digits).alias(n) for n, flag in flags.items()])
    return rates.orderBy(year)


def platform_rate_long(
    rates: DataFrame, platforms: list[str] | None = None, *, year: str = "release_year"
) -> DataFrame:
    """``platform_rate_by_year`` with one row per year and platform."""
    platforms = platforms or [c for c in rates.columns if c != year]
    return melt_measures(rates, [year], platforms, "platform", "rate")


# Tags


def top_tags(
    tags: DataFrame,
    k: int = 20,
    *,
    tag: str = "tag",
    votes: str = "votes",
    with_items: bool = True,
) -> DataFrame:
    """Tags with most votes; ``with_items`` adds the number of items that carry them."""
    n_items = [F.count("*").alias("n_games")] if with_items else []
    stats = tags.groupBy(tag).agg(F.sum(votes).alias("total_votes"), *n_items)
    return top_k(stats, "total_votes", k, tag)


# Achievements


def achievement_band_stats(
    items: DataFrame,
    *,
    bands: Bands = ACHIEVEMENT_BANDS,
    min_ratings: int = 50,
    achievements: str = "achievements",
    total: str = "total_ratings",
    ratio: str = "positive_ratio",
    playtime: str = "average_playtime",
    ratio_digits: int | None = 3,
    hour_digits: int | None = 2,
    position: str | None = None,
    keep_empty: bool = False,
) -> DataFrame:
    """Items, mean ratio and mean hours per achievement band, for items rated often enough."""
    rated = items.filter(F.col(total) >= min_ratings)
    measures = {"avg_ratio": _mean(ratio, ratio_digits), "avg_hours": _hours(playtime, hour_digits)}
    stats = by_band(
        rated, achievements, bands, "ach_band", measures, position=position, keep_empty=keep_empty
    )
    return stats.orderBy(position) if position else stats


# Whole-table records


def quality_report(
    items: DataFrame,
    *,
    ratio: str = "positive_ratio",
    year: str = "release_year",
    free: str = "is_free",
) -> DataFrame:
    """Row count, gaps and means of a clean table, in one pass."""
    return items.agg(
        F.count("*").alias("games"),
        F.count_if(F.col(ratio).isNull()).alias("null_pos_ratio"),
        F.count_if(F.col(year).isNull()).alias("null_year"),
        _mean(ratio, 3).alias("avg_pos_ratio"),
        F.count_if(F.col(free)).alias("free_games"),
    )


def kpi_summary(
    items: DataFrame,
    shares: Mapping[str, str] = KPI_SHARES,
    *,
    free: str = "is_free",
    ratio: str = "positive_ratio",
    price: str = "price",
) -> DataFrame:
    """The KPI record: counts, mean ratio and flag shares from one pass, and the exact median."""
    n_free = F.count_if(F.col(free))
    return items.agg(
        F.count("*").alias("total_games"),
        n_free.alias("free_games"),
        (F.count("*") - n_free).alias("paid_games"),
        round_half_even(F.avg(ratio), 4).alias("avg_positive_ratio"),
        F.lit(exact_quantile(items, price, 0.5)).cast("double").alias("median_price_gbp"),
        *[round_half_even(_rate(flag, None), 3).alias(n) for n, flag in shares.items()],
    )


def kpi_schema(shares: Mapping[str, str] = KPI_SHARES) -> str:
    """The KPI record's columns, for reading it back."""
    counts = "total_games bigint, free_games bigint, paid_games bigint"
    return ", ".join([counts, "avg_positive_ratio double, median_price_gbp double", *(f"{quoted(n)} double" for n in shares)])
