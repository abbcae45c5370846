"""The batch jobs: clean a feed, publish it as tables, export the reports.

Each job but ``export_job`` reads files that the step before has written, so the
feed is cleaned once and a lost executor costs only the running stage.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyshelf.functions.bands import ACHIEVEMENT_BANDS, Bands
from tallyshelf.operators.clean import clean
from tallyshelf.operators.reshape import melt_votes
from tallyshelf.plans import reports
from tallyshelf.sources.catalog import ensure_database, external_table, tables_in
from tallyshelf.sources.readers import read_feed, read_table
from tallyshelf.sources.writers import (
    flatten_table,
    save_record,
    save_result,
    write_partitioned,
    write_table,
)
from tallyshelf.spec import CatalogSpec

# Names of the exported results, which their readers rely on,
# and the folders of the clean and the warehouse zone.
GAMES = "games"
TAGS = "tags_long"
SUMMARY = "summary"


def clean_job(
    spark: SparkSession,
    items_csv: str,
    tags_csv: str,
    clean_zone: str,
    spec: CatalogSpec = CatalogSpec(),
    *,
    null_count: int | None = None,
) -> DataFrame:
    """Write the clean table by year and the long tag table; return the quality report."""
    items = clean(read_feed(spark, items_csv), spec, null_count=null_count)
    write_partitioned(items, f"{clean_zone}/{GAMES}", spec.year)
    tags = melt_votes(read_feed(spark, tags_csv), spec.key, key_type=spec.key_type)
    write_table(tags, f"{clean_zone}/{TAGS}")
    written = read_table(spark, f"{clean_zone}/{GAMES}")
    return reports.quality_report(written, ratio=spec.ratio, year=spec.year, free=spec.free)


def row_counts(
    spark: SparkSession, items_csv: str, clean_zone: str
) -> DataFrame:
    """Rows of the feed, the clean table and the tag table.

    A separate step: counters carried along with the write count the rows of a
    repeated task twice. Parquet counts come from the file footers.
    """
    sources = {
        "raw": read_feed(spark, items_csv),
        "clean": read_table(spark, f"{clean_zone}/{GAMES}"),
        "tags": read_table(spark, f"{clean_zone}/{TAGS}"),
    }
    counts = [
        df.agg(F.lit(name).alias("table"), F.count("*").alias("n")) for name, df in sources.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def publish_job(
    spark: SparkSession,
    clean_zone: str,
    database: str,
    *,
    warehouse_zone: str | None = None,
    location: str | None = None,
) -> DataFrame:
    """Make both clean tables external tables of ``database``; return its table list.

    By default the item table stays partitioned by year and its partitions are
    registered. With ``warehouse_zone`` it is copied there as a flat table.
    """
    ensure_database(spark, database, location)
    games = f"{clean_zone}/{GAMES}"
    if warehouse_zone:
        flatten_table(spark, games, f"{warehouse_zone}/{GAMES}")
        games = f"{warehouse_zone}/{GAMES}"
    external_table(spark, f"{database}.{GAMES}", games, partitioned=warehouse_zone is None)
    external_table(spark, f"{database}.{TAGS}", f"{clean_zone}/{TAGS}")
    return tables_in(spark, database)


def export_job(
    items: DataFrame,
    tags: DataFrame,
    out: str,
    *,
    first_year: int | None = None,
    last_year: int | None = None,
    rates: Mapping[str, str] = reports.PLATFORM_RATES,
    shares: Mapping[str, str] = reports.KPI_SHARES,
    min_ratings: int = 50,
    min_items: int = 30,
    achievement_bands: Bands = ACHIEVEMENT_BANDS,
) -> None:
    """Write the nine report files and the KPI record.

    Every report reads ``items`` or ``tags`` anew: pass tables that were read, as
    ``export_zone`` does; what a lazy frame stands for is computed each time. The band reports go out in band order. Without years the reports have their own ranges.
    """
    years = {} if first_year is None or last_year is None else {"first": first_year, "last": last_year}
    playtime = reports.genre_playtime(items, min_ratings=min_ratings, min_items=min_items)
    achievements = reports.achievement_band_stats(
        items, bands=achievement_bands, min_ratings=min_ratings, position="band"
    )
    results = {
        "q1_release": (reports.releases_by_year(items, **years), ["release_year"]),
        "q2_genre": (reports.genre_stats(items), ["-n", "genre"]),
        "q3_price": (reports.price_band_stats(items, position="band"), ["band"]),
        "q4_playtime": (playtime, ["-avg_hours", "genre"]),
        "q5_dev": (reports.top_developers(items), ["-n", "developer"]),
        "q5_pub": (reports.top_publishers(items), ["-pos", "publisher"]),
        "q6_platform": (reports.platform_rate_by_year(items, **years, flags=rates), ["release_year"]),
        "q7_tags": (reports.top_tags(tags), ["-total_votes", "tag"]),
        "q8_ach": (achievements, ["band"]),
    }
    for name, (result, order) in results.items():
        save_result(result, f"{out}/{name}", *order, drop=["band"])
    save_record(reports.kpi_summary(items, shares), f"{out}/{SUMMARY}")


def export_zone(spark: SparkSession, clean_zone: str, out: str, **options) -> None:
    """``export_job`` over the written tables of a clean zone, with its options."""
    items, tags = (read_table(spark, f"{clean_zone}/{name}") for name in (GAMES, TAGS))
    export_job(items, tags, out, **options)
