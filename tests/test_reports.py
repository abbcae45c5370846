"""Reports on a small clean table: hand-checked values, SQL equivalence, invariants."""

import pytest
from pyspark.sql import functions as F

from tallyshelf.plans import reports
from tallyshelf.sources.readers import register_views

COLUMNS = (
    "appid int, release_year int, developer string, publisher string, genres string, "
    "price double, is_free boolean, positive_ratings bigint, total_ratings bigint, "
    "positive_ratio double, average_playtime int, achievements int, owners_mid bigint, "
    "on_windows boolean, on_mac boolean, on_linux boolean"
)
ROWS = [
    (1, 2014, "A", "P", "Action;Indie", 0.0, True, 90, 100, 0.9, 60, 0, 10, True, True, False),
    (2, 2014, "A", "P", "Action", 4.99, False, 50, 100, 0.5, 120, 5, 20, True, False, False),
    (3, 2015, "B", "Q", "Indie", 5.0, False, 10, 40, 0.25, 30, 11, 30, True, True, True),
    (4, 2015, "B", None, None, 0.0, False, 30, 60, 0.5, 0, 101, 40, True, None, True),
    (5, None, None, "Q", "RPG; ", None, None, 0, 0, None, 10, 3, None, None, None, None),
    (6, 2019, "C;D", "R", "Action;RPG", 60.0, False, 70, 80, 0.875, 600, 60, 60, True, False, False),
    (7, 2020, "E", "R", "Indie", 70.0, False, 5, 50, 0.1, 90, None, 70, True, False, True),
]


@pytest.fixture(scope="module")
def items(spark):
    df = spark.createDataFrame(ROWS, COLUMNS).cache()
    yield df
    df.unpersist()


@pytest.fixture(scope="module")
def tags(spark):
    rows = [(1, "indie", 7), (1, "fps", 3), (2, "fps", 4), (3, "rpg", 9)]
    return spark.createDataFrame(rows, "appid int, tag string, votes int")


def test_years(items):
    assert reports.releases_by_year(items).collect() == [(2014, 2), (2015, 2), (2019, 1)]
    assert reports.years_ranked(items).collect() == [(2014, 2), (2015, 2), (2019, 1)]
    assert reports.last_years(items, 2).collect() == [(2019, 1), (2020, 1)]
    assert reports.peak_year(items).collect() == [(2014, 2)]
    assert reports.share_since(items, 2015).collect() == [(4, 0.6667)]


def test_genres(items):
    assert reports.genre_stats(items, 2).collect() == [("Action", 3, 0.758), ("Indie", 3, 0.417)]
    raw = {r["genre"]: r["avg_ratio"] for r in reports.genre_stats(items, digits=None).collect()}
    assert raw["Indie"] == pytest.approx(1.25 / 3) and raw["RPG"] == 0.875


def test_genre_playtime(items):
    stats = reports.genre_playtime(items, min_items=2)
    assert stats.columns == ["genre", "n", "avg_hours"]
    assert stats.collect() == [("Action", 3, 4.33), ("Indie", 2, 1.25)]
    raw = reports.genre_playtime(items, min_items=2, digits=None, with_minutes=True)
    assert raw.columns == ["genre", "n", "avg_min", "avg_hours"]
    assert raw.first()["avg_min"] == 260.0


def test_price_bands(items):
    rows = {r["price_band"]: r for r in reports.price_band_stats(items).collect()}
    assert {b: r["n"] for b, r in rows.items()} == {"0 Free": 2, "<5": 1, "5-10": 1, "40+": 3}
    assert rows["0 Free"]["avg_owners"] == 25.0 and rows["40+"]["avg_ratio"] == 0.488
    ordered = reports.price_band_stats(items, position="place", keep_empty=True).collect()
    assert [r["price_band"] for r in ordered] == ["0 Free", "<5", "5-10", "10-20", "20-40", "40+"]
    assert sum(r["n"] for r in ordered) == len(ROWS)


def test_price_tiers(items):
    tiers = reports.price_tier_stats(items).collect()
    assert tiers == [("free", 2, 0.7), ("high", 3, 0.488), ("low", 2, 0.375)]


def test_unknown_price_is_paid_only_as_the_rest(items):
    assert reports.free_paid_split(items).collect() == [(1, 5, 7, 6)]


def test_median_counts_free_items(items):
    assert reports.median_price(items).collect() == [(4.99,)]


def test_histogram_covers_paid_prices_up_to_the_limit(items):
    rows = reports.price_histogram(items, bins=2).collect()
    assert [(r["bin_low"], r["bin_high"], r["n"]) for r in rows] == [(4.99, 32.495, 2), (32.495, 60.0, 1)]


def test_makers(items):
    assert reports.top_developers(items, 3).collect() == [("A", 2), ("B", 2), ("C;D", 1)]
    assert reports.top_publishers(items, 2).collect() == [("P", 140), ("R", 75)]


def test_platforms(items):
    shares = reports.platform_share(items).collect()
    assert shares == [("win", 1.0), ("mac", 0.4), ("linux", 0.5)]
    rates = reports.platform_rate_by_year(items)
    assert rates.collect() == [(2014, 0.5, 0.0), (2015, 1.0, 1.0), (2019, 0.0, 0.0)]
    long = reports.platform_rate_long(rates).collect()
    assert sorted(long)[:2] == [(2014, "linux", 0.0), (2014, "mac", 0.5)] and len(long) == 6


def test_tags(tags):
    assert reports.top_tags(tags, 2).collect() == [("rpg", 9, 1), ("fps", 7, 2)]
    assert reports.top_tags(tags, 1, with_items=False).collect() == [("rpg", 9)]


def test_achievement_bands(items):
    rows = {r["ach_band"]: tuple(r)[1:] for r in reports.achievement_band_stats(items).collect()}
    assert rows == {
        "0": (1, 0.9, 1.0), "1-10": (1, 0.5, 2.0), "51-100": (1, 0.875, 10.0),
        "100+": (2, 0.3, 0.75),
    }


def test_quality_report(items):
    assert reports.quality_report(items).collect() == [(7, 1, 1, 0.521, 1)]


def test_kpis(items):
    record = reports.kpi_summary(items).first().asDict()
    assert record == {
        "total_games": 7, "free_games": 1, "paid_games": 6, "avg_positive_ratio": 0.5208,
        "median_price_gbp": 4.99, "win_pct": 1.0, "mac_pct": 0.4, "linux_pct": 0.5,
    }


def test_sql_over_views_gives_the_same(spark, items, tags):
    register_views(spark, games=items, tags_long=tags)
    # The published definitions, with their ranges and limits.
    cases = [
        (
            "SELECT release_year, count(*) AS n_games FROM games "
            "WHERE release_year BETWEEN 1997 AND 2019 GROUP BY release_year ORDER BY release_year",
            reports.releases_by_year(items),
        ),
        (
            "SELECT publisher, sum(positive_ratings) AS pos FROM games WHERE publisher IS NOT NULL "
            "GROUP BY publisher ORDER BY pos DESC, publisher LIMIT 12",
            reports.top_publishers(items),
        ),
        (
            "SELECT release_year, round(avg(CAST(on_mac AS INT)), 3) AS mac, "
            "round(avg(CAST(on_linux AS INT)), 3) AS linux FROM games "
            "WHERE release_year BETWEEN 2008 AND 2019 GROUP BY release_year ORDER BY release_year",
            reports.platform_rate_by_year(items),
        ),
        (
            "SELECT tag, sum(votes) AS total_votes, count(*) AS n_games FROM tags_long "
            "GROUP BY tag ORDER BY total_votes DESC, tag LIMIT 20",
            reports.top_tags(tags),
        ),
        (
            "SELECT genre, count(*) AS n, round(avg(positive_ratio), 3) AS avg_ratio "
            "FROM (SELECT explode(split(genres, ';')) AS genre, positive_ratio FROM games) "
            "WHERE length(trim(genre)) > 0 GROUP BY genre ORDER BY n DESC, genre LIMIT 12",
            reports.genre_stats(items),
        ),
    ]
    for text, result in cases:
        by_sql = spark.sql(text)
        assert by_sql.dtypes == result.dtypes
        assert by_sql.collect() == result.collect()


def test_empty_table(items, tags):
    none = items.limit(0)
    assert reports.genre_stats(none).collect() == []
    assert reports.quality_report(none).collect() == [(0, 0, 0, None, 0)]
    assert reports.kpi_summary(none).first()["median_price_gbp"] is None
    assert reports.top_tags(tags.limit(0)).collect() == []
    assert sum(r["n"] for r in reports.price_histogram(none).collect()) == 0


def test_hot_group_counts_in_full(spark):
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit("Hot")).otherwise(F.concat(F.lit("D"), F.col("id") % 50)).alias("developer")
    )
    top = reports.top_developers(rows, 1)
    assert top.collect() == [("Hot", 3000)]
