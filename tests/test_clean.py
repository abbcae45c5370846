"""Cleaning rules, one awkward feed row each."""

import datetime

import pytest
from pyspark.sql import functions as F

from feeds import HEADER, store_csv
from tallyshelf.functions.derive import token_count, tokens
from tallyshelf.operators.clean import clean
from tallyshelf.sources.readers import read_feed
from tallyshelf.spec import CatalogSpec


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("feed") / "items.csv"
    path.write_text(store_csv())
    return read_feed(spark, str(path), HEADER.split(","))


@pytest.fixture(scope="module")
def items(feed):
    return {r["appid"]: r for r in clean(feed).collect()}


def test_schema(feed):
    assert clean(feed).dtypes == [
        ("appid", "int"), ("name", "string"), ("release_date", "date"), ("english", "int"),
        ("developer", "string"), ("publisher", "string"), ("platforms", "string"),
        ("required_age", "int"), ("categories", "string"), ("genres", "string"),
        ("tags", "string"), ("achievements", "int"), ("positive_ratings", "bigint"),
        ("negative_ratings", "bigint"), ("average_playtime", "int"), ("median_playtime", "int"),
        ("owners", "string"), ("price", "double"), ("release_year", "int"),
        ("total_ratings", "bigint"), ("positive_ratio", "double"), ("is_free", "boolean"),
        ("owners_low", "bigint"), ("owners_high", "bigint"), ("owners_mid", "bigint"),
        ("num_genres", "int"), ("num_categories", "int"), ("num_platforms", "int"),
        ("on_windows", "boolean"), ("on_mac", "boolean"), ("on_linux", "boolean"),
    ]


def test_rows_without_id_or_name_go_and_duplicates_merge(items):
    assert sorted(items) == [10, 11, 12, 20, 30, 40, 50, 60, 70, 80]


def test_plain_row(items):
    row = items[10]
    assert row["release_date"] == datetime.date(2015, 3, 1) and row["release_year"] == 2015
    assert (row["total_ratings"], row["positive_ratio"]) == (100, 0.9)
    assert (row["owners_low"], row["owners_high"], row["owners_mid"]) == (100, 200, 150)
    assert (row["num_genres"], row["num_categories"], row["num_platforms"]) == (2, 2, 3)
    assert (row["on_windows"], row["on_mac"], row["on_linux"]) == (True, True, True)


def test_quoted_fields_with_quotes_and_commas_stay_whole(items):
    assert items[20]["name"] == 'He said "hi", then left'
    assert items[20]["developer"] == 'A, "B" Co'
    assert items[20]["price"] == 0.0 and items[20]["is_free"] is True


def test_backslash_escape_would_shift_columns(spark, tmp_path):
    path = tmp_path / "items.csv"
    path.write_text(store_csv())
    plain = spark.read.option("header", True).csv(str(path)).filter("appid = '20'").first()
    assert plain["release_date"] != "2016-07-09"


def test_bad_dates_are_null(items):
    for key in (30, 40):
        assert items[key]["release_date"] is None and items[key]["release_year"] is None


def test_bad_numbers_are_null_and_fractions_are_cut(items):
    assert items[40]["achievements"] is None
    assert items[50]["price"] is None and items[50]["is_free"] is None
    assert items[12]["achievements"] == 1


def test_negative_price_becomes_zero_but_not_free(items):
    assert items[60]["price"] == 0.0 and items[60]["is_free"] is False


def test_intervals(items):
    def bounds(key):
        return tuple(items[key][f"owners_{end}"] for end in ("low", "high", "mid"))

    assert bounds(30) == (20, 41, 30)
    assert bounds(70) == (None, None, None)
    assert bounds(80) == (5, None, None)


def test_no_ratings_no_ratio(items):
    assert items[80]["total_ratings"] == 0 and items[80]["positive_ratio"] is None


def test_platform_flag_is_a_substring_test(items):
    assert items[60]["on_mac"] is True
    assert items[80]["on_windows"] is None


def test_survivor_of_duplicates_is_the_lowest_row(items):
    assert items[11]["positive_ratings"] == 5


def test_token_counts_of_null(spark, feed, items):
    assert items[80]["num_genres"] is None
    legacy = {r["appid"]: r["num_genres"] for r in clean(feed, null_count=-1).collect()}
    assert legacy[80] == -1 and legacy[10] == 2
    df = spark.createDataFrame([("a;;b; ",), ("",)], "t string")
    assert [r[0] for r in df.select(token_count(F.col("t"), ";")).collect()] == [4, 1]


def test_delimiters_are_not_patterns(spark):
    df = spark.createDataFrame([("a|b.c||d",)], "t string")
    assert df.select(tokens(F.col("t"), "|")).first()[0] == ["a", "b.c", "", "d"]
    assert df.select(tokens(F.col("t"), "||")).first()[0] == ["a|b.c", "d"]
    assert df.select(tokens(F.col("t"), ".")).first()[0] == ["a|b", "c||d"]


def test_typed_input_gives_the_same_as_text(spark):
    text = spark.createDataFrame(
        [("1", "n", "2015-02-03", "3", "1", "2.5")],
        "appid string, name string, release_date string, positive_ratings string, "
        "negative_ratings string, price string",
    )
    typed = text.selectExpr(
        "int(appid) appid", "name", "date(release_date) release_date",
        "bigint(positive_ratings) positive_ratings", "int(negative_ratings) negative_ratings",
        "double(price) price",
    )
    assert clean(typed, partial=True).collect() == clean(text, partial=True).collect()


def test_missing_columns_are_an_error(spark):
    with pytest.raises(ValueError, match="genres"):
        clean(spark.createDataFrame([("1", "n")], "appid string, name string"))


def test_other_feed_layouts(spark):
    spec = CatalogSpec(
        key="sku", label="title", types={"cost": "double"}, price="cost", free="gratis",
        token_counts={}, flags={"eu": ("zones", "EU")},
    )
    feed = spark.createDataFrame([("5", "t", "0", "EU;US")], "sku string, title string, cost string, zones string")
    row = clean(feed, spec, partial=True).first()
    assert row.asDict() == {
        "sku": 5, "title": "t", "cost": 0.0, "zones": "EU;US", "gratis": True, "eu": True
    }
