import pytest
from pyspark.sql import functions as F

from tallyshelf.functions.bands import ACHIEVEMENT_BANDS, PRICE_BANDS, PRICE_TIERS
from tallyshelf.operators.grouped import by_band, last_by, ranked, top_k


@pytest.mark.parametrize(
    "bands, cases",
    [
        (
            PRICE_BANDS,
            {0.0: "0 Free", 0.01: "<5", 4.99: "<5", 5.0: "5-10", 10.0: "10-20", 19.99: "10-20",
             20.0: "20-40", 40.0: "40+", 400.0: "40+", None: "40+"},
        ),
        (PRICE_TIERS, {0.0: "free", 9.99: "low", 10.0: "mid", 29.99: "mid", 30.0: "high", None: "high"}),
        (
            ACHIEVEMENT_BANDS,
            {0.0: "0", 1.0: "1-10", 10.0: "1-10", 11.0: "11-50", 50.0: "11-50", 51.0: "51-100",
             100.0: "51-100", 101.0: "100+", None: "100+"},
        ),
    ],
)
def test_edges(spark, bands, cases):
    df = spark.createDataFrame([(k,) for k in cases], "x double")
    assert {r[0]: r[1] for r in df.select("x", bands.label(F.col("x"))).collect()} == cases


def test_empty_bands_are_kept_on_request(spark):
    df = spark.createDataFrame([(0.0, 1.0), (7.0, 0.5), (8.0, None)], "price double, r double")
    measures = {"avg_r": F.avg("r")}
    kept = by_band(df, "price", PRICE_BANDS, "band", measures, position="at", keep_empty=True)
    assert kept.orderBy("at").collect() == [
        (0, "0 Free", 1, 1.0),
        (1, "<5", 0, None),
        (2, "5-10", 2, 0.5),
        (3, "10-20", 0, None),
        (4, "20-40", 0, None),
        (5, "40+", 0, None),
    ]
    plain = by_band(df, "price", PRICE_BANDS, "band", measures)
    assert sorted(plain.collect()) == [("0 Free", 1, 1.0), ("5-10", 2, 0.5)]


def test_ranking_breaks_ties_by_name(spark):
    df = spark.createDataFrame([("b", 3), ("a", 3), ("c", 9), ("d", 1)], "name string, n int")
    assert [r["name"] for r in top_k(df, "n", 3, "name").collect()] == ["c", "a", "b"]
    assert [r["name"] for r in ranked(df, "n", "name").collect()] == ["c", "a", "b", "d"]
    assert [r["n"] for r in last_by(df.select("n").distinct(), "n", 2).collect()] == [3, 9]


def test_nulls_rank_last(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0)], "name string, x double")
    assert [r["name"] for r in ranked(df, "x", "name").collect()] == ["b", "a"]
