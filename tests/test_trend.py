import random
from datetime import date
from statistics import median

import pytest
from pyspark.sql import functions as F

from tallyshelf.operators.trend import period_series, trend_test, with_change


def series(spark, rows, **more):
    df = spark.createDataFrame(rows, "g string, day date, x int")
    measures = {"n": F.count("*"), "total": F.sum("x"), "top": F.max("x")}
    return period_series(df, "day", measures, zero=["n", "total"], **more)


def d(text):
    return date.fromisoformat(text)


ROWS = [("a", d("2020-01-05"), 1), ("a", d("2020-01-31"), 2), ("a", d("2020-04-01"), None), ("b", d("2020-03-10"), 5), (None, d("2020-02-29"), 7), ("a", None, 9)]


def test_gaps_are_filled(spark):
    got = [tuple(r) for r in series(spark, ROWS).orderBy("period").collect()]
    assert got == [
        (d("2020-01-01"), 2, 3, 2, False),
        (d("2020-02-01"), 1, 7, 7, False),
        (d("2020-03-01"), 1, 5, 5, False),
        (d("2020-04-01"), 1, 0, None, False),
    ]
    sparse = [tuple(r) for r in series(spark, [r for r in ROWS if r[0] == "a"]).orderBy("period").collect()]
    assert [r[1:] for r in sparse] == [(2, 3, 2, False), (0, 0, None, True), (0, 0, None, True), (1, 0, None, False)]


def test_groups_share_the_calendar(spark):
    got = series(spark, ROWS, by=["g"])
    assert got.count() == 12 and got.filter("is_filled").count() == 8
    assert got.filter("g IS NULL AND NOT is_filled").select("total").collect() == [(7,)]


@pytest.mark.parametrize(
    "period, first, last, n",
    [("day", "2020-01-05", "2020-04-01", 88), ("week", "2019-12-30", "2020-03-30", 14), ("quarter", "2020-01-01", "2020-04-01", 2), ("year", "2020-01-01", "2020-01-01", 1)],
)
def test_periods(spark, period, first, last, n):
    got = series(spark, ROWS, period=period).agg(F.min("period"), F.max("period"), F.count("*"), F.sum("n")).first()
    assert tuple(got) == (d(first), d(last), n, 5)


def test_given_bounds(spark):
    got = series(spark, ROWS, first=d("2019-12-15"), last=d("2020-02-10")).orderBy("period").collect()
    assert [(str(r.period), r.n, r.is_filled) for r in got] == [("2019-12-01", 0, True), ("2020-01-01", 2, False), ("2020-02-01", 1, False)]


def test_empty_table(spark):
    assert series(spark, []).count() == 0 == series(spark, [], by=["g"]).count()
    assert trend_test(series(spark, [], by=["g"]), "n", by=["g"]).count() == 0


def test_change(spark):
    rows = [("a", date(2019 + m // 12, m % 12 + 1, 3), v) for m, v in enumerate([4, 0, 6, 3, 3, 9, 1, 1, 1, 1, 1, 1, 8])]
    got = with_change(series(spark, rows), "total").orderBy("period").collect()
    assert [r.previous for r in got][:4] == [None, 4, 0, 6]
    assert [r.growth for r in got][:5] == [None, -1.0, None, -0.5, 0.0]
    assert [r.moving_mean for r in got][:4] == [None, None, 10 / 3, 3.0]
    assert [r.year_before for r in got][-2:] == [None, 4]
    assert got[-1].running_total == 39


def test_change_by_group(spark):
    got = with_change(series(spark, ROWS, by=["g"]), "n", by=["g"], width=1).filter("g = 'b'").orderBy("period").collect()
    assert [(r.previous, r.moving_mean, r.running_total) for r in got] == [(None, 0.0, 0), (0, 0.0, 0), (0, 1.0, 1), (1, 0.0, 1)]


def brute(values):
    points = [(t, y) for t, y in enumerate(values) if y is not None]
    pairs = [(a, b) for i, a in enumerate(points) for b in points[i + 1 :]]
    n, s = len(points), sum((b[1] > a[1]) - (b[1] < a[1]) for a, b in pairs)
    if n < 2:
        return (n, None, None, None, None, None, None)
    ys = [y for _, y in points]
    spread = n * (n - 1) * (2 * n + 5) - sum(c * (c - 1) * (2 * c + 5) for c in (ys.count(v) for v in set(ys)))
    z = (s - (s > 0) + (s < 0)) / (spread / 18) ** 0.5 if spread else 0.0
    slope = median((b[1] - a[1]) / (b[0] - a[0]) for a, b in pairs)
    rest = median(y - slope * t for t, y in points)
    return (n, s, s / (n * (n - 1) / 2), z, slope, rest, "rising" if z > 1.96 else "falling" if z < -1.96 else "none")


def test_against_all_pairs(spark):
    draw = random.Random(2)
    groups = {
        "up": [t + draw.random() * 5 for t in range(30)],
        "down": [-2.0 * t for t in range(12)],
        "flat": [3.0] * 9,
        "ties": [float(draw.randrange(3)) for _ in range(25)],
        "gaps": [None, 1.0, None, 2.0, 5.0, None],
        "one": [None, 4.0],
        "two": [4.0, 1.0],
        "none": [None, None],
    }
    rows = [(g, date(2000 + t, 1, 1), y) for g, ys in groups.items() for t, y in enumerate(ys)]
    df = spark.createDataFrame(rows, "g string, period date, y double").repartition(5)
    got = {r.g: tuple(r)[1:] for r in trend_test(df, "y", by=["g"]).collect()}
    assert set(got) == set(groups)
    for g, ys in groups.items():
        want = brute(ys)
        assert got[g][-1] == want[-1], g
        assert got[g][:-1] == pytest.approx(want[:-1]) if want[0] > 1 else got[g] == want, g
    assert (got["up"][-1], got["down"][-1], got["flat"][-1]) == ("rising", "falling", "none")


def test_without_groups(spark):
    rows = [(date(2000 + t, 1, 1), t * t) for t in range(8)]
    (row,) = trend_test(spark.createDataFrame(rows, "period date, y int"), "y").collect()
    assert tuple(row) == pytest.approx(brute([t * t for t in range(8)]))
