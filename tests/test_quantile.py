import math
import random
import uuid
from decimal import Decimal

import pytest

from tallyshelf.operators import quantile
from tallyshelf.operators.quantile import exact_quantile


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x double").repartition(3)


def brute(values, q):
    known = sorted(v for v in values if v is not None and v == v)
    return known[max(math.ceil(q * len(known)), 1) - 1] if known else None


def test_even_count_gives_an_element_not_a_mean(spark):
    assert exact_quantile(frame(spark, [4.0, 1.0, 3.0, 2.0]), "x", 0.5) == 2.0


@pytest.mark.parametrize("q, bins", [(0.0, 10_000), (0.1, 10), (0.5, 10), (1.0, 10)])
def test_against_sorting(spark, q, bins):
    draw = random.Random(11)
    values = [draw.choice([0.0, 3.99, draw.gauss(0, 50), draw.random()]) for _ in range(60)]
    assert exact_quantile(frame(spark, values), "x", q, bins, held=1) == brute(values, q)


def passes(spark, run):
    """Jobs that ``run`` starts: two for each aggregate, two aggregates a pass and one before."""
    group = f"counted-{uuid.uuid4()}"
    spark.sparkContext.setJobGroup(group, "")
    run()
    found = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setJobGroup("other", "")
    return len(found)


def test_passes_do_not_grow_with_the_spread_of_values(spark):
    values = [2.0**e for e in range(-1045, 1024)] + [0.0] * 21
    df = frame(spark, values)
    assert exact_quantile(df, "x", 0.5, held=100) == brute(values, 0.5)
    even = frame(spark, [float(i) for i in range(len(values))])
    spread, plain = (passes(spark, lambda d=d: exact_quantile(d, "x", 0.37, 100, 100)) for d in (df, even))
    assert spread <= plain + 4


def test_whole_numbers_beyond_doubles_keep_their_type(spark):
    values = [2**53 + i for i in (0, 1, 3, 7)] + [2**62 + 1, -(2**62) - 1]
    df = spark.createDataFrame([(v,) for v in values * 5], "x bigint")
    for q in (0.1, 0.3, 0.5, 0.7):
        got = exact_quantile(df, "x", q, 10, 1)
        assert isinstance(got, int) and got == brute(values * 5, q)


def test_arguments_are_checked(spark):
    df = frame(spark, [1.0])
    for wrong in ({"bins": 1}, {"q": 2}, {"q": -0.1}, {"held": 0}):
        with pytest.raises(ValueError):
            exact_quantile(df, "x", **({"q": 0.5} | wrong))


def test_values_over_many_magnitudes(spark):
    values = [s * 10.0**e for s in (-1, 1) for e in range(-300, 301, 150)] + [0.0, 5e-324]
    values += [1.7976931348623157e308, -1.7976931348623157e308]
    for q in (0.5, 0.99):
        assert exact_quantile(frame(spark, values), "x", q) == brute(values, q)


def test_infinities_nulls_and_nans(spark):
    values = [math.inf, -math.inf, 1.0, 2.0, math.inf, None, math.nan]
    for q in (0.1, 0.4, 0.6, 1.0):
        assert exact_quantile(frame(spark, values), "x", q, 10, 1) == brute(values, q)
    assert exact_quantile(frame(spark, [math.inf, 1.7976931348623157e308]), "x", 0.5) == brute(
        [math.inf, 1.7976931348623157e308], 0.5
    )


def test_hot_value(spark):
    values = [3.99] * 500 + [random.Random(1).random() * 100 for _ in range(1000)]
    assert exact_quantile(frame(spark, values), "x", 0.5) == brute(values, 0.5)


def test_agrees_with_the_built_in_at_error_zero(spark):
    values = [float(i * 7919 % 1009) for i in range(500)]
    df = frame(spark, values)
    assert [exact_quantile(df, "x", q) for q in (0.25, 0.5)] == df.approxQuantile("x", [0.25, 0.5], 0)


def test_no_values(spark):
    assert exact_quantile(frame(spark, [None, math.nan]), "x", 0.5) is None


def test_decimals(spark):
    df = spark.createDataFrame([(i,) for i in range(40)], "i int").selectExpr("CAST(i AS decimal(20,2)) / 4 AS x")
    assert float(exact_quantile(df, "x", 0.5, 10, 1)) == 4.75


@pytest.mark.parametrize("scale", [2, 8, 13, 18, 37])
def test_decimals_of_any_scale_need_few_passes(spark, scale):
    draw, unit = random.Random(scale), Decimal(1).scaleb(-scale)
    values = [draw.randrange(10_000_000) * unit for _ in range(3000)] + [9999 * unit] * 500
    df = spark.createDataFrame([(v,) for v in values], f"x decimal(38,{scale})")
    for q in (0.0, 0.13, 0.5, 1.0):
        found = []
        jobs = passes(spark, lambda q=q, found=found: found.append(exact_quantile(df, "x", q, 100, 100)))
        assert found == [brute(values, q)]
        assert jobs <= 2 * (2 + 2 * 5)


def test_many_decimals_close_together(spark):
    values = [Decimal(i).scaleb(-8) for i in range(1, 11_001)] + [Decimal(5), Decimal(-5)]
    df = spark.createDataFrame([(v,) for v in values], "x decimal(20,8)")
    assert passes(spark, lambda: exact_quantile(df, "x", 0.5)) <= 2 * (2 + 2 * 5)
    assert exact_quantile(df, "x", 0.5) == brute(values, 0.5)


def test_decimals_with_all_digits(spark):
    wide = Decimal(10) ** 37
    values = [s * (wide + i) for s in (-1, 1) for i in range(40)] + [Decimal(i) for i in range(40)]
    df = spark.createDataFrame([(v,) for v in values], "x decimal(38,0)")
    for q in (0.1, 0.5, 0.9):
        assert exact_quantile(df, "x", q, 10, 1) == brute(values, q)


def test_passes_are_limited(spark, monkeypatch):
    monkeypatch.setattr(quantile, "MOST_PASSES", 1)
    with pytest.raises(RuntimeError):
        exact_quantile(frame(spark, [float(i) for i in range(5000)]), "x", 0.37, 10, 1)
