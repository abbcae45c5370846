import random

import numpy as np
import pytest

from tallyshelf.operators.histogram import equal_width_histogram


def histogram(spark, values, bins):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    return equal_width_histogram(df, "x", bins).orderBy("bin").collect()


@pytest.mark.parametrize("seed", range(4))
def test_counts_and_edges_equal_numpy(spark, seed):
    draw = random.Random(seed)
    values = [round(draw.random() * 60, draw.choice([0, 1, 2, 9])) for _ in range(800)]
    counts, edges = np.histogram(values, 40)
    rows = histogram(spark, values, 40)
    assert [r["n"] for r in rows] == counts.tolist()
    assert [r["bin_low"] for r in rows] == edges[:-1].tolist()
    assert [r["bin_high"] for r in rows] == edges[1:].tolist()


def test_values_on_the_edges(spark):
    values = np.linspace(0.1, 0.7, 41).tolist() * 2 + [0.4]
    assert [r["n"] for r in histogram(spark, values, 40)] == np.histogram(values, 40)[0].tolist()


def test_one_value(spark):
    counts, edges = np.histogram([3.0, 3.0], 4)
    rows = histogram(spark, [3.0, 3.0, None], 4)
    assert [r["n"] for r in rows] == counts.tolist()
    assert [r["bin_low"] for r in rows] == edges[:-1].tolist()


def test_no_values_gives_empty_bins(spark):
    rows = histogram(spark, [None], 3)
    assert [(r["bin"], r["n"], r["bin_low"]) for r in rows] == [(0, 0, None), (1, 0, None), (2, 0, None)]


def test_infinities_are_in_no_bin(spark):
    inf = float("inf")
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, inf, -inf, float("nan"), None)], "x double")
    rows = equal_width_histogram(df, "x", 2).orderBy("bin").collect()
    assert [(r.bin, r.bin_low, r.bin_high, r.n) for r in rows] == [(0, 1.0, 1.5, 1), (1, 1.5, 2.0, 1)]
