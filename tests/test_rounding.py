import random

from pyspark.sql import functions as F

from tallyshelf.functions.rounding import round_half_even, rounded


def test_half_even_equals_python_round(spark):
    draw = random.Random(5)
    values = [0.0625, 0.1875, 2.675, 0.4125, 0.4135, 1.0005, 12345.67895, -0.0625, 1234567.0, 0.9995]
    values += [draw.random() for _ in range(300)] + [draw.randrange(10**5) / 10**4 for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for digits in (3, 4):
        rows = df.select("x", round_half_even(F.col("x"), digits).alias("r")).collect()
        assert [r["r"] for r in rows] == [round(r["x"], digits) for r in rows]


def test_half_even_keeps_null(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert df.select(round_half_even(F.col("x"), 3)).first()[0] is None


def test_report_rounding_is_half_up_and_optional(spark):
    df = spark.createDataFrame([(0.0625,)], "x double")
    assert df.select(rounded(F.col("x"), 3), rounded(F.col("x"), None)).first() == (0.063, 0.0625)
