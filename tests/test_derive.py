from pyspark.sql import functions as F

from tallyshelf.functions.derive import interval_bounds
from tallyshelf.operators.clean import derive_columns
from tallyshelf.spec import CatalogSpec


def test_interval_ends_cut_fractions(spark):
    rows = [("1.5-2.5",), ("10-20",), ("x-3",), ("7",), (None,)]
    df = spark.createDataFrame(rows, "t string").select(*interval_bounds(F.col("t"), "-"))
    assert [tuple(r) for r in df.collect()] == [(1, 2), (10, 20), (None, 3), (7, None), (None, None)]


def test_names_with_dots(spark):
    spec = CatalogSpec(key="a.id", label="a.name", date="a.day", price="a.price", interval="a.own", token_counts={"n": "a.g"}, flags={})
    df = spark.createDataFrame([(1, "x", "1-3", -2.0, "p;q")], ["a.id", "a.name", "a.own", "a.price", "a.g"])
    row = derive_columns(df, spec).first().asDict()
    assert (row["a.own_mid"], row["a.price"], row["n"]) == (2, 0.0, 2)
