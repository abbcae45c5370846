"""Equal-width histogram."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyshelf.functions.names import named


def equal_width_histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """``(bin, bin_low, bin_high, n)`` for ``bins`` equal bins over [min, max].

    Bins are closed on the left, the last one on both sides. A column with one
    value gets a range of 1 around it. Empty bins appear with 0; NULL, NaN and
    infinite values are in none. Two scans of one column (the range, then the counts) and
    a shuffle of at most ``bins`` rows per task; no value reaches the driver.
    """
    x = named(column).cast("double")
    values = df.select(x.alias("x")).filter(F.abs("x") < float("inf"))
    extent = values.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    pad = F.when(F.col("lo") == F.col("hi"), F.lit(0.5)).otherwise(F.lit(0.0))
    edges = extent.select(F.struct((F.col("lo") - pad).alias("lo"), (F.col("hi") + pad).alias("hi")))

    def edge(i):
        exact = F.col("e.lo") + i * ((F.col("e.hi") - F.col("e.lo")) / bins)
        return F.when(i == bins, F.col("e.hi")).otherwise(exact)

    # The quotient can land one bin off at an edge; the edges decide.
    last = F.lit(bins - 1)
    guess = F.least(F.floor((F.col("x") - F.col("e.lo")) / (F.col("e.hi") - F.col("e.lo")) * bins), last)
    counted = (
        values.select("x", edges.scalar().alias("e"))
        .withColumn("b", guess.cast("int"))
        .select(
            F.when(F.col("x") < edge(F.col("b")), F.col("b") - 1)
            .when((F.col("b") < last) & (F.col("x") >= edge(F.col("b") + 1)), F.col("b") + 1)
            .otherwise(F.col("b"))
            .alias("bin"),
            F.lit(1).alias("w"),
        )
    )
    every_bin = df.sparkSession.range(0, bins, 1, 1).select(
        F.col("id").cast("int").alias("bin"), F.lit(0).alias("w")
    )
    counts = counted.unionByName(every_bin).groupBy("bin").agg(F.sum("w").alias("n"))
    return (
        counts.select("bin", "n", edges.scalar().alias("e"))
        .select("bin", edge(F.col("bin")).alias("bin_low"), edge(F.col("bin") + 1).alias("bin_high"), "n")
    )
