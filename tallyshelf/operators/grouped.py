"""Banded and ranked aggregation."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyshelf.functions.bands import Bands


def top_k(df: DataFrame, by: str, k: int, *ties: str) -> DataFrame:
    """The ``k`` highest rows by ``by``, ties broken by ``ties``.

    Planned as ``TakeOrderedAndProject``: each task keeps ``k`` rows, no full sort.
    """
    return ranked(df, by, *ties).limit(k)


def ranked(df: DataFrame, by: str, *ties: str) -> DataFrame:
    return df.orderBy(F.desc(by), *[F.asc(t) for t in ties])


def last_by(df: DataFrame, by: str, k: int) -> DataFrame:
    """The last ``k`` rows in ``by`` order, shown in that order."""
    return df.orderBy(F.desc(by)).limit(k).orderBy(by)


def by_band(
    df: DataFrame,
    column: str,
    bands: Bands,
    label: str,
    measures: Mapping[str, Column],
    *,
    position: str | None = None,
    keep_empty: bool = False,
) -> DataFrame:
    """Row count ``n`` and ``measures`` (aggregates) per band of ``column``.

    ``position`` names an extra column with the band's place in the display
    order. ``keep_empty`` adds bands without rows, with ``n`` 0 and NULL
    measures: one all-NULL row of weight 0 per band joins the input, so no join
    is needed. Measures must therefore ignore NULLs, as ``avg`` and ``sum`` do.
    """
    rows = df.select("*", bands.position(F.col(column)).alias("_band"), F.lit(1).alias("_weight"))
    if keep_empty:
        empty = df.sparkSession.range(0, len(bands.labels), 1, 1).select(
            F.col("id").cast("int").alias("_band"), F.lit(0).alias("_weight")
        )
        rows = rows.unionByName(empty, allowMissingColumns=True)
    grouped = rows.groupBy("_band").agg(
        F.sum("_weight").alias("n"), *[e.alias(n) for n, e in measures.items()]
    )
    result = grouped.withColumn(label, bands.label_at(F.col("_band")))
    if position:
        result = result.withColumn(position, F.col("_band"))
    order = [position] if position else []
    return result.select(*order, label, "n", *measures)
