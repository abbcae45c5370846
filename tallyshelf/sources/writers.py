"""Writers for clean tables and small results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyshelf.sources.readers import NULL_MARK


def write_table(df: DataFrame, path: str) -> None:
    """Flat Parquet, replacing what is there."""
    df.write.mode("overwrite").parquet(path)


def write_partitioned(df: DataFrame, path: str, *columns: str) -> None:
    """Parquet in one folder per value of ``columns``; NULL has its own folder.

    Without a shuffle every task would write a file into every folder. Hashing
    on the columns instead would put the largest value into one task. The
    rebalance hint does neither: AQE splits a partition above its advisory size,
    so a value with a third of all rows is written by many tasks, and merges
    small ones.
    """
    df.hint("rebalance", *columns).write.mode("overwrite").partitionBy(*columns).parquet(path)


def flatten_table(spark: SparkSession, source: str, target: str) -> None:
    """Copy a partitioned table into a flat one, partition columns becoming data columns."""
    write_table(spark.read.parquet(source), target)


def write_csv(df: DataFrame, path: str, null: str = NULL_MARK) -> None:
    """Headered CSV that reads back as it was: white space kept, NULL told from empty text.

    A text that equals ``null`` would read back as NULL.
    """
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"')
    for side in ("Leading", "Trailing"):
        writer = writer.option(f"ignore{side}WhiteSpace", False)
    writer.option("nullValue", null).csv(path)


def save_result(df: DataFrame, path: str, *order: str, drop: Sequence[str] = ()) -> None:
    """A small result as one headered CSV file in folder ``path``.

    ``order`` are sort columns, ``-`` in front for descending; ``drop`` are
    columns only used to sort. The shuffle to one
    partition keeps the work before it parallel, which ``coalesce(1)`` would
    not; it is for reports of bounded size (bands, years, top-k).
    """
    keys = [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in order]
    single = df.repartition(1)
    if keys:
        single = single.sortWithinPartitions(*keys)
    single = single.drop(*drop)
    write_csv(single, path)


def save_record(df: DataFrame, path: str) -> None:
    """A one-row result as a JSON object in folder ``path``."""
    df.repartition(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)
