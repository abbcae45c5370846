"""Readers for feeds, clean tables and exported results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import types as T


#: What stands for NULL in the CSV files the library writes; an empty field is an empty text.
NULL_MARK = "\\N"


def string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_feed(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    *,
    free_text: bool = False,
    null: str = "",
) -> DataFrame:
    """Headered CSV with every column as text.

    With ``columns`` the layout is fixed and nothing is read to plan the scan;
    without, the names come from the header line, which suits a wide matrix
    whose columns change. Either way every file's header must have these names in
    this order, or the read fails; a field is never taken for another. ``null`` is
    the text that stands for NULL, an empty field by default. Quotes inside a quoted field are doubled, as the CSV
    standard has it: with Spark's backslash default such a field is cut and
    shifts the rest of its row. ``free_text`` allows line breaks inside fields;
    it makes each file one task, so use it only for feeds that need it.
    """
    reader = _csv(spark, null).option("multiLine", free_text)
    if columns is not None:
        reader = reader.schema(string_schema(columns))
    return reader.csv(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Parquet, flat or partitioned; partition columns get their type back."""
    return spark.read.parquet(path)


def read_result(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A result written by ``save_result``."""
    return _csv(spark, NULL_MARK).schema(schema).csv(path)


def read_record(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A record written by ``save_record``."""
    return spark.read.schema(schema).json(path)


def _csv(spark: SparkSession, null: str) -> DataFrameReader:
    reader = spark.read.option("header", True).option("enforceSchema", False).option("escape", '"')
    return reader.option("nullValue", null)


def register_views(spark: SparkSession, **tables: DataFrame) -> None:
    """Make tables known to ``spark.sql`` by name for this session."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
