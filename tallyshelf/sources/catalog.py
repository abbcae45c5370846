"""Databases and external tables over Parquet folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyshelf.functions.names import quoted


def dotted(name: str) -> str:
    """A possibly dotted name, each part in back quotes."""
    return ".".join(map(quoted, name.split(".")))


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    where = f" LOCATION '{_text(location)}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {dotted(database)}{where}")


def drop_table(spark: SparkSession, table: str) -> None:
    """Forget an external table; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {dotted(table)}")


def external_table(
    spark: SparkSession, table: str, path: str, *, partitioned: bool = False
) -> None:
    """(Re)create a table over the Parquet files at ``path``, schema taken from them.

    A table over partition folders has no rows until its partitions are
    registered. Registering them keeps partition pruning, which a flat copy of
    the data loses.
    """
    drop_table(spark, table)
    spark.sql(f"CREATE TABLE {dotted(table)} USING PARQUET LOCATION '{_text(path)}'")
    if partitioned:
        spark.sql(f"MSCK REPAIR TABLE {dotted(table)}")


def tables_in(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {dotted(database)}")


def _text(value: str) -> str:
    return value.replace("\\", "\\\\").replace("'", "\\'")
