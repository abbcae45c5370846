"""Helpers that several operators of this package share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyshelf.functions.names import named
from tallyshelf.sources.scratch import scratch_folder

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def text_or_empty(column: str) -> Column:
    return F.coalesce(named(column).cast("string"), F.lit(""))


#: Folders that ``stored`` has written in this process, in order.
WRITTEN: list[str] = []


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared scratch folder and read back.

    Cuts the lineage: later stages, and reruns after a lost executor, read the
    same rows in files that all executors reach. The files stay until the caller
    discards them, as lazy results may still read them.
    """
    table, path = written(df, name)
    WRITTEN.append(path)
    return table


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As ``stored``, with the folder, for a step that discards it itself."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, folders: Sequence[str]) -> None:
    """Delete folders that no result reads any more."""
    context = spark.sparkContext
    for folder in folders:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def salt_of(columns: Sequence[Column], salts: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int")


def rank_in_group(
    df: DataFrame, group: str, order: Sequence[Column], salt: Column, rank: str = "rank"
) -> DataFrame:
    """``df`` with a gapless rank from 0 within each value of ``group``.

    Ranks go by ``salt``, then ``order``. Each salt of a group is numbered on its
    own and shifted by the counts of the salts before it, so a group with a third
    of all rows is spread over as many tasks as there are salts. ``group`` must
    not be NULL. ``df`` must be stable (a table that was written): its rows are
    read twice.
    """
    salted = df.withColumn("_salt", salt)
    earlier = Window.partitionBy(group).orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        salted.groupBy(group, "_salt")
        .agg(F.count("*").alias("_n"))
        .select(group, "_salt", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy(group, "_salt").orderBy(*order)
    numbered = salted.withColumn("_inside", F.row_number().over(inside) - 1)
    return (
        numbered.join(before, [group, "_salt"])
        .withColumn(rank, (F.col("_before") + F.col("_inside")).cast("bigint"))
        .drop("_salt", "_before", "_inside")
    )


def cells(low: Column, high: Column, width: int) -> Column:
    """Numbers of the cells of ``width`` that meet the whole numbers ``low`` to ``high`` inclusive."""
    return F.sequence(F.floor(low / width), F.floor(high / width))
