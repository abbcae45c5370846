"""Which tags stand on the same items: exact pair counts over a long table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyshelf.functions.names import named

#: Tags of one item that are paired in one group.
BLOCK = 256


def item_pairs(long: DataFrame, key: str, tag: str, *, block: int = BLOCK) -> DataFrame:
    """``(key, tag_a, tag_b)`` with ``tag_a < tag_b``: every pair of tags of every item, once.

    ``long`` has a row per item and tag; repeated rows count once, rows with a NULL
    key or tag give no pair. An item's tags are dealt into blocks of about ``block``
    by hash, and each two of its blocks are one group: an item with any number of
    tags is paired by many tasks, none of which holds more than two blocks. No tag
    is left out.
    """
    if block < 1:
        raise ValueError("block must be 1 or more")
    rows = long.select(named(key).alias("key"), named(tag).alias("tag"))
    rows = rows.filter("key IS NOT NULL AND tag IS NOT NULL").distinct()
    sizes = rows.groupBy("key").agg(F.ceil(F.count("*") / block).cast("bigint").alias("blocks"))
    own = F.pmod(F.xxhash64("tag"), F.col("blocks"))
    dealt = rows.join(sizes, "key").select(
        "key", "tag", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other")
    )
    low, high = F.least("own", "other"), F.greatest("own", "other")
    # A pair within a block belongs to the group of that block with itself.
    side = F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2)
    # Spark would merge such groups by their bytes, but each gives the square of its rows: their
    # number of partitions is kept.
    width = int(long.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = dealt.withColumns({"low": low, "high": high}).repartition(width, "key", "low", "high")
    groups = dealt.groupBy("key", "low", "high").agg(
        F.collect_list(F.when(side != 2, F.col("tag"))).alias("first"),
        F.collect_list(F.when(side != 1, F.col("tag"))).alias("second"),
    )
    pairs = groups.select("key", "low", "high", F.explode("first").alias("x"), "second").select(
        "key", "low", "high", "x", F.explode("second").alias("y")
    )
    pairs = pairs.filter((F.col("low") < F.col("high")) | (F.col("x") < F.col("y")))
    return pairs.select("key", F.least("x", "y").alias("tag_a"), F.greatest("x", "y").alias("tag_b"))


def tag_pairs(long: DataFrame, key: str, tag: str, *, least: int = 1, block: int = BLOCK) -> DataFrame:
    """``(tag_a, tag_b, n_both, n_a, n_b, n_items, jaccard, lift)``: each pair found on ``least`` items or more.

    ``n_both`` counts the items with both tags, ``n_a`` and ``n_b`` those with each,
    ``n_items`` all that have a tag; ``jaccard`` is the share of the items with
    either that have both, ``lift`` how many times more items have both than if
    the tags were independent. Pairs are counted in the task that makes them, so
    at most one row per pair and task is shuffled; the counts per tag are joined,
    not broadcast by hand. No pairs give an empty table.
    """
    rows = long.select(named(key).alias("key"), named(tag).alias("tag"))
    rows = rows.filter("key IS NOT NULL AND tag IS NOT NULL").distinct()
    both = item_pairs(rows, "key", "tag", block=block).groupBy("tag_a", "tag_b").agg(F.count("*").alias("n_both"))
    if least > 1:
        both = both.filter(F.col("n_both") >= least)
    each = rows.groupBy("tag").agg(F.count("*").alias("n"))
    items = rows.agg(F.count_distinct("key")).scalar()
    counted = (
        both.join(each.select(F.col("tag").alias("tag_a"), F.col("n").alias("n_a")), "tag_a")
        .join(each.select(F.col("tag").alias("tag_b"), F.col("n").alias("n_b")), "tag_b")
        .withColumn("n_items", items)
    )
    either = F.col("n_a") + F.col("n_b") - F.col("n_both")
    expected = F.col("n_a").cast("double") * F.col("n_b")
    return counted.select(
        "tag_a", "tag_b", "n_both", "n_a", "n_b", "n_items",
        (F.col("n_both") / either).alias("jaccard"),
        (F.col("n_both").cast("double") * F.col("n_items") / expected).alias("lift"),
    )


def related_tags(pairs: DataFrame, k: int, measure: str = "jaccard") -> DataFrame:
    """``(tag, related, n_both, <measure>, rank)``: for each tag the ``k`` others it goes with most.

    Ties go to more common items, then by name. Ranked in parts before the shuffle, as
    only the first ``k`` of a group are kept.
    """
    sides = [("tag_a", "tag_b"), ("tag_b", "tag_a")]
    mirrored = pairs.select(
        F.explode(F.array(*[F.struct(F.col(a).alias("tag"), F.col(b).alias("related")) for a, b in sides])).alias("p"),
        "n_both",
        measure,
    ).select("p.*", "n_both", measure)
    order = Window.partitionBy("tag").orderBy(F.desc(measure), F.desc("n_both"), "related")
    ranked = mirrored.withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= k)
