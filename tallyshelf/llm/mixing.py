"""Mixing sources to target weights by a low-discrepancy schedule."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyshelf.functions.names import named
from tallyshelf.llm.common import stored

#: 2^32 divided by the golden ratio: its multiples modulo 2^32 spread evenly over [0, 2^32).
GOLDEN, CIRCLE, CELL = 2654435769, 1 << 32, 1 << 20
#: Blocks that the whole mix has, about; a block grows with the corpus.
SLOTS = 1 << 16
BUCKET_DIGITS = 3


def source_targets(sized: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """``(source, source_size, target)``: one row per source, by water filling.

    Sources in code-point order, NULL last, get the weights in turn. A target
    stops at ``most`` times its source's size; what is over is shared again by
    weight. Sources by falling room per weight: those whose limit lies under the
    common level stop at it. The window over all sources runs in one task over
    one row per source.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    choices = F.array(*[F.lit(float(w)) for w in weights])
    place = (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int")
    weighted = totals.withColumn("w", F.element_at(choices, place))
    weighted = weighted.withColumn("room", F.col("source_size") * float(most))
    by_room = Window.orderBy(F.col("room") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    level = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum("room").over(before), F.lit(0.0))
    ) / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    levelled = weighted.withColumn("level", level)
    over = F.col("room") > F.col("level") * F.col("w")
    upto = by_room.rowsBetween(Window.unboundedPreceding, 0)
    # The first source that stays under its limit fixes the level for itself and all after it.
    common = F.first(F.when(over, F.col("level")), ignorenulls=True).over(upto)
    return levelled.withColumn("common", common).select(
        "source",
        "source_size",
        F.coalesce(F.col("common") * F.col("w"), F.col("room")).alias("target"),
    )


def shuffled_stream(sized: DataFrame, key: Column, seed: str) -> DataFrame:
    """``sized`` with ``begin``: the tokens before each document in its source's shuffled order.

    The order is that of a hash of ``key`` and ``seed``, then of key and size.
    Running sums are taken in buckets of the hash's first digits and shifted by the
    sums of the buckets before, so a source with a third of all rows is spread
    over 4096 buckets.
    """
    order = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(seed)))
    keyed = sized.withColumn("_order", order)
    keyed = keyed.withColumn("_bucket", F.substring("_order", 1, BUCKET_DIGITS))
    group = [F.col("source_id"), F.col("_bucket")]
    upto = Window.partitionBy(*group).orderBy("_order", key, "size")
    inside = keyed.withColumn(
        "_upto", F.sum("size").over(upto.rowsBetween(Window.unboundedPreceding, 0))
    )
    earlier = Window.partitionBy("source_id").orderBy("_bucket")
    before = (
        keyed.groupBy(*group)
        .agg(F.sum("size").alias("_size"))
        .select(
            *group,
            F.sum("_size").over(earlier.rowsBetween(Window.unboundedPreceding, 0)).alias("_end"),
            "_size",
        )
    )
    begin = F.col("_end") - F.col("_size") + F.col("_upto") - F.col("size")
    return (
        inside.join(before, ["source_id", "_bucket"])
        .withColumn("begin", begin)
        .drop("_order", "_bucket", "_upto", "_end", "_size")
    )


def schedule(sources: DataFrame) -> DataFrame:
    """``(source_id, slot, position)``: the mix's slots, numbered per source and over all.

    ``sources`` has ``source_id``, ``need`` (slots) and ``low`` and ``high``, its
    part of the circle by cumulative weight. Point i of the sequence is the i-th
    multiple of the golden ratio on the circle; the source whose part it falls in
    gets the slot. A source's slots beyond its need fall away; those that the
    sequence did not reach (a few, by its low discrepancy) come at the end, the
    lowest slots first.
    """
    spark = sources.sparkSession
    total = sources.agg(F.coalesce(F.sum("need"), F.lit(0))).first()[0]
    point = F.pmod(F.col("id") * F.lit(GOLDEN), F.lit(CIRCLE))
    points = spark.range(total).select(F.col("id").alias("position"), point.alias("point"))
    points = points.withColumn("cell", F.floor(F.col("point") / CELL))
    parts = sources.filter("high > low").withColumn(
        "cell", F.explode(F.sequence(F.floor(F.col("low") / CELL), F.floor((F.col("high") - 1) / CELL)))
    )
    inside = (F.col("point") >= F.col("low")) & (F.col("point") < F.col("high"))
    drawn = points.join(parts, "cell").filter(inside)
    by_source = Window.partitionBy("source_id").orderBy("position")
    ranked = drawn.withColumn("slot", (F.row_number().over(by_source) - 1).cast("bigint"))
    kept = ranked.filter("slot < need").select("source_id", "slot", "position")
    got = ranked.groupBy("source_id").agg(F.count("*").alias("got"))
    short = sources.join(got, "source_id", "left").withColumn("got", F.coalesce("got", F.lit(0)))
    rest = short.filter("got < need").select(
        "source_id", F.explode(F.sequence(F.col("got").cast("bigint"), F.col("need") - 1)).alias("slot")
    )
    late = F.row_number().over(Window.orderBy("slot", "source_id")) - 1
    rest = rest.withColumn("position", (late + F.lit(total)).cast("bigint"))
    return kept.unionByName(rest)


def mix_sources(
    df: DataFrame,
    key: str,
    source: str,
    size: str,
    weights: Sequence[float] = (5.0, 2.0, 1.0),
    *,
    most: float = 3.0,
    slots: int = SLOTS,
    seed: str = ":mix",
) -> tuple[DataFrame, DataFrame]:
    """What a mix of ``df``'s sources takes, as ``(documents, blocks)``.

    Each source's documents are shuffled into one stream of tokens, which repeats
    when it ends, and cut into blocks of equal length; the schedule's slots of the
    source take its blocks in turn until its target is reached. ``blocks`` has
    ``(source_id, slot, position, epoch, first, end)``: the tokens of the source's
    stream that each slot takes, in order of ``position`` over all sources.
    ``documents`` has ``key, source, size, source_size, target, taken, positions``;
    ``taken`` counts tokens, repeats included, and ``positions`` has for each pass
    over the source that reaches the document the position of the slot that begins
    it: in this order the documents make up the mix, and any first part of it is
    close to the weights. Documents of size 0 and those never reached have none.

    NULL sizes count as 0, a NULL source is a source of its own, NULL keys are
    allowed. Rows equal in all three columns are interchangeable; they stay in one
    bucket of the shuffle. Ties of the shuffle's hash go by key, then size. Other columns are left out. An empty table gives empty
    tables. A source takes its target rounded to whole tokens.
    """
    sized = stored(
        df.select(
            named(key).alias("key"),
            named(source).alias("source"),
            F.coalesce(named(size), F.lit(0)).cast("bigint").alias("size"),
        ),
        "mix-sizes",
    )
    targets = source_targets(sized, weights, most)
    every = Window.orderBy(F.col("source").asc_nulls_last())
    width = F.greatest(F.lit(1), F.ceil(F.sum("source_size").over(every.rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)) / slots))
    whole = F.sum("target").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    upto = F.sum("target").over(every.rowsBetween(Window.unboundedPreceding, 0))
    edge = F.when(whole > 0, F.round(upto / whole * CIRCLE)).otherwise(0).cast("bigint")
    sources = (
        targets.withColumn("source_id", F.row_number().over(every))
        .withColumn("quota", F.floor(F.col("target") + 0.5))
        .withColumn("width", width.cast("bigint"))
        .withColumn("high", F.least(edge, F.lit(CIRCLE)))
        .withColumn("need", F.ceil(F.col("quota") / F.col("width")).cast("bigint"))
        .withColumn("low", F.coalesce(F.lag("high").over(every), F.lit(0)))
    )
    sources = stored(sources, "mix-sources")
    blocks = _blocks(schedule(sources), sources)
    # One row a source, joined on a hot key: Spark broadcasts it below its threshold.
    named_sources = sources.select("source_id", F.col("source").alias("_source"), "source_size", "target", "width")
    by_source = sized.join(named_sources, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    streamed = shuffled_stream(by_source, F.col("key"), seed)
    return _taken(streamed, blocks, ceil(most)), blocks


def _blocks(slots: DataFrame, sources: DataFrame) -> DataFrame:
    known = sources.select("source_id", "source_size", "quota", "width")
    spread = slots.join(known, "source_id").filter("source_size > 0")
    low, high = F.col("slot") * F.col("width"), F.least((F.col("slot") + 1) * F.col("width"), "quota")
    epochs = F.sequence(
        F.floor(low / F.col("source_size")), F.floor((high - 1) / F.col("source_size"))
    )
    by_epoch = spread.withColumn("epoch", F.explode(epochs))
    shift = F.col("epoch") * F.col("source_size")
    return by_epoch.select(
        "source_id",
        "slot",
        "position",
        "epoch",
        F.greatest(low - shift, F.lit(0)).alias("first"),
        F.least(high - shift, F.col("source_size")).alias("end"),
        "width",
    )


def _taken(streamed: DataFrame, blocks: DataFrame, epochs: int) -> DataFrame:
    """Tokens of each document in all blocks, joined by the cells of one width that both meet, and where they begin."""
    columns = ["key", "source", "size", "source_size", "target"]

    def by_cell(frame, first, end):
        low, high = F.floor(F.col(first) / F.col("width")), F.floor((F.col(end) - 1) / F.col("width"))
        return frame.withColumn("cell", F.explode(F.sequence(low, high)))

    streamed = streamed.withColumn("finish", F.col("begin") + F.col("size"))
    cut = by_cell(blocks, "first", "end").select(
        "source_id", "cell", "first", "end", "width", "epoch", "position"
    )
    # A block that meets two cells is cut at the cell's edge, so that each token counts once.
    edge = F.col("cell") * F.col("width")
    cut = cut.select(
        "source_id",
        "cell",
        F.greatest("first", edge).alias("first"),
        F.least("end", edge + F.col("width")).alias("end"),
        "epoch",
        "position",
    )
    filled = by_cell(streamed.filter("size > 0"), "begin", "finish")
    common = F.least("end", "finish") - F.greatest("first", "begin")
    shared = F.when(F.col("first").isNotNull(), F.greatest(common, F.lit(0)))
    sums = (
        filled.join(cut, ["source_id", "cell"], "left")
        .groupBy("source_id", "begin", *columns)
        .agg(
            F.coalesce(F.sum(shared), F.lit(0)).alias("taken"),
            # A pass takes its slots in their order, so the first one has the least position.
            F.array_compact(
                F.array(*[F.min(F.when((shared > 0) & (F.col("epoch") == e), F.col("position"))) for e in range(epochs)])
            ).alias("positions"),
        )
        .select(*columns, "taken", "positions")
    )
    none = F.array().cast("array<bigint>").alias("positions")
    empty = streamed.filter("size = 0").select(*columns, F.lit(0).cast("bigint").alias("taken"), none)
    return sums.unionByName(empty)
