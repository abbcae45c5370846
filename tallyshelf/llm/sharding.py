"""Balanced shards by a consistent-hash ring with bounded loads."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import pairwise

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyshelf.functions.names import named
from tallyshelf.llm.common import rank_in_group, salt_of, stored

VNODES = 128
#: The ring has 2^63 places; its cells, for finding an arc, have 2^51.
RING_BITS, CELL_BITS = 63, 51


def ring_place(*columns):
    """Place on the ring of the columns' values, 0 to 2^63 - 1."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 64 - RING_BITS)


def ring(spark: SparkSession, shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """``(place, shard)`` of every virtual node, clockwise. ``shards * vnodes`` rows, whatever the data.

    A shard's nodes depend on its number alone, so that a further shard only adds nodes.
    """
    nodes = spark.range(shards * vnodes).select(
        F.floor(F.col("id") / vnodes).cast("int").alias("shard"),
        F.pmod(F.col("id"), F.lit(vnodes)).cast("int").alias("node"),
    )
    placed = nodes.select(ring_place(F.lit("shard"), "shard", "node").alias("place"), "shard")
    return sorted(tuple(row) for row in placed.collect())


def arcs(spark: SparkSession, nodes: list[tuple[int, int]]) -> DataFrame:
    """``(cell, arc, after, upto)``: the arc of node i holds the places over ``after`` up to ``upto``.

    The places behind the last node belong to node 0.
    """
    places = [-1, *(place for place, _ in nodes)]
    rows = [(i, low, high) for i, (low, high) in enumerate(pairwise(places))]
    rows.append((0, places[-1], 2**RING_BITS - 1))
    table = spark.createDataFrame(rows, "arc int, after bigint, upto bigint")
    first = F.shiftright(F.greatest(F.col("after"), F.lit(0)), CELL_BITS)
    met = F.sequence(first, F.shiftright(F.col("upto"), CELL_BITS))
    return table.withColumn("cell", F.explode(met))


def capacities(loads: list[int], total: int) -> list[int]:
    """Rows each shard takes: equal but for one, the larger ones where most keys have their home."""
    least, more = divmod(total, len(loads))
    favoured = set(sorted(range(len(loads)), key=lambda s: (-loads[s], s))[:more])
    return [least + (s in favoured) for s in range(len(loads))]


def assign_arcs(
    nodes: Sequence[tuple[int, int]], counts: dict[int, int], shards: int
) -> list[tuple[int, int, int, int, int]]:
    """``(arc, first rank, end rank, shard, first slot)`` for all keys of all arcs.

    Every arc first offers its keys to its own shard; then, in ring order, what
    did not fit goes on clockwise to the next shard with room. The capacities add
    up to the number of keys, so every key finds room. Each step fills a shard or
    ends an arc: at most two steps an arc and one a shard.
    """
    homes = [0] * shards
    for arc, n in counts.items():
        homes[nodes[arc][1]] += n
    capacity = capacities(homes, sum(counts.values()))
    filled = [0] * shards
    out = []
    begun = {}

    def take(arc, shard):
        first = begun.get(arc, 0)
        n = min(counts[arc] - first, capacity[shard] - filled[shard])
        if n > 0:
            out.append((arc, first, first + n, shard, filled[shard]))
            filled[shard] += n
            begun[arc] = first + n

    for arc in sorted(counts):
        take(arc, nodes[arc][1])
    for arc in sorted(counts):
        at = arc
        while begun.get(arc, 0) < counts[arc]:
            at = (at + 1) % len(nodes)
            take(arc, nodes[at][1])
    return out


def shard_rows(
    df: DataFrame, key: str, shards: int, *, vnodes: int = VNODES, salts: int = 128
) -> DataFrame:
    """``df`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in each shard).

    A consistent-hash ring with virtual nodes and bounded loads: a key belongs to
    the first node clockwise of its hash; keys of a shard that is full continue
    clockwise to the next one with room. With capacities that differ by one at
    most the shards' row counts do too. What reaches the driver is a count per
    arc, ``shards * vnodes`` numbers; what is broadcast is at most twice as many
    rows of rank ranges.

    ``df`` should be narrow: it is written once, then ranked within its arcs.
    NULL keys are keys like any other. Equal rows may be told apart by their rank
    only, so they get different slots; rows equal in all columns are
    interchangeable. An empty table gives an empty table. Columns of ``df`` named
    ``shard`` or ``slot`` are replaced; names beginning with ``_`` and ``rank``
    are reserved.
    """
    spark = df.sparkSession
    columns = [c for c in df.columns if c not in ("shard", "slot")]
    nodes = ring(spark, shards, vnodes)
    placed = df.select(*map(named, columns), ring_place(named(key)).alias("_place"))
    placed = placed.withColumn("_cell", F.shiftright("_place", CELL_BITS))
    arc = F.broadcast(arcs(spark, nodes).select("cell", F.col("arc").alias("_arc"), "after", "upto"))
    inside = (F.col("_cell") == F.col("cell")) & F.col("_place").between(
        F.col("after") + 1, F.col("upto")
    )
    keyed = stored(placed.join(arc, inside).select(*map(named, columns), "_arc"), "shard-keys")
    counts = {a: n for a, n in keyed.groupBy("_arc").count().collect()}
    ranges = spark.createDataFrame(
        assign_arcs(nodes, counts, shards),
        "_to_arc int, _first bigint, _end bigint, shard int, _slot bigint",
    )
    order = [named(c).asc_nulls_first() for c in columns]
    ranked = rank_in_group(keyed, "_arc", order, salt_of([named(c) for c in columns], salts), "_rank")
    held = (F.col("_arc") == F.col("_to_arc")) & (F.col("_rank") >= F.col("_first"))
    placed = ranked.join(F.broadcast(ranges), held & (F.col("_rank") < F.col("_end")))
    slot = (F.col("_slot") + F.col("_rank") - F.col("_first")).alias("slot")
    return placed.select(*map(named, columns), "shard", slot)
