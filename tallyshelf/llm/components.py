"""Connected components of a graph of edges, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyshelf.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges`` (``u``, ``v``, bigint, not NULL).

    In each round every node goes over to the one of lowest hash among itself and
    its neighbours, the hash changing with the round, and the edges are rewritten;
    those within a node fall away. A constant share of the nodes of each component
    is expected to go, whatever its shape, so the number of rounds grows with the
    logarithm of the largest component. A component's value is one of its nodes.
    Rounds are written to the shared folder; the driver sees their edge counts.
    """
    moves: list[DataFrame] = []
    left = stored(edges.filter("u <> v").select("u", "v").distinct(), "edges")
    nodes = left
    while left.count():
        both = left.unionByName(left.select(F.col("v").alias("u"), F.col("u").alias("v")))
        order = F.xxhash64(F.col("v"), F.lit(len(moves)))
        own = F.xxhash64(F.col("u"), F.lit(len(moves)))
        nearest = both.groupBy("u").agg(F.min(F.struct(order.alias("h"), F.col("v").alias("to"))).alias("m"))
        to = F.when(F.struct(own, F.col("u")) <= F.col("m"), F.col("u")).otherwise(F.col("m.to"))
        move = stored(nearest.select(F.col("u").alias("node"), to.alias("to")), "moves")
        moves.append(move)
        first = left.join(move, F.col("u") == F.col("node")).select(F.col("to").alias("u"), "v")
        rewritten = first.join(move, F.col("v") == F.col("node")).select("u", F.col("to").alias("v"))
        pair = rewritten.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
        left = stored(pair.filter("u <> v").distinct(), "edges")
    found = nodes.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    found = found.withColumn("component", F.col("node"))
    for move in moves:
        step = move.select(F.col("node").alias("component"), "to")
        found = found.join(step, "component", "left").select(
            "node", F.coalesce("to", "component").alias("component")
        )
    return found
