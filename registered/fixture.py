"""The provided star-schema tables in the shape of a catalog feed.

An order is an item: its lines are the ratings, playtime and achievements, the
types of its parts the genres, its customer the developer. See FIXTURES.md §2.2.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyshelf.functions.bands import up_to
from tallyshelf.functions.names import named
from tallyshelf.operators.clean import clean
from tallyshelf.operators.reshape import melt_votes
from tallyshelf.spec import CatalogSpec

# The return codes that have a flag.
FLAGS = {"on_a": ("platforms", "A"), "on_n": ("platforms", "N"), "on_r": ("platforms", "R")}
ACHIEVEMENT_BANDS = up_to("0", [("1-2", 2), ("3-4", 4)], "5+")

SPEC = CatalogSpec(
    key="item_id",
    key_type="bigint",
    types={
        "achievements": "int",
        "positive_ratings": "bigint",
        "negative_ratings": "bigint",
        "average_playtime": "int",
        "price": "double",
    },
    token_counts={
        "num_genres": "genres",
        "num_categories": "categories",
        "num_platforms": "platforms",
    },
    flags=FLAGS,
)

MAKERS = {"developer", "publisher"}
FROM_LINES = {
    "platforms",
    "categories",
    "positive_ratings",
    "negative_ratings",
    "average_playtime",
    "achievements",
}
COLUMNS = [
    "item_id",
    "name",
    "release_date",
    "developer",
    "publisher",
    "platforms",
    "categories",
    "genres",
    "achievements",
    "positive_ratings",
    "negative_ratings",
    "average_playtime",
    "owners",
    "price",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def items_base(
    spark: SparkSession, sf_dir: str, columns: Collection[str] = COLUMNS
) -> DataFrame:
    """One typed row per order with ``columns``; only the joins they need are planned.

    No join carries a broadcast hint: Spark broadcasts a side below its size
    threshold and AQE splits a skewed partition of the others. Lines combine per
    order before they shuffle.
    """
    wanted = set(columns)
    items = table(spark, sf_dir, "orders")
    if MAKERS & wanted:
        makers = table(spark, sf_dir, "customer")
        items = items.join(makers, F.col("o_custkey") == F.col("c_custkey"), "left")
    if "publisher" in wanted:
        nations = table(spark, sf_dir, "nation")
        items = items.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    if wanted & (FROM_LINES | {"genres"}):
        lines = _lines_per_order(spark, sf_dir, wanted)
        items = items.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    floor_20k = (F.floor(F.col("o_totalprice") / 20000) * 20000).cast("bigint")
    expressions = {
        "item_id": F.col("o_orderkey"),
        "name": F.concat_ws("-", "o_orderstatus", "o_orderpriority"),
        "release_date": F.to_date("o_orderdate"),
        "developer": F.col("c_name"),
        "publisher": F.col("n_name"),
        "owners": F.concat_ws("-", floor_20k.cast("string"), (floor_20k + 20000).cast("string")),
        "price": (F.floor(F.col("o_totalprice") / 50) - 200) / 100.0,
    }
    return items.select(
        *[expressions[c].alias(c) if c in expressions else F.col(c) for c in COLUMNS if c in wanted]
    )


def _lines_per_order(spark: SparkSession, sf_dir: str, wanted: set[str]) -> DataFrame:
    """The lines of an order in one row. All texts and codes count, whatever there are of them."""
    lines = table(spark, sf_dir, "lineitem")
    if "genres" in wanted:
        parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
        lines = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
    returned = F.col("l_returnflag") == "R"
    measures = {
        "genres": _distinct_tokens("p_type"),
        "platforms": _distinct_tokens("l_returnflag"),
        "categories": _distinct_tokens("l_linestatus"),
        "positive_ratings": F.count_if(~returned),
        "negative_ratings": F.count_if(returned),
        "average_playtime": F.sum("l_quantity").cast("int"),
        "achievements": F.max("l_linenumber"),
    }
    return lines.groupBy("l_orderkey").agg(
        *[e.alias(n) for n, e in measures.items() if n in wanted]
    )


def _distinct_tokens(column: str) -> Column:
    """The distinct texts of a group in order, joined; NULL if there are none."""
    found = F.collect_set(column)
    return F.when(F.size(found) > 0, F.array_join(F.array_sort(found), ";"))


def items_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as it would arrive: every column text."""
    base = items_base(spark, sf_dir)
    return base.select(*[F.col(c).cast("string").alias(c) for c in base.columns])


def items(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The clean catalog with what derives from ``columns``, for the reports.

    An order key is unique, so de-duplication is left to ``clean_items``. The
    columns are typed at the source, which makes the casts fall away.
    """
    base = items_base(spark, sf_dir, {"item_id", "name", *columns})
    return clean(base, SPEC, dedup=False, partial=True)


def tags_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User x event type matrix of whole hundreds of value, as text.

    Every event counts, and each type the events have is a column; a wide table must know
    its columns when it is planned, so the types are listed first. ``pivot`` fails
    beyond its limit of 10,000 types, it drops none.
    """
    events = table(spark, sf_dir, "events")
    votes = F.sum(F.floor(F.col("value") / 100))
    wide = events.groupBy("user_id").pivot("event_type").agg(votes)
    cells = [c for c in wide.columns if c != "user_id"]
    return wide.select(
        "user_id", *[F.coalesce(named(c), F.lit(0)).cast("string").alias(c) for c in cells]
    )


def tags_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return melt_votes(tags_wide(spark, sf_dir), "user_id", key_type="bigint", value_type="bigint")
