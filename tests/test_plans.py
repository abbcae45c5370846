"""Shape of the physical plans: what is read, what moves, what stays in the JVM."""

import pytest
from pyspark.sql import functions as F

from registered.fixture import items, items_base
from registered.queries import QUERIES
from tallyshelf.plans import reports

SF_DIR = "/root/testdata/sf0.001"
LAZY = sorted(
    name
    for name in QUERIES
    if not name.startswith(("csv_", "exported_", "warehouse_", "flat_", "partition_"))
)

#: Their windows run over the periods of a calendar, the steps of a threshold, or within one tag or text.
WINDOWED = {"category_trends", "monthly_trend", "related_genres", "top_terms", "document_scores"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_python_no_cross_join_no_unbounded_gather(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for word in ("Python", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin", "Window"):
        assert word not in text or word == "Window" and name in WINDOWED


@pytest.mark.parametrize("name", ["genre_stats", "genre_playtime", "top_developers", "top_publishers", "top_tags"])
def test_top_k_is_not_a_full_sort(spark, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, SF_DIR))


def test_reports_on_order_columns_do_not_touch_lines(spark):
    for name in ("releases_by_year", "free_paid_split", "price_histogram"):
        assert "lineitem" not in plan(QUERIES[name](spark, SF_DIR))
    price = items(spark, SF_DIR, "price", "platforms").select("price")
    assert "lineitem" not in plan(price)


def test_only_needed_columns_are_read(spark, tmp_path):
    path = str(tmp_path / "items")
    items(spark, SF_DIR, "release_date", "price", "owners").write.partitionBy("release_year").parquet(path)
    stats = reports.releases_by_year(spark.read.parquet(path), 1997, 1998)
    text = plan(stats)
    assert "ReadSchema: struct<>" in text and "PartitionFilters: [isnotnull(release_year" in text


def test_filters_reach_the_scan_below_the_generator(spark, tmp_path):
    path = str(tmp_path / "items")
    rows = items(spark, SF_DIR, "genres", "average_playtime", "positive_ratings", "negative_ratings", "price")
    rows.write.parquet(path)
    text = plan(reports.genre_playtime(spark.read.parquet(path)))
    assert "GreaterThanOrEqual(total_ratings,50)" in text
    assert "ReadSchema: struct<genres:string,average_playtime:int,total_ratings:bigint>" in text
    assert text.index("Generate explode") < text.index("GreaterThanOrEqual(total_ratings,50)")


def test_groups_combine_before_the_shuffle(spark):
    for name in ("genre_stats", "price_band_stats", "platform_rate_by_year", "top_tags"):
        text = plan(QUERIES[name](spark, SF_DIR))
        assert text.index("Exchange") < text.index("partial_")


def test_hot_part_is_split_by_the_skew_join(spark, tmp_path):
    """A third of all lines on one part: AQE splits that partition of the join."""
    lines = spark.range(0, 120_000, 1, 8).select(
        (F.col("id") % 30_000).alias("l_orderkey"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("l_partkey"),
        F.lit(1).alias("l_linenumber"),
        F.lit(2.0).alias("l_quantity"),
        F.element_at(F.array(F.lit("A"), F.lit("N"), F.lit("R")), (F.col("id") % 3 + 1).cast("int")).alias("l_returnflag"),
        F.lit("O").alias("l_linestatus"),
    )
    parts = spark.range(5000).select(
        F.col("id").alias("p_partkey"), F.concat(F.lit("T"), F.col("id") % 6).alias("p_type")
    )
    orders = spark.read.parquet(f"{SF_DIR}/orders.parquet").limit(1)
    orders = spark.range(30_000).select(
        F.col("id").alias("o_orderkey"), F.lit(0).cast("bigint").alias("o_custkey"),
        *[F.lit(orders.first()[c]).alias(c) for c in orders.columns[2:]],
    )
    for name, df in {"lineitem": lines, "part": parts, "orders": orders}.items():
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "40k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "60k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        genres = items_base(spark, str(tmp_path), ["item_id", "genres", "positive_ratings"])
        rows = genres.collect()
        assert "skew=true" in plan(genres)
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert len(rows) == 30_000
    assert sum(r["positive_ratings"] for r in rows) == 80_000
