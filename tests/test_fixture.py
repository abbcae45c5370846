"""The catalog shape of the provided tables."""

import re

from pyspark.sql import functions as F

from registered import fixture
from tallyshelf.operators.clean import clean

SF_DIR = "/root/testdata/sf0.001"


def test_typed_and_text_feed_clean_to_the_same_table(spark):
    typed = clean(fixture.items_base(spark, SF_DIR), fixture.SPEC, dedup=False)
    text = clean(fixture.items_raw(spark, SF_DIR), fixture.SPEC)
    assert typed.dtypes == text.dtypes
    assert typed.exceptAll(text).count() == 0 and text.exceptAll(typed).count() == 0


def plan_shape(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"[A-Z][A-Za-z]*(?:Join|Aggregate|Exchange|Scan|Generate|Sort)\b", plan)


def test_any_vocabulary_has_one_plan_and_loses_no_row(spark, tmp_path):
    """200 part types, NULL types, lost parts, and codes no list knows."""
    shapes = []
    spark.read.parquet(f"{SF_DIR}/orders.parquet").limit(500).write.parquet(f"{tmp_path}/orders.parquet")
    for n in (3, 200):
        flags = F.element_at(F.array(*[F.lit(f) for f in ("A", "Z", "R")]), (F.col("id") % min(n, 3) + 1).cast("int"))
        lines = spark.range(4000).select(
            (F.col("id") % 500).alias("l_orderkey"),
            (F.col("id") * 7 % 210).alias("l_partkey"),
            flags.alias("l_returnflag"),
            F.lit("Q").alias("l_linestatus"),
        )
        lines.write.mode("overwrite").parquet(f"{tmp_path}/lineitem.parquet")
        parts = [(i, None if i % 10 == 0 else f"TYPE {i % n:03d}") for i in range(200)]
        spark.createDataFrame(parts, "p_partkey bigint, p_type string").write.mode("overwrite").parquet(
            f"{tmp_path}/part.parquet"
        )
        by_part, expected, codes = dict(parts), {}, {}
        for i in range(4000):
            expected.setdefault(i % 500, set()).add(by_part.get(i * 7 % 210))
            codes.setdefault(i % 500, set()).add("AZR"[i % 3])
        got = fixture.items_base(spark, str(tmp_path), ["item_id", "genres", "platforms", "categories"])
        shapes.append(plan_shape(got))
        for row in got.collect():
            types = sorted(expected.get(row["item_id"], set()) - {None})
            assert row["genres"] == (";".join(types) or None)
            assert row["platforms"] == (";".join(sorted(codes.get(row["item_id"], set()))) or None)
            assert row["categories"] in ("Q", None)
    assert shapes[0] == shapes[1]


def test_all_events_and_event_types_are_votes(spark, tmp_path):
    events = [(1, "view", 250.0), (1, "view", 99.0), (1, "refund", 101.0), (2, "odd type.x", 1000.0), (2, "view", 5.0)]
    spark.createDataFrame(events, "user_id bigint, event_type string, value double").write.parquet(
        f"{tmp_path}/events.parquet"
    )
    assert sorted(fixture.tags_long(spark, str(tmp_path)).collect()) == [
        (1, "refund", 1), (1, "view", 2), (2, "odd type.x", 10),
    ]


def test_orders_without_lines_have_null_measures(spark):
    items = fixture.items(spark, SF_DIR, "genres", "positive_ratings", "negative_ratings")
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet").select("l_orderkey").distinct()
    bare = items.join(lines, items["item_id"] == lines["l_orderkey"], "left_anti")
    assert bare.filter("genres IS NOT NULL OR total_ratings IS NOT NULL").count() == 0
