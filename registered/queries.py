"""One callable per operator or result: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registered import fixture
from registered.fixture import SPEC, items, items_raw, table, tags_long, tags_wide
from tallyshelf.functions.derive import interval_bounds, interval_middle
from tallyshelf.operators.clean import clean
from tallyshelf.operators.cooccurrence import related_tags, tag_pairs
from tallyshelf.operators.dedup import first_per_key
from tallyshelf.operators.html import html_fields, html_text, typed_fields
from tallyshelf.operators.nested import child_rows, discover_schema, nested_columns
from tallyshelf.operators.reshape import explode_tokens, melt_votes
from tallyshelf.operators.terms import (
    best_threshold,
    term_counts,
    term_log_odds,
    term_weights,
    text_scores,
    top_terms,
)
from tallyshelf.operators.trend import period_series, trend_test, with_change
from tallyshelf.plans import reports
from tallyshelf.plans.jobs import clean_job, export_zone, publish_job, row_counts
from tallyshelf.sources.readers import (
    NULL_MARK,
    read_feed,
    read_record,
    read_result,
    read_table,
    register_views,
)
from tallyshelf.sources.scratch import scratch_folder
from tallyshelf.sources.writers import (
    flatten_table,
    save_record,
    save_result,
    write_csv,
    write_partitioned,
    write_table,
)

Query = Callable[[SparkSession, str], DataFrame]

FIRST, LAST = 1996, 2000
RATES = {"n": "on_n", "r": "on_r"}
SHARES = {"a": "on_a", "n": "on_n", "r": "on_r"}
KPIS = {"a_pct": "on_a", "n_pct": "on_n", "r_pct": "on_r"}
RATINGS = ("positive_ratings", "negative_ratings")


def clean_items(spark, d):
    return clean(items_raw(spark, d), SPEC)


def dedup_items(spark, d):
    return first_per_key(table(spark, d, "lineitem"), ["l_orderkey"], ["l_linenumber"])


def owner_intervals(spark, d):
    low, high = interval_bounds(F.col("owners"), "-")
    bounds = items(spark, d, "owners").select(
        "item_id", "owners", low.alias("low"), high.alias("high")
    )
    return bounds.withColumn("middle", interval_middle(F.col("low"), F.col("high")))


def explode_genres(spark, d):
    rows = explode_tokens(items(spark, d, "genres"), "genres", "genre")
    return rows.select("item_id", "genre")


def melted_votes(spark, d):
    return tags_long(spark, d)


def quality(spark, d):
    return reports.quality_report(items(spark, d, "release_date", "price", *RATINGS))


def by_year(spark, d):
    return reports.releases_by_year(items(spark, d, "release_date"), FIRST, LAST)


def peak_year(spark, d):
    return reports.peak_year(items(spark, d, "release_date"))


def share_since_year(spark, d):
    return reports.share_since(items(spark, d, "release_date"), 1998)


def last_n_years(spark, d):
    return reports.last_years(items(spark, d, "release_date"), 3)


def recent_years_ranked(spark, d):
    return reports.years_ranked(items(spark, d, "release_date"), FIRST, LAST)


def genre_stats(spark, d):
    return reports.genre_stats(items(spark, d, "genres", *RATINGS), 4)


def genre_playtime(spark, d):
    rows = items(spark, d, "genres", "average_playtime", *RATINGS)
    return reports.genre_playtime(rows, 12, min_ratings=5, min_items=30)


def price_band_stats(spark, d):
    return reports.price_band_stats(items(spark, d, "price", "owners", *RATINGS))


def price_band_ordered(spark, d):
    rows = items(spark, d, "price", "owners", *RATINGS)
    return reports.price_band_stats(rows, position="band_order", keep_empty=True)


def price_tier_stats(spark, d):
    return reports.price_tier_stats(items(spark, d, "price", *RATINGS))


def price_histogram(spark, d):
    return reports.price_histogram(items(spark, d, "price"))


def free_paid_split(spark, d):
    return reports.free_paid_split(items(spark, d, "price"))


def median_price(spark, d):
    return reports.median_price(items(spark, d, "price"))


def top_developers(spark, d):
    return reports.top_developers(items(spark, d, "developer"))


def top_publishers(spark, d):
    return reports.top_publishers(items(spark, d, "publisher", "positive_ratings"))


def platform_share(spark, d):
    return reports.platform_share(items(spark, d, "platforms"), SHARES)


def platform_rate_by_year(spark, d):
    rows = items(spark, d, "release_date", "platforms")
    return reports.platform_rate_by_year(rows, FIRST, LAST, RATES)


def platform_rate_long(spark, d):
    return reports.platform_rate_long(platform_rate_by_year(spark, d))


def top_tags(spark, d):
    return reports.top_tags(tags_long(spark, d))


def top_tags_10(spark, d):
    return reports.top_tags(tags_long(spark, d), 10, with_items=False)


def achievement_band_stats(spark, d):
    rows = items(spark, d, "achievements", "average_playtime", *RATINGS)
    return reports.achievement_band_stats(
        rows, bands=fixture.ACHIEVEMENT_BANDS, min_ratings=1, position="band_order"
    )


def kpi_summary(spark, d):
    return reports.kpi_summary(items(spark, d, "price", "platforms", *RATINGS), KPIS)


def csv_feed_clean(spark, d):
    """The whole feed written as CSV, read back as text and cleaned."""
    path = scratch_folder(spark, "feed")
    write_csv(items_raw(spark, d), path)
    return clean(read_feed(spark, path, fixture.COLUMNS, null=NULL_MARK), SPEC)


def csv_wide_melt(spark, d):
    """The wide matrix written as CSV, read back by its header and melted."""
    path = scratch_folder(spark, "matrix")
    write_csv(tags_wide(spark, d), path)
    return melt_votes(read_feed(spark, path), "user_id", key_type="bigint", value_type="bigint")


def csv_free_text(spark, d):
    """Whole documents, with quotes and line breaks, through CSV."""
    path = scratch_folder(spark, "text")
    documents = table(spark, d, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"), "text", "lang"
    )
    write_csv(documents, path)
    return read_feed(spark, path, documents.columns, free_text=True, null=NULL_MARK)


def partition_roundtrip(spark, d):
    """The clean table by year, written, read back and pruned to a range of years."""
    path = scratch_folder(spark, "by-year")
    write_partitioned(items(spark, d, "release_date", "price"), path, SPEC.year)
    rows = read_table(spark, path).filter(F.col(SPEC.year).between(1997, 1999))
    return rows.select("item_id", "name", "release_date", "price", "release_year")


def flat_copy(spark, d):
    """A partitioned table copied into a flat one."""
    by_year_path, flat = scratch_folder(spark, "by-year"), scratch_folder(spark, "flat")
    write_partitioned(items(spark, d, "release_date"), by_year_path, SPEC.year)
    flatten_table(spark, by_year_path, flat)
    return read_table(spark, flat).select("item_id", "name", "release_date", "release_year")


def warehouse_years(spark, d):
    """Both clean tables published as external tables; years ranked by SQL over the catalog."""
    _publish(spark, d, "tallyshelf_years")
    return spark.sql(
        """
        SELECT release_year, count(*) AS n_games FROM tallyshelf_years.games
        WHERE release_year BETWEEN 1996 AND 2000
        GROUP BY release_year ORDER BY n_games DESC, release_year
        """
    )


def warehouse_tags(spark, d):
    """Tags with most votes, read from the published table."""
    _publish(spark, d, "tallyshelf_tags")
    return reports.top_tags(spark.table("tallyshelf_tags.tags_long"), 10)


def _publish(spark, d, database):
    zone = scratch_folder(spark, "zone")
    write_partitioned(items(spark, d, "release_date", "price"), f"{zone}/games", SPEC.year)
    write_table(tags_long(spark, d), f"{zone}/tags_long")
    publish_job(spark, zone, database, location=f"{zone}/database")


def exported_genres(spark, d):
    """A report exported as CSV and read back."""
    path = scratch_folder(spark, "genres")
    save_result(genre_stats(spark, d), path, "-n", "genre")
    return read_result(spark, path, "genre string, n bigint, avg_ratio double")


def exported_kpis(spark, d):
    """The KPI record exported as JSON and read back."""
    path = scratch_folder(spark, "kpis")
    save_record(kpi_summary(spark, d), path)
    return read_record(spark, path, reports.kpi_schema(KPIS))


def sql_views(spark, d):
    """Reports as SQL over session views: years, free and paid, makers, platforms, tags, achievements."""
    columns = ["release_date", "price", "developer", "publisher", "platforms", "achievements"]
    register_views(
        spark,
        shelf_items=items(spark, d, *columns, "average_playtime", *RATINGS),
        shelf_tags=tags_long(spark, d),
    )
    return spark.sql(
        """
        SELECT 'q1' AS report, CAST(release_year AS STRING) AS name, CAST(count(*) AS DOUBLE) AS value
        FROM shelf_items WHERE release_year BETWEEN 1996 AND 2000 GROUP BY release_year
        UNION ALL
        SELECT 'q3', CASE WHEN is_free THEN 'free' ELSE 'paid' END, CAST(count(*) AS DOUBLE)
        FROM shelf_items GROUP BY 2
        UNION ALL
        (SELECT 'q5', developer, CAST(count(*) AS DOUBLE) AS n FROM shelf_items
         WHERE developer IS NOT NULL GROUP BY developer ORDER BY n DESC, developer LIMIT 12)
        UNION ALL
        (SELECT 'q5', publisher, CAST(sum(positive_ratings) AS DOUBLE) AS pos FROM shelf_items
         WHERE publisher IS NOT NULL GROUP BY publisher ORDER BY pos DESC, publisher LIMIT 12)
        UNION ALL
        SELECT 'q6', CAST(release_year AS STRING), round(avg(CAST(on_n AS INT)), 3)
        FROM shelf_items WHERE release_year BETWEEN 1996 AND 2000 GROUP BY release_year
        UNION ALL
        (SELECT 'q7', tag, CAST(sum(votes) AS DOUBLE) AS total FROM shelf_tags
         GROUP BY tag ORDER BY total DESC, tag LIMIT 20)
        UNION ALL
        SELECT 'q8', CAST(achievements AS STRING), round(avg(average_playtime) / 60, 2)
        FROM shelf_items WHERE total_ratings >= 1 GROUP BY achievements
        """
    )


def export_all(spark, d):
    """The whole export, all ten results read back, one row per result, row and measure."""
    zone, out = scratch_folder(spark, "zone"), scratch_folder(spark, "export")
    write_partitioned(items(spark, d, *fixture.COLUMNS), f"{zone}/games", SPEC.year)
    write_table(tags_long(spark, d), f"{zone}/tags_long")
    export_zone(
        spark,
        zone,
        out,
        first_year=FIRST,
        last_year=LAST,
        rates=RATES,
        shares=KPIS,
        min_ratings=1,
        min_items=30,
        achievement_bands=fixture.ACHIEVEMENT_BANDS,
    )
    keys = {
        "q1_release": "release_year",
        "q2_genre": "genre",
        "q3_price": "price_band",
        "q4_playtime": "genre",
        "q5_dev": "developer",
        "q5_pub": "publisher",
        "q6_platform": "release_year",
        "q7_tags": "tag",
        "q8_ach": "ach_band",
    }
    parts = []
    for name, key in keys.items():
        result = read_feed(spark, f"{out}/{name}", null=NULL_MARK)
        measures = [c for c in result.columns if c != key]
        long = result.unpivot([key], measures, "measure", "value")
        parts.append(
            long.select(
                F.lit(name).alias("result"),
                F.col(key).alias("name"),
                "measure",
                F.col("value").cast("double").alias("value"),
            )
        )
    kpis = read_record(spark, f"{out}/summary", reports.kpi_schema(KPIS))
    kpis = kpis.select(*[F.col(c).cast("double").alias(c) for c in kpis.columns])
    whole = kpis.unpivot([], kpis.columns, "measure", "value")
    parts.append(whole.select(F.lit("summary").alias("result"), F.lit("all").alias("name"), "measure", "value"))
    united = parts[0]
    for part in parts[1:]:
        united = united.unionByName(part)
    return united


def clean_job_counts(spark, d):
    """The cleaning job over CSV feeds: its report, and rows of the feed and both clean tables."""
    zone = scratch_folder(spark, "job")
    write_csv(items_raw(spark, d), f"{zone}/items", null="")
    write_csv(tags_wide(spark, d).withColumnRenamed("user_id", SPEC.key), f"{zone}/tags", null="")
    report = clean_job(spark, f"{zone}/items", f"{zone}/tags", f"{zone}/clean", SPEC)
    quality_rows = report.select(*[F.col(c).cast("double").alias(c) for c in report.columns])
    quality_rows = quality_rows.unpivot([], quality_rows.columns, "name", "value")
    counted = row_counts(spark, f"{zone}/items", f"{zone}/clean")
    return quality_rows.unionByName(
        counted.select(F.concat(F.lit("rows_"), "table").alias("name"), F.col("n").cast("double").alias("value"))
    )


def warehouse_tiers(spark, d):
    """The flat publish: price tiers read from the catalog, with the tables it lists."""
    zone, database = scratch_folder(spark, "zone"), "tallyshelf_flat"
    rows = items(spark, d, "release_date", "price", *RATINGS)
    write_partitioned(rows, f"{zone}/games", SPEC.year)
    write_table(tags_long(spark, d), f"{zone}/tags_long")
    tables = publish_job(
        spark, zone, database, warehouse_zone=f"{zone}/flat", location=f"{zone}/database"
    )
    listed = tables.filter("NOT isTemporary").agg(
        F.array_join(F.array_sort(F.collect_list("tableName")), ",").alias("tables")
    )
    tiers = reports.price_tier_stats(spark.table(f"{database}.games"))
    return tiers.join(listed, how="cross")


def median_decimal(spark, d):
    """The median price as an exact decimal."""
    prices = items(spark, d, "price").select(F.col("price").cast("decimal(20,8)").alias("price"))
    return reports.median_price(prices).select(F.col("median_price").cast("double").alias("median_price"))


def event_pairs(spark, d):
    """Which event types the same users have."""
    return tag_pairs(tags_long(spark, d), "user_id", "tag")


def genre_pairs(spark, d):
    """Which genres the same items have."""
    return tag_pairs(explode_genres(spark, d), "item_id", "genre")


def related_genres(spark, d):
    """For each genre the three that share most of its items."""
    return related_tags(genre_pairs(spark, d), 3)


def page_text(spark, d):
    """All pages as title and text."""
    return html_text(table(spark, d, "pages"), "page_id", "html").withColumnRenamed("key", "page_id")


def page_fields(spark, d):
    """All list items and table rows of all pages."""
    fields = html_fields(table(spark, d, "pages"), "page_id", "html").drop("cells")
    return fields.withColumnRenamed("key", "page_id")


def requirement_fields(spark, d):
    """Requirement texts of all parts, written as lists and tables, back as typed columns."""
    parts = table(spark, d, "part")
    pieces = [
        "<h2>", "p_name", "</h2><ul class='bb'><li><strong>Brand:</strong> ", "p_brand", "<br></li><li><b>Type</b>: ",
        "p_type", "<li>Size: ", "p_size", " cm</ul><table><tr><th>Retail price</th><td>", "p_retailprice",
        " USD</td><tr><td>Stock<td>many</table><!-- <li>", "p_partkey", ": -->",
    ]
    html = F.concat(*[F.col(x).cast("string") if x in parts.columns else F.lit(x) for x in pieces])
    columns = {
        "brand": (["Brand"], "string"),
        "kind": (["Type"], "string"),
        "size_cm": (["Size"], "int"),
        "price": (["Price", "Retail price"], "double"),
        "stock": (["Stock"], "bigint"),
    }
    typed = typed_fields(html_fields(parts.withColumn("html", html), "p_partkey", "html"), columns)
    return typed.select(F.col("key").alias("part_id"), *columns, F.to_json("rest").alias("rest"))


def props_schema(spark, d):
    """Every path of the events' properties, with its type."""
    return discover_schema(table(spark, d, "events"), "props")


def props_columns(spark, d):
    """The events with their properties as columns."""
    events = table(spark, d, "events").select("event_id", "user_id", "event_type", "props")
    typed = nested_columns(events, "props", {"k": ("$.k", "bigint")})
    return typed.withColumn("misfits", F.array_join("misfits", ",")).drop("props")


def _order_documents(spark, d):
    """Orders with their lines as nested text in single quotes, at most a thousand lines a text."""
    lines = table(spark, d, "lineitem").select(
        "l_orderkey",
        F.floor(F.col("l_linenumber") / 1000).alias("part"),
        F.struct("l_linenumber", "l_quantity", "l_returnflag", "l_shipdate").alias("line"),
    )
    nested = lines.groupBy("l_orderkey", "part").agg(F.array_sort(F.collect_list("line")).alias("lines"))
    text = F.translate(F.to_json(F.struct(F.col("l_orderkey").alias("order"), "lines")), '"', "'")
    return nested.select("l_orderkey", text.alias("document"))


def props_children(spark, d):
    """The lines of all orders, from nested text to a child table."""
    columns = {
        "line_number": ("$.l_linenumber", "bigint"),
        "quantity": ("$.l_quantity", "double"),
        "return_flag": ("$.l_returnflag", "string"),
    }
    children = child_rows(_order_documents(spark, d), ["l_orderkey"], "document", "$.lines", columns)
    return children.select("l_orderkey", "position", *columns)


def nested_schema(spark, d):
    """Every path of the orders' nested texts, with its type: from a written table, as each level reads it."""
    path = scratch_folder(spark, "documents")
    write_table(_order_documents(spark, d), path)
    return discover_schema(read_table(spark, path), "document")


def monthly_trend(spark, d):
    """The dearest orders by month, months without any included, with change and moving mean."""
    orders = table(spark, d, "orders").filter("o_totalprice > 498000")
    measures = {
        "n": F.count("*"),
        "value": F.sum(F.floor("o_totalprice").cast("bigint")),
        "dearest": F.max("o_totalprice"),
    }
    series = period_series(orders, "o_orderdate", measures, zero=["n", "value"])
    return with_change(series, "value").drop("year_before").withColumn("growth", F.round("growth", 6))


def category_trends(spark, d):
    """Whether the items of each genre that appear a month rise or fall."""
    rows = explode_tokens(items(spark, d, "genres", "release_date"), "genres", "genre")
    series = period_series(rows, "release_date", {"n_items": F.count("*")}, by=["genre"], zero=["n_items"])
    tested = trend_test(series, "n_items", by=["genre"])
    rounded = [F.round(c, 6).alias(c) for c in ("tau", "z", "slope", "intercept")]
    return tested.select("genre", "n", "s", *rounded, "trend")


def _document_counts(spark, d):
    """The terms of all documents, counted once: from a written table, as each step reads them."""
    path = scratch_folder(spark, "terms")
    write_table(term_counts(table(spark, d, "documents"), "doc_id", "text"), path)
    return read_table(spark, path)


def document_terms(spark, d):
    """The three terms of most weight of every document, among those that two documents have."""
    counts = _document_counts(spark, d)
    top = top_terms(term_weights(counts, least_docs=2), 3)
    return top.select(F.col("key").alias("doc_id"), "term", "n", "docs", F.round("weight", 6).alias("weight"), "rank")


def document_scores(spark, d):
    """Every document's score for quality: learned from three folds of the labelled ones, cut by one, one held out."""
    counts = _document_counts(spark, d)
    fold = F.pmod(F.col("doc_id"), F.lit(5))
    labels = table(spark, d, "labels").select(F.col("doc_id").alias("key"), F.col("quality").alias("label"), fold.alias("fold"))
    scores = text_scores(counts, term_log_odds(counts, labels.filter("fold > 1")))
    threshold = best_threshold(scores, labels.filter("fold = 1")).select("threshold").scalar()
    judged = scores.join(labels, "key", "left").select(
        F.col("key").alias("doc_id"),
        "n_terms",
        "n_known",
        F.round("score", 6).alias("score"),
        (F.col("score") >= threshold).alias("is_good"),
        "label",
        (F.col("fold") == 0).alias("held_out"),
    )
    return judged.withColumn("label", F.col("label").cast("int"))


QUERIES: dict[str, Query] = {
    "clean_items": clean_items,
    "dedup_items": dedup_items,
    "owner_intervals": owner_intervals,
    "explode_genres": explode_genres,
    "melt_votes": melted_votes,
    "dq_report": quality,
    "releases_by_year": by_year,
    "peak_year": peak_year,
    "share_since_year": share_since_year,
    "last_n_years": last_n_years,
    "recent_years_ranked": recent_years_ranked,
    "genre_stats": genre_stats,
    "genre_playtime": genre_playtime,
    "price_band_stats": price_band_stats,
    "price_band_ordered": price_band_ordered,
    "price_tier_stats": price_tier_stats,
    "price_histogram": price_histogram,
    "free_paid_split": free_paid_split,
    "median_price": median_price,
    "top_developers": top_developers,
    "top_publishers": top_publishers,
    "platform_share": platform_share,
    "platform_rate_by_year": platform_rate_by_year,
    "platform_rate_long": platform_rate_long,
    "top_tags": top_tags,
    "top_tags_10": top_tags_10,
    "achievement_band_stats": achievement_band_stats,
    "kpi_summary": kpi_summary,
    "csv_feed_clean": csv_feed_clean,
    "csv_wide_melt": csv_wide_melt,
    "csv_free_text": csv_free_text,
    "partition_roundtrip": partition_roundtrip,
    "flat_copy": flat_copy,
    "warehouse_years": warehouse_years,
    "warehouse_tags": warehouse_tags,
    "exported_genres": exported_genres,
    "exported_kpis": exported_kpis,
    "sql_views": sql_views,
    "export_all": export_all,
    "clean_job_counts": clean_job_counts,
    "warehouse_tiers": warehouse_tiers,
    "median_decimal": median_decimal,
    "tag_pairs": event_pairs,
    "genre_pairs": genre_pairs,
    "related_genres": related_genres,
    "page_text": page_text,
    "page_fields": page_fields,
    "requirement_fields": requirement_fields,
    "props_schema": props_schema,
    "props_columns": props_columns,
    "props_children": props_children,
    "nested_schema": nested_schema,
    "monthly_trend": monthly_trend,
    "category_trends": category_trends,
    "top_terms": document_terms,
    "document_scores": document_scores,
}
