"""Feed to clean zone, catalog and export, in a scratch folder."""

import json
from pathlib import Path

import pytest

from feeds import ROWS, TAGS_CSV, store_csv
from tallyshelf.plans import reports
from tallyshelf.plans.jobs import clean_job, export_job, publish_job, row_counts
from tallyshelf.sources.catalog import drop_table, external_table, tables_in
from tallyshelf.sources.readers import read_feed, read_record, read_result, read_table
from tallyshelf.sources.scratch import scratch_folder
from tallyshelf.sources.writers import flatten_table, save_result, write_partitioned, write_table


@pytest.fixture(scope="module")
def zone(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("zones")
    (root / "items.csv").write_text(store_csv())
    (root / "tags.csv").write_text(TAGS_CSV)
    report = clean_job(spark, str(root / "items.csv"), str(root / "tags.csv"), str(root / "clean"))
    assert report.collect() == [(10, 1, 2, 0.693, 1)]  # ratios sum to 6.2333 over 9
    return root


@pytest.fixture(scope="module")
def items(spark, zone):
    return read_table(spark, f"{zone}/clean/games")


@pytest.fixture(scope="module")
def tags(spark, zone):
    return read_table(spark, f"{zone}/clean/tags_long")


def test_clean_zone_is_partitioned_by_year(zone, items):
    folders = {p.name for p in (zone / "clean" / "games").iterdir() if p.is_dir()}
    assert "release_year=2015" in folders
    assert "release_year=__HIVE_DEFAULT_PARTITION__" in folders
    assert dict(items.dtypes)["release_year"] == "int"
    assert items.filter("release_year IS NULL").count() == 2


def test_year_filter_prunes_partitions(items):
    by_year = reports.releases_by_year(items, 2015, 2016)
    scan = by_year._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(release_year" in scan
    assert by_year.collect() == [(2015, 3), (2016, 1)]


def test_row_counts(spark, zone):
    counts = {r["table"]: r["n"] for r in row_counts(spark, str(zone / "items.csv"), f"{zone}/clean").collect()}
    assert counts == {"raw": len(ROWS), "clean": 10, "tags": 5}


def test_rerun_replaces_the_zone(spark, zone, items):
    before = sorted(r["appid"] for r in items.collect())
    clean_job(spark, str(zone / "items.csv"), str(zone / "tags.csv"), f"{zone}/again")
    clean_job(spark, str(zone / "items.csv"), str(zone / "tags.csv"), f"{zone}/again")
    again = read_table(spark, f"{zone}/again/games")
    assert sorted(r["appid"] for r in again.collect()) == before


def test_publish_partitioned(spark, zone, items):
    listed = publish_job(spark, f"{zone}/clean", "shelf_a", location=f"{zone}/shelf_a.db")
    assert {r["tableName"] for r in listed.filter("NOT isTemporary").collect()} == {"games", "tags_long"}
    assert spark.table("shelf_a.games").count() == items.count() == 10
    assert spark.sql("DESCRIBE EXTENDED shelf_a.games").filter("col_name = 'Type'").first()[1] == "EXTERNAL"
    ranked = reports.years_ranked(spark.table("shelf_a.games"), 2014, 2019).collect()
    assert ranked[0] == (2015, 3)
    drop_table(spark, "shelf_a.games")
    assert tables_in(spark, "shelf_a").filter("NOT isTemporary").count() == 1
    assert read_table(spark, f"{zone}/clean/games").count() == 10


def test_publish_flat(spark, zone):
    publish_job(
        spark, f"{zone}/clean", "shelf_b", warehouse_zone=f"{zone}/warehouse",
        location=f"{zone}/shelf_b.db",
    )
    table = spark.table("shelf_b.games")
    assert table.count() == 10 and "release_year" in table.columns
    assert not list((zone / "warehouse" / "games").glob("release_year=*"))


def test_unregistered_partitions_are_invisible(spark, zone):
    external_table(spark, "default.unregistered", f"{zone}/clean/games")
    assert spark.table("default.unregistered").count() == 0
    external_table(spark, "default.unregistered", f"{zone}/clean/games", partitioned=True)
    assert spark.table("default.unregistered").count() == 10
    drop_table(spark, "default.unregistered")


def test_export(spark, zone, items, tags):
    out = zone / "export"
    export_job(items, tags, str(out))
    assert {p.name for p in out.iterdir()} == {
        "q1_release", "q2_genre", "q3_price", "q4_playtime", "q5_dev", "q5_pub", "q6_platform",
        "q7_tags", "q8_ach", "summary",
    }
    headers = {}
    for folder in out.iterdir():
        (part,) = list(folder.glob("part-*"))
        headers[folder.name] = part.read_text().splitlines()[:1]
    assert headers["q1_release"] == ["release_year,n_games"]
    assert headers["q3_price"] == ["price_band,n,avg_ratio,avg_owners"]
    assert headers["q7_tags"] == ["tag,total_votes,n_games"]
    summary = json.loads(headers["summary"][0])
    assert summary["total_games"] == 10 and summary["median_price_gbp"] == 4.99
    record = reports.kpi_summary(items)
    assert read_record(spark, f"{out}/summary", record.schema).collect() == record.collect()


def test_exported_order_and_quotes_survive(spark, tmp_path):
    rows = [('a "b", c', 3), ("line", 9), ("z", 3)]
    df = spark.createDataFrame(rows, "name string, n bigint").repartition(3)
    save_result(df, str(tmp_path / "r"), "-n", "name")
    assert read_result(spark, str(tmp_path / "r"), "name string, n bigint").collect() == [
        ("line", 9), ('a "b", c', 3), ("z", 3),
    ]


def test_partition_roundtrip_and_flat_copy(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "IF(id % 10 = 0, NULL, INT(2000 + id % 3)) AS release_year")
    write_partitioned(df, str(tmp_path / "p"), "release_year")
    assert sorted(read_table(spark, str(tmp_path / "p")).collect(), key=repr) == sorted(df.collect(), key=repr)
    flatten_table(spark, str(tmp_path / "p"), str(tmp_path / "f"))
    assert read_table(spark, str(tmp_path / "f")).exceptAll(df).count() == 0


def test_hot_partition_is_written_by_several_tasks(spark, tmp_path):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    rows = spark.range(0, 60_000, 1, 8).selectExpr(
        "id", "uuid() AS text", "IF(id % 3 = 0, 2018, INT(2000 + id % 5)) AS release_year"
    )
    spark.conf.set(size, "200k")
    try:
        write_partitioned(rows, str(tmp_path / "p"), "release_year")
    finally:
        spark.conf.unset(size)
    files = {p.name: len(list(p.glob("*.parquet"))) for p in Path(tmp_path / "p").iterdir() if p.is_dir()}
    assert files["release_year=2018"] > 1
    assert read_table(spark, str(tmp_path / "p")).count() == 60_000


def test_overwrite(spark, tmp_path):
    for n in (5, 3):
        write_table(spark.range(n), str(tmp_path / "t"))
    assert read_table(spark, str(tmp_path / "t")).count() == 3


def test_free_text_fields_may_hold_line_breaks(spark, tmp_path):
    (tmp_path / "text.csv").write_text('id,body\n1,"two\nlines, ""quoted"""\n2,plain\n')
    whole = read_feed(spark, str(tmp_path / "text.csv"), free_text=True)
    assert whole.collect() == [("1", 'two\nlines, "quoted"'), ("2", "plain")]
    assert read_feed(spark, str(tmp_path / "text.csv")).count() == 3


def test_scratch_folders_lie_below_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_folder(spark, "x"), scratch_folder(spark, "x")
    assert first.startswith(base) and first != second
