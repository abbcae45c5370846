"""CSV files read back as they were written, and never by position."""

import pytest
from pyspark.sql import functions as F

from tallyshelf.operators.reshape import melt_votes
from tallyshelf.sources.readers import NULL_MARK, read_feed, read_result
from tallyshelf.sources.writers import save_result, write_csv

TEXTS = [" RPG", "RPG", "x ", "  a ", "a\n", "\n", "", None, ' "quoted", \\ ', "\t"]


def test_white_space_empty_and_null_texts_come_back(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "n int, t string")
    write_csv(df, str(tmp_path / "free"))
    got = read_feed(spark, str(tmp_path / "free"), ["n", "t"], free_text=True, null=NULL_MARK)
    assert sorted((int(r.n), r.t) for r in got.collect()) == rows
    plain = df.filter(F.coalesce(~F.col("t").contains("\n"), F.lit(True)))
    save_result(plain, str(tmp_path / "result"), "n")
    back = read_result(spark, str(tmp_path / "result"), "n int, t string")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, plain.collect()))


def put(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)
    return str(folder)


def test_reordered_headers_fail(spark, tmp_path):
    path = put(tmp_path / "one", "a.csv", "b,a\nB1,A1\n")
    with pytest.raises(Exception, match="header"):
        read_feed(spark, path, ["a", "b"]).collect()
    with pytest.raises(Exception, match="header"):
        read_result(spark, path, "a string, b string").collect()


def test_files_with_different_headers_fail(spark, tmp_path):
    put(tmp_path / "two", "a.csv", "appid,x,y\n1,5,0\n" * 1)
    path = put(tmp_path / "two", "b.csv", "appid,y,x\n2,7,0\n")
    with pytest.raises(Exception, match="header"):
        melt_votes(read_feed(spark, path)).collect()


def test_an_empty_field_is_null_in_a_feed(spark, tmp_path):
    path = put(tmp_path / "feed", "a.csv", 'a,b\n,x\n"",y\n')
    assert [r.a for r in read_feed(spark, path, ["a", "b"]).orderBy("b").collect()] == [None, None]
