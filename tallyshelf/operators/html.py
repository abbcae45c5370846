"""Web pages to text, and their lists and tables to rows and typed columns."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyshelf.functions import html as pages
from tallyshelf.functions.casts import to_integral
from tallyshelf.functions.names import named

_FIELD = "struct<kind:string,depth:int,section:string,name:string,value:string,cells:array<string>,link:string>"
_TOKEN = "struct<kind:string,name:string,text:string,attributes:map<string,string>>"
_FIELD_ARROW = pa.struct(
    [("kind", pa.string()), ("depth", pa.int32()), ("section", pa.string()), ("name", pa.string())]
    + [("value", pa.string()), ("cells", pa.list_(pa.string())), ("link", pa.string())]
)
_TOKEN_ARROW = pa.struct(
    [("kind", pa.string()), ("name", pa.string()), ("text", pa.string()), ("attributes", pa.map_(pa.string(), pa.string()))]
)


def _each(
    df: DataFrame, key: str, html: str, read: Callable[[str], Sequence], columns: Mapping[str, tuple[str, pa.DataType]]
) -> DataFrame:
    """``key`` and what ``read`` makes of each page, one value a column; NULL pages count as empty."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [read(value.as_py()) for value in batch.column(1)]
            made = [pa.array([r[i] for r in rows], kind) for i, (_, kind) in enumerate(columns.values())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], ["key", *columns])

    kind = df.schema[key].dataType.simpleString()
    source = F.coalesce(named(html).cast("string"), F.lit(""))
    fields = ", ".join([f"key {kind}", *(f"{name} {kind}" for name, (kind, _) in columns.items())])
    return df.select(named(key).alias("key"), source.alias("html")).mapInArrow(work, fields)


def html_text(df: DataFrame, key: str, html: str) -> DataFrame:
    """``(key, title, text)``, one row per page: see ``functions.html.page_text``. Nothing shuffles."""
    text = ("string", pa.string())
    return _each(df, key, html, pages.page_text, {"title": text, "text": text})


def html_tokens(df: DataFrame, key: str, html: str) -> DataFrame:
    """``(key, position, kind, name, text, attributes)``: a row per token of each page, in order."""

    def read(source: str) -> list:
        return [[{**t._asdict(), "attributes": list(t.attributes)} for t in pages.tokens(source)]]

    found = _each(df, key, html, read, {"tokens": (f"array<{_TOKEN}>", pa.list_(_TOKEN_ARROW))})
    return found.select("key", F.posexplode("tokens").alias("position", "t")).select("key", "position", "t.*")


def html_fields(df: DataFrame, key: str, html: str) -> DataFrame:
    """``(key, position, kind, depth, section, name, value, cells, link)``: a row per list item, table row and definition.

    See ``functions.html.page_fields``. Pages without any give no row. Nothing shuffles.
    """

    def read(source: str) -> list:
        return [[{**f._asdict(), "cells": list(f.cells)} for f in pages.page_fields(source)]]

    found = _each(df, key, html, read, {"fields": (f"array<{_FIELD}>", pa.list_(_FIELD_ARROW))})
    return found.select("key", F.posexplode("fields").alias("position", "f")).select("key", "position", "f.*")


#: A number as pages write it, with commas between thousands.
NUMBER = r"([-+]?[0-9][0-9,]*(?:\.[0-9]+)?)"


def _typed(value: Column, kind: str) -> Column:
    if kind == "string":
        return value
    if kind == "date":
        return F.try_to_date(F.regexp_substr(value, F.lit(r"[0-9]{4}-[0-9]{2}-[0-9]{2}")), "yyyy-MM-dd")
    number = F.regexp_replace(F.regexp_substr(value, F.lit(NUMBER)), ",", "")
    if kind in ("int", "bigint"):
        return to_integral(number, kind)
    return number.try_cast(kind)


def typed_fields(fields: DataFrame, columns: Mapping[str, tuple[Sequence[str], str]]) -> DataFrame:
    """``(key, <columns>, rest)``: the named fields of each page as typed columns.

    ``columns`` maps a column to the names its field may have, upper and lower case
    alike, and its type: string, date (the first yyyy-MM-dd in the value), int,
    bigint, double or decimal (the first number in it, commas between thousands
    left out). Of several fields for a column the first on the page counts.
    ``rest`` maps all other names to their first value, and those of a column whose
    value has no such number or date: nothing that was named is lost. Every key of
    ``fields`` has a row. Fields are combined per page before the shuffle.
    """
    wanted = {name.lower(): column for column, (names, _) in columns.items() for name in names}
    if len(wanted) != sum(len(names) for names, _ in columns.values()):
        raise ValueError("a field name belongs to one column only")
    name = F.lower("name")
    first = fields.groupBy("key", name.alias("name")).agg(
        F.min(F.struct("position", F.col("name").alias("written"), "value")).alias("f")
    )
    known = F.create_map(*[F.lit(x) for pair in wanted.items() for x in pair]) if wanted else None
    column = F.try_element_at(known, F.col("name")) if wanted else F.lit(None).cast("string")
    rows = first.withColumn("column", F.when(F.col("name").isNotNull(), column))
    values = {c: _typed(F.col("f.value"), kind) for c, (_, kind) in columns.items()}
    fits = F.lit(False)
    for c in columns:
        fits = fits | F.coalesce((F.col("column") == c) & values[c].isNotNull(), F.lit(False))
    entry = F.struct(F.col("f.written").alias("key"), F.col("f.value").alias("value"))
    left = F.when(F.col("name").isNotNull() & ~fits, entry)
    return rows.groupBy("key").agg(
        *[F.min_by(values[c], F.when((F.col("column") == c) & fits, F.col("f.position"))).alias(c) for c in columns],
        F.map_from_entries(F.array_sort(F.collect_list(left))).alias("rest"),
    )
