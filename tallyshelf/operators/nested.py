"""Nested JSON-like text: its schema, its columns and its child tables, without losing a row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyshelf.functions.names import named, quoted
from tallyshelf.sources.scratch import scratch_folder

#: The types of a path, narrowest first within the numbers.
NULL, BOOLEAN, WHOLE, LARGE, REAL, TEXT, STRUCT, ARRAY = (
    "null", "boolean", "bigint", "decimal(38,0)", "double", "string", "struct", "array",
)


def parsed(text: Column) -> Column:
    """Text as a variant, NULL if it does not parse.

    JSON with double or single quotes. What follows the first value is an error, as are a key given twice
    and words other than true, false and null.
    """
    return F.from_json(text, "variant", {"allowSingleQuotes": "true", "mode": "PERMISSIVE"})


def quarantine(df: DataFrame, column: str) -> DataFrame:
    """The rows of ``df`` whose text does not parse; NULL and blank text are no error."""
    text = named(column)
    return df.filter((F.length(F.trim(text)) > 0) & parsed(text).isNull())


def _kind(value: Column) -> Column:
    shape = F.schema_of_variant(value)
    return (
        F.when(shape.startswith("OBJECT"), STRUCT)
        .when(shape.startswith("ARRAY"), ARRAY)
        .when(shape == "VOID", NULL)
        .when(shape == "BOOLEAN", BOOLEAN)
        .when(shape == "BIGINT", WHOLE)
        .when(shape.rlike(r"^DECIMAL\((?:19|[23][0-9]),0\)$"), LARGE)
        .when(shape.startswith("DECIMAL") | shape.isin("DOUBLE", "FLOAT"), REAL)
        .otherwise(TEXT)
    )


def _below(path: Column, value: Column, kind: Column) -> Column:
    """``(path, value)`` of the members of an object or array."""
    members = F.map_entries(F.when(kind == STRUCT, value.cast("map<string,variant>")))
    plain = r"^[A-Za-z_][A-Za-z_0-9]*$"

    def step(name: Column) -> Column:
        escaped = F.concat(F.lit("['"), F.replace(F.replace(name, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'")), F.lit("']"))
        return F.when(name.rlike(plain), F.concat(F.lit("."), name)).otherwise(escaped)

    of_object = F.transform(
        members, lambda m: F.struct(F.concat(path, step(m["key"])).alias("path"), m["value"].alias("value"))
    )
    elements = F.when(kind == ARRAY, value.cast("array<variant>"))
    of_array = F.transform(elements, lambda e: F.struct(F.concat(path, F.lit("[*]")).alias("path"), e.alias("value")))
    return F.coalesce(of_object, of_array)


def discover_schema(df: DataFrame, column: str) -> DataFrame:
    """``(path, type, n, n_null, n_types, conflict)``: every path of all rows and the type that holds its values.

    ``$`` is the whole value, ``.key`` and ``['key']`` a member, ``[*]`` an array's
    elements, all of them alike. ``n`` counts values that are not null, ``n_null``
    nulls; a key that a row lacks counts in neither. Types widen from bigint to decimal(38,0)
    to double; any other mixture (boolean with number, struct with array, ...) is
    a ``conflict`` and has type string, which holds the JSON text. Only nulls: string.

    Each task counts its paths and types, the counts are added up: the schema may
    be merged from parts in any order, and keys that are few or many make no
    difference. One pass over the texts per level of nesting; the counts of a level
    are written to the shared folder. NULL and text that does not parse take no part.
    """
    spark = df.sparkSession
    values = df.select(parsed(named(column)).alias("value")).filter("value IS NOT NULL")
    level = values.select(F.lit("$").alias("path"), "value")
    counts: DataFrame | None = None
    while True:
        typed = level.withColumn("kind", _kind(F.col("value")))
        found = typed.groupBy("path", "kind").agg(F.count("*").alias("n"))
        folder = scratch_folder(spark, "level")
        found.write.parquet(folder)
        part = spark.read.schema(found.schema).parquet(folder)
        counts = part if counts is None else counts.unionByName(part)
        if part.filter(F.col("kind").isin(STRUCT, ARRAY)).isEmpty():
            return _widened(counts)
        nested = typed.filter(F.col("kind").isin(STRUCT, ARRAY))
        below = nested.select(F.explode(_below(F.col("path"), F.col("value"), F.col("kind"))).alias("m"))
        level = below.select("m.path", "m.value")


def _widened(counts: DataFrame) -> DataFrame:
    kinds = F.collect_set(F.when(F.col("kind") != NULL, F.col("kind")))
    merged = counts.groupBy("path").agg(
        F.array_sort(kinds).alias("kinds"),
        F.sum(F.when(F.col("kind") != NULL, F.col("n")).otherwise(0)).alias("n"),
        F.sum(F.when(F.col("kind") == NULL, F.col("n")).otherwise(0)).alias("n_null"),
    )
    n_types = F.size("kinds")
    numbers = F.size(F.array_except("kinds", F.array(F.lit(WHOLE), F.lit(LARGE), F.lit(REAL)))) == 0
    wider = F.when(F.array_contains("kinds", REAL), REAL).otherwise(LARGE)
    kind = F.when(n_types == 0, TEXT).when(n_types == 1, F.get("kinds", F.lit(0))).when(numbers, wider).otherwise(TEXT)
    conflict = (n_types > 1) & ~numbers
    return merged.select("path", kind.alias("type"), "n", "n_null", n_types.alias("n_types"), conflict.alias("conflict"))


def schema_text(paths: DataFrame, most: int = 10_000) -> str:
    """The discovered schema as one type, ``struct<...>``, for ``from_json``.

    Members in order of name. The paths come to the driver: more than ``most`` are
    an error, as such keys are data and want a map.
    """
    rows = {r.path: r.type for r in paths.limit(most + 1).select("path", "type").collect()}
    if len(rows) > most:
        raise ValueError(f"more than {most} paths")
    below: dict[str, list[tuple[str, str]]] = {}
    for path in rows:
        if path != "$":
            parent, name = _parent(path)
            below.setdefault(parent, []).append((name, path))

    def text(path: str) -> str:
        kind = rows.get(path, TEXT)
        if kind == STRUCT:
            members = sorted(below.get(path, []))
            return "struct<" + ",".join(f"{quoted(name)}:{text(child)}" for name, child in members) + ">"
        if kind == ARRAY:
            return f"array<{text(path + '[*]')}>" if path + "[*]" in rows else "array<string>"
        return kind

    return text("$")


def _parent(path: str) -> tuple[str, str]:
    if path.endswith("[*]"):
        return path[:-3], ""
    if path.endswith("']"):
        at = len(path) - 2
        while True:
            at = path.rfind("['", 0, at)
            inner = path[at + 2 : -2]
            # A quote inside a name is escaped, so the name begins where none is left open.
            if "'" not in inner.replace("\\\\", "").replace("\\'", ""):
                return path[:at], inner.replace("\\'", "'").replace("\\\\", "\\")
    parent, _, name = path.rpartition(".")
    return parent, name


def nested_columns(df: DataFrame, column: str, columns: Mapping[str, tuple[str, str]], prefix: str = "") -> DataFrame:
    """``df`` with typed columns from its nested text, and with what they do not hold.

    ``columns`` maps a new column to its path and type. Also new are ``rest``: the
    members of the top object that no path begins with, as JSON, NULL if none (all
    of a value that is no object); ``misfits``: the names of columns whose path has a value that is not of their
    type (the column is NULL): numbers hold no text or boolean and whole numbers no
    fraction, string holds anything as JSON; and ``is_parsed``: false for text that does not
    parse, NULL for NULL or blank text. No row is lost; one that does not parse
    has NULL in all columns and keeps its text. ``prefix`` goes before the three
    names, should ``df`` have such columns.
    """
    taken = {*columns, *(prefix + n for n in ("rest", "misfits", "is_parsed"))} & set(df.columns)
    if taken:
        raise ValueError(f"columns {sorted(taken)} exist already")
    # The parsed value beside the row as one struct: no name can clash, and the text is parsed once.
    both = df.select(F.struct(*map(named, df.columns)).alias("row"), parsed(named(column)).alias("value"))
    value, text = F.col("value"), F.col("row")[column]
    new, misfits = [], []
    for name, (path, kind) in columns.items():
        new.append(_typed(value, path, kind).alias(name))
        whole = F.try_variant_get(value, path, "variant")
        wrong = whole.isNotNull() & ~F.is_variant_null(whole) & _typed(value, path, kind).isNull()
        misfits.append(F.when(F.coalesce(wrong, F.lit(False)), F.lit(name)))
    known = sorted({_top(path) for path, _ in columns.values()} - {None})
    members = F.map_filter(
        value.cast("map<string,variant>"), lambda k, _: ~k.isin(known) if known else F.lit(True)
    )
    rest = F.when(_kind(value) == STRUCT, F.when(F.size(members) > 0, F.to_json(members))).otherwise(F.to_json(value))
    return both.select(
        *[F.col("row")[c].alias(c) for c in df.columns],
        *new,
        rest.alias(prefix + "rest"),
        F.filter(F.array(*misfits), lambda m: m.isNotNull()).alias(prefix + "misfits"),
        F.when(F.length(F.trim(text)) > 0, value.isNotNull()).alias(prefix + "is_parsed"),
    )


def _typed(value: Column, path: str, kind: str) -> Column:
    """The value at ``path``, NULL unless its JSON type is one that ``kind`` holds without loss."""
    found = F.try_variant_get(value, path, kind)
    family = kind.partition("(")[0]
    holds = {"boolean": [BOOLEAN], "tinyint": [WHOLE], "smallint": [WHOLE], "int": [WHOLE], "bigint": [WHOLE, LARGE]}
    holds |= {"float": [WHOLE, LARGE, REAL], "double": [WHOLE, LARGE, REAL], "decimal": [WHOLE, LARGE, REAL]}
    holds |= {"date": [TEXT], "timestamp": [TEXT], "timestamp_ntz": [TEXT]}
    if family not in holds:
        return found
    return F.when(_kind(F.try_variant_get(value, path, "variant")).isin(holds[family]), found)


def _top(path: str) -> str | None:
    """The member of the top object that a path begins with."""
    while path != "$":
        parent, name = _parent(path)
        if parent == "$":
            return name
        path = parent
    return None


def child_rows(
    df: DataFrame, keys: Sequence[str], column: str, path: str, columns: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """``(keys, position, <columns>, value)``: a row per element of the array at ``path``, by the parent's keys.

    ``columns`` maps a column to its path within an element and its type; ``value``
    is the element as JSON, whatever it is. A value at ``path`` that is no array is its one element;
    without a value there are no rows. Positions count from 0. Nothing shuffles.
    """
    at = F.try_variant_get(parsed(named(column)), path, "variant")
    several = F.when(_kind(at) == ARRAY, at.cast("array<variant>")).when(
        at.isNotNull() & ~F.is_variant_null(at), F.array(at)
    )
    rows = df.select(*[named(k).alias(k) for k in keys], F.posexplode(several).alias("position", "_element"))
    element = F.col("_element")
    return rows.select(
        *map(named, keys),
        "position",
        *[_typed(element, p, kind).alias(name) for name, (p, kind) in columns.items()],
        F.to_json(element).alias("value"),
    )
