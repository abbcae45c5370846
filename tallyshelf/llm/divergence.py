"""How far sources differ in their terms, priced over hash-consed segment trees."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyshelf.llm.common import rank_in_group, stored, text_or_empty

#: A term is a run of ASCII letters and characters beyond ASCII; A to Z count as a to z.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
#: Entries of a task's counts before they are sent on; bytes of a text that are split at once.
HELD, PIECE = 300_000, 1 << 20
#: Term ids of one segment (a power of two), sources that meet in one, pairs of sources walked at once.
SEGMENT, SOURCES, PAIRS = 4096, 64, 64
SHARE = 1_000_000_000


def terms_of(text: str) -> Iterator[list[bytes]]:
    """The terms of a text as UTF-8, in lists of bounded size."""
    data = text.encode().translate(FOLD)
    start = 0
    while len(data) - start > PIECE:
        end = data.find(b" ", start + PIECE)
        if end < 0:
            break
        yield data[start:end].split()
        start = end
    yield (data[start:] if start else data).split()


def term_counts(df: DataFrame, lang: str, source: str, text: str, held_entries: int = HELD) -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences, and documents with the term; groups without terms are left out."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        entries = 0

        def rows() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, docs) in held.items():
                size = len(n)
                terms = pa.array(n.keys(), pa.binary()).cast(pa.string())
                columns = [
                    pa.repeat(pa.scalar(lang), size),
                    pa.repeat(pa.scalar(source), size),
                    terms,
                    pa.array(n.values(), pa.int64()),
                    pa.array([docs[t] for t in n], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])

        for batch in batches:
            for lang, source, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                n, docs = held.setdefault((lang, source), (Counter(), Counter()))
                before, seen = len(n), set()
                for terms in terms_of(text):
                    n.update(terms)
                    seen.update(terms)
                docs.update(seen)
                entries += len(n) - before
                if entries > held_entries:
                    yield from rows()
                    held.clear()
                    entries = 0
        yield from rows()

    narrow = df.select(*[text_or_empty(c) for c in (lang, source, text)])
    parts = narrow.mapInArrow(count, "lang string, source string, term string, n bigint, docs bigint")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


class Forest:
    """Segment trees over the same ids, one a group; equal subtrees are one node, whoever has them.

    ``counts`` has a row per group; its length is a power of two, and ids that do
    not exist have the count -1. A node is numbered per level: a leaf by its
    count, any other by its two children.
    """

    def __init__(self, counts: np.ndarray):
        self.values, ids = np.unique(counts, return_inverse=True)
        ids = ids.reshape(counts.shape)
        self.children: list[tuple[np.ndarray, np.ndarray]] = []
        self.sizes = [len(self.values)]
        while ids.shape[1] > 1:
            width = self.sizes[-1]
            nodes, inverse = np.unique(ids[:, 0::2] * width + ids[:, 1::2], return_inverse=True)
            ids = inverse.reshape(ids.shape[0], -1)
            self.children.append((nodes // width, nodes % width))
            self.sizes.append(len(nodes))
        self.roots = ids[:, 0]

    def walk(self, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, ...]:
        """``(pair, x, y, times)``: how often leaf ``x`` of the first group stands beside ``y`` of the second.

        Both trees of a pair of groups are descended together; node pairs that are
        equal within it are one, with the number of places they stand for.
        """
        pair, times = np.arange(len(first)), np.ones(len(first), np.int64)
        x, y = self.roots[first], self.roots[second]
        for (left, right), width in zip(reversed(self.children), reversed(self.sizes[:-1]), strict=True):
            below = [(pair * width + side[x]) * width + side[y] for side in (left, right)]
            nodes, inverse = np.unique(np.concatenate(below), return_inverse=True)
            sums = np.zeros(len(nodes), np.int64)
            np.add.at(sums, inverse, np.concatenate([times, times]))
            pair, x, y, times = nodes // (width * width), nodes // width % width, nodes % width, sums
        return pair, x, y, times


def smoothed(counts: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 * (count + 2) / whole): a row per group, a column per count; exact at any size."""
    if counts.max(initial=0) + 2 < (1 << 63) // SHARE:
        return 1 + SHARE * (counts + 2)[None, :] // whole[:, None]
    return np.array([[1 + SHARE * (int(c) + 2) // int(w) for c in counts] for w in whole], np.int64)


def pair_prices(
    counts: np.ndarray, whole: np.ndarray, first: np.ndarray, second: np.ndarray
) -> np.ndarray:
    """The sum over all ids of floor((p - q)^2 / (p + q)) for each pair of rows of ``counts``."""
    forest, out = Forest(counts), np.zeros(len(first), np.int64)
    shares = smoothed(forest.values, whole)
    for start in range(0, len(first), PAIRS):
        one, other = first[start : start + PAIRS], second[start : start + PAIRS]
        pair, x, y, times = forest.walk(one, other)
        p, q = shares[one[pair], x], shares[other[pair], y]
        price = np.where(forest.values[x] < 0, 0, (p - q) * (p - q) // (p + q))
        np.add.at(out, start + pair, price * times)
    return out


def _price(key: tuple[pa.Scalar, ...], table: pa.Table, size: int, block: int) -> pa.Table:
    """All pairs of the sources that meet in one segment of one language."""
    lang, segment, low, high = (k.as_py() for k in key)
    sid, at, n = (table.column(c).to_numpy() for c in ("sid", "at", "n"))
    heads = at < 0
    own, order = np.unique(sid[heads], return_index=True)
    whole, terms = n[heads][order], int(table.column("terms")[0].as_py())
    counts = np.full((len(own), size), -1, np.int64)
    counts[:, : max(0, min(size, terms - segment * size))] = 0
    counts[np.searchsorted(own, sid[~heads]), at[~heads]] = n[~heads]
    is_low = own // block == low
    if low == high:
        first, second = np.triu_indices(len(own), 1)
    else:
        one, other = np.flatnonzero(is_low), np.flatnonzero(~is_low)
        first, second = np.repeat(one, len(other)), np.tile(other, len(one))
    value = pair_prices(counts, np.maximum(whole, 1), first, second)
    columns = [
        pa.repeat(pa.scalar(lang), len(value)),
        pa.array(own[first], pa.int64()),
        pa.array(own[second], pa.int64()),
        pa.array(value, pa.int64()),
    ]
    return pa.Table.from_arrays(columns, ["lang", "a", "b", "value"])


def _share(n: Column, whole: Column) -> Column:
    """``smoothed`` as a column."""
    wide = F.lit(SHARE).cast("decimal(10,0)") * (n + 2).cast("decimal(20,0)")
    return F.call_function("div", wide, whole.cast("decimal(20,0)")) + 1


def _apart(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def source_divergence(
    df: DataFrame,
    lang: str,
    source: str,
    text: str,
    *,
    least_docs: int = 10,
    top: int = 10,
    segment: int = SEGMENT,
    block: int = SOURCES,
    held: int = HELD,
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: sources against each other and against their language.

    A language keeps the terms that ``least_docs`` of its documents have. With p
    and q the smoothed shares of a term in billionths, a term's distance is
    floor((p - q)^2 / (p + q)), in whole numbers throughout. Part ``pair`` has for
    each source all others of its language and the sum over all kept terms; part
    ``term`` the ``top`` kept terms that the source has more of than its language.

    Each task counts the terms of its texts and sends sums on. Term ids are given
    by falling count, so rare terms lie together. The ids are cut into segments of
    ``segment`` (a power of two) and the sources into blocks of ``block``: one group
    holds two blocks' counts of one segment, at most 128 * 4096, whatever the corpus,
    builds one forest of shared nodes and walks the pairs of trees. A hot source
    is one more row of each segment.

    NULL texts, languages and sources count as empty texts. A group without terms
    has all counts 0; a language without kept terms has pairs of value 0. Repeated
    rows count each time, long texts are split whole, one text's distinct terms are
    held at once. An empty table gives an empty one, other columns are left out.
    """
    counts = stored(term_counts(df, lang, source, text, held), "terms")
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"))
    kept = stored(kept.filter(F.col("docs") >= least_docs).drop("docs"), "kept")
    level = F.lit(63) - F.floor(F.log2("total")).cast("int")
    salt = level * 64 + F.pmod(F.xxhash64("term"), F.lit(64)).cast("int")
    numbered = rank_in_group(kept, "lang", [F.desc("total"), F.col("term")], salt, "id")
    cells = stored(counts.drop("docs").join(numbered, ["lang", "term"]), "cells")

    languages = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("lang_n"))
    sizes = cells.groupBy("lang", "source").agg(F.sum("n").alias("source_n"))
    names = df.select(text_or_empty(lang).alias("lang"), text_or_empty(source).alias("source")).distinct()
    by_source = Window.partitionBy("lang").orderBy("source")
    groups = (
        names.join(sizes, ["lang", "source"], "left")
        .join(languages, "lang", "left")
        .na.fill(0, ["source_n", "lang_n", "terms"])
        .withColumn("sid", (F.row_number().over(by_source) - 1).cast("bigint"))
    )
    groups = stored(groups, "groups")
    terms = _term_part(cells, groups, top)
    pairs = _pair_part(cells, groups, segment, block)
    return pairs.unionByName(terms)


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = rows.withColumn("rank", F.row_number().over(by_value))
    return ranked.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def _term_part(cells: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    smoothing = 2 * F.col("terms")
    p = _share(F.col("n"), F.col("source_n") + smoothing)
    q = _share(F.col("total"), F.col("lang_n") + smoothing)
    shares = cells.join(groups, ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")
    )
    rows = shares.filter("p > q").withColumn("value", _apart(F.col("p"), F.col("q")))
    return _ranked(rows, "term").filter(F.col("rank") <= top)


def _pair_part(cells: DataFrame, groups: DataFrame, size: int, block: int) -> DataFrame:
    blocks = groups.groupBy("lang").agg((F.floor(F.max("sid") / block) + 1).cast("bigint").alias("blocks"))
    known = groups.join(blocks, "lang").select("lang", "source", "sid", "blocks", "terms", "source_n")
    last = F.floor((F.greatest(F.col("terms"), F.lit(1)) - 1) / size).cast("bigint")
    # Every source has a head in every segment, with its denominator; terms it lacks have no row.
    heads = known.select(
        "lang", "sid", "blocks", "terms", F.explode(F.sequence(F.lit(0).cast("bigint"), last)).alias("segment"),
        F.lit(-1).alias("at"), (F.col("source_n") + 2 * F.col("terms")).alias("n"),
    )
    leaves = cells.join(known.drop("source_n"), ["lang", "source"]).select(
        "lang", "sid", "blocks", "terms", F.floor(F.col("id") / size).cast("bigint").alias("segment"),
        F.pmod(F.col("id"), F.lit(size)).cast("int").alias("at"), "n",
    )
    own = F.floor(F.col("sid") / block).cast("bigint")
    dealt = heads.unionByName(leaves).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    )
    dealt = dealt.select(
        "lang", "segment", F.least(own, "other").alias("low"), F.greatest(own, "other").alias("high"),
        "sid", "at", "n", "terms",
    )

    def price(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        return _price(key, rows, size, block)

    priced = dealt.groupBy("lang", "segment", "low", "high").applyInArrow(
        price, "lang string, a bigint, b bigint, value bigint"
    )
    summed = priced.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = summed.select(
        "lang", "value", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("p")
    ).select("lang", "value", F.col("p.a").alias("sid"), F.col("p.b").alias("other"))
    mine = groups.select("lang", "sid", "source")
    others = groups.select("lang", F.col("sid").alias("other"), F.col("source").alias("item"))
    return _ranked(both.join(mine, ["lang", "sid"]).join(others, ["lang", "other"]), "pair")
