"""Repeated strings by prefix doubling over sampled positions."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyshelf.functions.names import named
from tallyshelf.llm.common import discard, stored, text_or_empty, written

#: Bytes of text that are named at once.
CHUNK = 1 << 18
HIGH, LOW = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of a 64-bit number on every other: a fixed one-to-one map."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9FB21C651E98DF25)
    return x ^ (x >> np.uint64(32))


#: A 64-bit number for each byte, and an odd one for each doubling.
BYTES = _mixed(_mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
FACTORS = _mixed(np.arange(1, 65, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) | np.uint64(1)


def names(data: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit name of the ``length`` bytes at every position, by doubling.

    The name of 2n bytes is made from the names of the n bytes at a position and n
    bytes further on. A length that is no power of two takes two that overlap.
    """
    name, size, level = BYTES[data], 1, 0
    while size < length:
        step = min(size, length - size)
        name = name[:-step] + name[step:] * FACTORS[level]
        size, level = size + step, level + 1
    return name


def lowest(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values, by doubling."""
    size = 1
    while size < width:
        step = min(size, width - size)
        values = np.minimum(values[:-step], values[step:])
        size += step
    return values


def samples(
    data: bytes, ends: Sequence[int], length: int, least: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(first, n, name, block)``: runs of windows that choose the same position.

    ``data`` joins texts that end at ``ends``. Each window of ``least`` bytes within
    a text chooses one of its strings of ``length`` bytes: that of lowest mixed
    name, the leftmost of several. Equal windows choose the same offset, whatever
    stands around them, so windows can only be equal if the strings they choose
    are. ``name`` is that string's; ``block`` stands for all bytes of the run's
    windows and the place of the string in them.
    """
    none = np.zeros(0, np.int64)
    windows = len(data) - least + 1
    if windows <= 0:
        return none, none, none, none
    name = names(np.frombuffer(data, np.uint8), length)
    order = (_mixed(name) & HIGH) | np.arange(len(name), dtype=np.uint64)
    chosen = (lowest(order, least - length + 1) & LOW).astype(np.int64)
    crossing = np.zeros(windows + 1, np.int32)
    inner = np.asarray(ends, np.int64)[:-1]
    np.add.at(crossing, np.clip(inner - least + 1, 0, windows), 1)
    np.add.at(crossing, np.clip(inner, 0, windows), -1)
    place = np.flatnonzero(np.cumsum(crossing[:-1]) == 0)
    if not len(place):
        return none, none, none, none
    chosen = chosen[place]
    start = np.concatenate([[0], np.flatnonzero(np.diff(chosen)) + 1])
    first, last = place[start], place[np.append(start[1:], len(place)) - 1]
    at, view = chosen[start], memoryview(data)
    block = np.array(
        [
            xxhash.xxh3_64_intdigest(view[f : e + least], a - f)
            for f, e, a in zip(first.tolist(), last.tolist(), at.tolist(), strict=True)
        ],
        np.uint64,
    )
    return first, last - first + 1, _mixed(name[at]).view(np.int64), block.view(np.int64)


def chunks(
    texts: Iterable[bytes], least: int, most: int = CHUNK
) -> Iterator[tuple[bytes, list[int], list[tuple[int, int]]]]:
    """Texts joined to chunks of ``most`` bytes, about: ``(data, ends, (number, offset) of each text)``.

    A longer text is cut so that each of its windows lies whole in one chunk;
    texts without a window are left out.
    """
    parts: list[bytes] = []
    ends: list[int] = []
    origin: list[tuple[int, int]] = []
    for number, text in enumerate(texts):
        for offset in range(0, len(text) - least + 1, most):
            piece = text if len(text) <= most else text[offset : offset + most + least - 1]
            if ends and ends[-1] + len(piece) > most:
                yield b"".join(parts), ends, origin
                parts, ends, origin = [], [], []
            parts.append(piece)
            ends.append((ends[-1] if ends else 0) + len(piece))
            origin.append((number, offset))
    if ends:
        yield b"".join(parts), ends, origin


def doubled_lengths(base: int, least: int) -> list[int]:
    """Lengths of the strings that the rounds compare: at most double, and never past half of what is left."""
    out = [min(base, least)]
    while out[-1] < least:
        left = least - out[-1]
        out.append(least if left <= 8 else out[-1] + min(out[-1], -(-left // 2)))
    return out


FOUND = "doc binary, parent int, first int, n int, partner boolean, name bigint, block bigint"


def _sampled(windows: DataFrame, length: int, least: int, chunk: int) -> DataFrame:
    """``samples`` of each row's ``data``, whose windows start at ``first``."""

    def sample(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, start, partner = batch.column(0), batch.column(1).to_numpy(), batch.column(2)
            texts = (value.as_py() for value in batch.column(3))
            for data, ends, origin in chunks(texts, least, chunk):
                first, n, name, block = samples(data, ends, length, least)
                if not len(first):
                    continue
                rows, offsets = np.array(origin, np.int64).T
                text = np.searchsorted(ends, first, "right")
                own = rows[text]
                begin = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                at = start[own] + offsets[text] + first - begin[text]
                columns = [
                    doc.take(pa.array(own)),
                    pa.array(start[own], pa.int32()),
                    pa.array(at, pa.int32()),
                    pa.array(n, pa.int32()),
                    partner.take(pa.array(own)),
                    pa.array(name),
                    pa.array(block),
                ]
                yield pa.RecordBatch.from_arrays(columns, FOUND_NAMES)

    return windows.select("doc", "first", "partner", "data").mapInArrow(sample, FOUND)


FOUND_NAMES = [field.split()[0] for field in FOUND.split(", ")]


def _reranked(sampled: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """``(settled, open, folders)`` of the samples of one round; they read the folders.

    A name that occurs once ends its windows: nothing equals them. Of the others,
    samples with equal blocks settle each other: all their windows are repeated.
    Blocks that differ under one name stay open, one sample of each; a ``partner``
    is open only to be found, its own windows are settled.
    """
    found, path = written(sampled, "samples")
    # The names are written before they are joined: the join then deals out both sides itself and
    # can split a name that many samples have.
    shared, shared_path = written(
        found.groupBy("name").agg(F.count("*").alias("c")).filter("c > 1").select("name"), "names"
    )
    close, close_path = written(found.join(shared, "name", "left_semi"), "close")
    discard(found.sparkSession, [path, shared_path])
    place = F.min(F.struct("doc", "parent", "first", "n")).alias("place")
    counted = close.groupBy("name", "block").agg(F.count("*").alias("c"), F.min("partner").alias("partner"), place)
    classes, classes_path = written(counted, "classes")
    several = classes.filter("c > 1").select("name", "block")
    settled = close.filter("NOT partner").join(several, ["name", "block"], "left_semi").select("doc", "first", "n")
    mixed, mixed_path = written(
        classes.groupBy("name").agg(F.count("*").alias("k")).filter("k > 1").select("name"), "mixed"
    )
    left = classes.join(mixed, "name", "left_semi")
    left = left.select("place.*", (F.col("partner") | (F.col("c") > 1)).alias("partner"))
    return settled, left, [close_path, classes_path, mixed_path]


def _bytes_at(data: Column, first: Column, size: Column) -> Column:
    return F.substring(data, (first + 1).cast("int"), size.cast("int"))


def repeated_windows(texts: DataFrame, least: int, base: int, chunk: int = CHUNK) -> DataFrame:
    """``(doc, windows)``: runs ``(first, n)`` of the start places of repeated strings of ``least`` bytes.

    ``texts`` has ``(doc, data)``, the bytes and a key that tells different ones apart.
    """
    spark, rounds = texts.sparkSession, doubled_lengths(base, least)
    windows = texts.select("doc", F.lit(0).alias("first"), F.lit(False).alias("partner"), "data")
    # Equal texts are one here: which of them an open sample came from makes no difference.
    holders = texts.groupBy("doc").agg(F.first("data").alias("data"), F.lit(0).alias("parent"))
    settled: list[DataFrame] = []
    cut = F.transform(
        "parts",
        lambda p: F.struct(
            p["first"].alias("first"),
            p["partner"].alias("partner"),
            _bytes_at(F.col("data"), p["first"] - F.col("parent"), p["n"] + (least - 1)).alias("data"),
        ),
    )
    held: list[str] = []
    with shuffles_removed(spark):
        for length in rounds:
            done, left, folders = _reranked(_sampled(windows, length, least, chunk))
            settled.append(stored(done, "settled"))
            if length < least:
                parts = F.collect_list(F.struct("first", "n", "partner")).alias("parts")
                nearby = holders.join(left.groupBy("doc", "parent").agg(parts), ["doc", "parent"])
                windows, path = written(nearby.select("doc", F.explode(cut).alias("w")).select("doc", "w.*"), "windows")
                holders = windows.select("doc", "data", F.col("first").alias("parent"))
            # What a round has written goes when the next one's windows are there.
            discard(spark, folders + held)
            if length == least or windows.isEmpty():
                break
            held = [path]
    every = settled[0]
    for part in settled[1:]:
        every = every.unionByName(part)
    return every.groupBy("doc").agg(F.collect_set(F.struct("first", "n")).alias("windows"))


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when the job that wrote them has ended: all results of the rounds are written tables."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


def covered(windows: Iterable[tuple[int, int]], least: int) -> list[tuple[int, int]]:
    """Maximal runs ``(first, end)`` of the bytes in windows of ``least`` bytes that start in runs ``(first, n)``."""
    out: list[tuple[int, int]] = []
    for first, n in sorted(windows):
        end = first + n + least - 1
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


def remove_repeats(
    df: DataFrame, key: str, text: str, *, least: int = 200, base: int = 64, chunk: int = CHUNK
) -> DataFrame:
    """``(key, n_bytes, spans, kept)``: each text without the bytes that repeated strings cover.

    Texts count as UTF-8 bytes. A byte goes if a string of ``least`` bytes around
    it, within its text, starts anywhere else too, in the same text or another;
    all are judged on the texts as given. ``spans`` has the maximal runs removed,
    ``(first, end)``, ``kept`` the other bytes, joined; a run may cut a character.

    Prefix doubling, on sampled positions. Each window of ``least`` bytes chooses
    one of its strings of ``base`` bytes by content alone, which leaves about two in
    ``least - base`` positions. Their names are ranked together: a name that occurs once
    ends its windows, samples whose windows are all equal settle each other, and the
    rest go on with longer strings, each made of two of the round before, until
    the strings are the windows themselves. Only open samples' bytes are carried on.

    Names have 64 bits and only propose; what settles is name and block, 128 bits together.
    Equal texts are one table row where bytes are fetched, and sets of runs are merged in each
    task before they meet, so a text with a third of all copies moves once a task.

    NULL texts count as empty. Texts shorter than ``least`` stay whole. Repeated
    rows are different texts, so each loses what both have; NULL keys stay; long
    texts are named in overlapping pieces of ``chunk`` bytes, none of their windows is lost.
    An empty table gives an empty one. Other columns are left out.
    """
    if not 1 <= base <= least:
        raise ValueError("base must lie between 1 and least")
    data = text_or_empty(text).cast("binary")
    rows = df.select(named(key).alias("key"), data.alias("data"))
    rows = rows.withColumn("doc", F.substring(F.unhex(F.sha2("data", 256)), 1, 16))
    long = rows.filter(F.octet_length("data") >= least).select("doc", "data")
    found = repeated_windows(long, least, base, chunk)
    kind = rows.schema["key"].dataType.simpleString()

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("first", pa.int32()), ("end", pa.int32())])
        for batch in batches:
            sizes, spans, kept = [], [], []
            for data, windows in zip(batch.column(1), batch.column(2).to_pylist(), strict=True):
                data = data.as_py()
                gone = covered(((w["first"], w["n"]) for w in windows or ()), least)
                edges = [0, *(e for s in gone for e in s), len(data)]
                sizes.append(len(data))
                spans.append([{"first": f, "end": e} for f, e in gone])
                kept.append(b"".join(data[f:e] for f, e in zip(edges[::2], edges[1::2], strict=True)) if gone else data)
            columns = [
                batch.column(0),
                pa.array(sizes, pa.int64()),
                pa.array(spans, pa.list_(span)),
                pa.array(kept, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["key", "n_bytes", "spans", "kept"])

    fields = f"key {kind}, n_bytes bigint, spans array<struct<first:int,end:int>>, kept binary"
    return rows.join(found, "doc", "left").select("key", "data", "windows").mapInArrow(cut, fields)
