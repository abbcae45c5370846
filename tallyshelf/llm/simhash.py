"""Near-duplicate documents by SimHash fingerprints, found through Golay-code keys."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyshelf.functions.names import named
from tallyshelf.llm import golay
from tallyshelf.llm.common import stored, text_or_empty
from tallyshelf.llm.components import connected_components

SHINGLE_WORDS, MOST_BITS, SEED = 4, 4, 42
#: The 64 bits in three segments, low bits first.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Fingerprints compared at once; a key with more of them is compared block by block.
BLOCK = 8192
#: Hashes whose bits are counted at once.
CHUNK = 65536


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """SimHash of the word shingles of an UTF-8 text: bit i is set if it is in over half the hashes."""
    # bytes.lower and bytes.split know ASCII alone: A-Z, and space and 0x09 to 0x0D.
    found = text.lower().split()
    if not found:
        return 0
    if len(found) > words:
        columns = [found[i : len(found) - words + 1 + i] for i in range(words)]
        shingles = map(b" ".join, zip(*columns, strict=True))
    else:
        shingles = iter([b" ".join(found)])
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        rows = hashes[at : at + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, key: str, text: str, words: int = SHINGLE_WORDS) -> DataFrame:
    """``(key, fingerprint)``, the 64 bits as a signed bigint."""

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py().encode(), words) for t in batch.column(1)]
            bits = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), bits], ["key", "fingerprint"])

    kind = df.schema[key].dataType.simpleString()
    narrow = df.select(named(key).alias("key"), text_or_empty(text).alias("text"))
    return narrow.mapInArrow(hashed, f"key {kind}, fingerprint bigint")


def bucket_keys(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(row, key)``: keys that two fingerprints at 4 or fewer differing bits share.

    Four errors in three segments leave either a segment without error and a
    second one with two at most, or two errors at most in each segment (1+1+1 or
    1+1+2). So the keys are every segment's value with each Golay key of every
    other segment, and the Golay keys of all three segments together.
    """
    values = [(bits >> np.uint64(at)) & np.uint64((1 << n) - 1) for at, n in SEGMENTS]
    near, counts = zip(*(golay.keys(v, n) for v, (_, n) in zip(values, SEGMENTS, strict=True)), strict=True)
    rows, keys = [], []

    def add(kind, key, valid):
        row, column = np.nonzero(valid)
        rows.append(row)
        keys.append(np.uint64(kind) << np.uint64(56) | key[row, column])

    near = [n.astype(np.uint64) for n in near]
    for exact in range(3):
        for other in range(3):
            if other != exact:
                key = values[exact][:, None] << np.uint64(12) | near[other]
                add(1 + 3 * exact + other, key, counts[other])
    pair = near[0][:, :, None] << np.uint64(12) | near[1][:, None, :]
    all_three = pair[:, :, :, None] << np.uint64(12) | near[2][:, None, None, :]
    valid = counts[0][:, :, None, None] & counts[1][:, None, :, None] & counts[2][:, None, None, :]
    add(0, all_three.reshape(len(bits), -1), valid.reshape(len(bits), -1))
    return np.concatenate(rows), np.concatenate(keys)


def keyed(distinct: DataFrame) -> DataFrame:
    """``(bucket, fingerprint)`` rows of the distinct ``fingerprint`` values."""

    def emit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(bits), 2048):
                part = bits[at : at + 2048]
                row, key = bucket_keys(part)
                columns = [pa.array(key.view(np.int64)), pa.array(part[row].view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["bucket", "fingerprint"])

    return distinct.select("fingerprint").mapInArrow(emit, "bucket bigint, fingerprint bigint")


def forest(bits: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Edges that connect what links of ``most`` or fewer bits connect among ``bits``; a tree each."""
    edges = []
    left = np.unique(bits)
    while len(left):
        reached, left = left[:1], left[1:]
        while len(reached) and len(left):
            near, by = np.zeros(len(left), bool), np.zeros(len(left), np.uint64)
            for at in range(0, len(reached), 256):
                part = reached[at : at + 256]
                close = np.bitwise_count(part[:, None] ^ left[None, :]) <= most
                hit = close.any(axis=0) & ~near
                by[hit] = part[close[:, hit].argmax(axis=0)]
                near |= hit
            edges += zip(by[near].tolist(), left[near].tolist(), strict=True)
            reached, left = left[near], left[~near]
    return edges


def small_bucket_pairs(bucket: np.ndarray, bits: np.ndarray, most: int, reach: int):
    """Linked pairs among neighbours of one bucket in a sorted table, up to ``reach`` rows apart."""
    found = []
    for lag in range(1, reach):
        same = np.nonzero(bucket[lag:] == bucket[:-lag])[0]
        if not len(same):
            break
        a, b = bits[same], bits[same + lag]
        near = np.bitwise_count(a ^ b) <= most
        found.append(np.stack([a[near], b[near]], axis=1))
    return np.concatenate(found) if found else np.zeros((0, 2), np.uint64)


#: Buckets up to this size are compared pair by pair, larger ones through a forest.
SMALL = 8


def bucket_edges(buckets: DataFrame, most: int) -> DataFrame:
    """``(u, v, overflow)``: edges within the buckets, or the rows of buckets over ``BLOCK``.

    Each task reads its buckets sorted and holds at most ``BLOCK`` fingerprints of one.
    A row with ``overflow`` is a bucket (``u``) and a fingerprint (``v``) of it.
    """
    sorted_rows = buckets.repartition("bucket").sortWithinPartitions("bucket", "fingerprint")

    def compare(bucket: np.ndarray, bits: np.ndarray) -> np.ndarray:
        begins = np.nonzero(np.r_[True, bucket[1:] != bucket[:-1]])[0]
        sizes = np.diff(np.r_[begins, len(bucket)])
        size = np.repeat(sizes, sizes)
        few = (size > 1) & (size <= SMALL)
        found = [small_bucket_pairs(bucket[few], bits[few], most, SMALL)]
        for at, n in zip(begins[sizes > SMALL], sizes[sizes > SMALL], strict=True):
            edges = forest(bits[at : at + n], most)
            found.append(np.array(edges, np.uint64).reshape(-1, 2))
        return np.unique(np.concatenate(found), axis=0)

    def batch_of(pairs: np.ndarray, overflow: bool) -> pa.RecordBatch:
        columns = [pa.array(np.ascontiguousarray(pairs[:, i]).view(np.int64)) for i in (0, 1)]
        columns.append(pa.array(np.full(len(pairs), overflow)))
        return pa.RecordBatch.from_arrays(columns, ["u", "v", "overflow"])

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, bits = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        over = None
        for batch in batches:
            bucket = np.r_[bucket, batch.column(0).to_numpy()]
            bits = np.r_[bits, batch.column(1).to_numpy().view(np.uint64)]
            if over is not None:
                n = np.searchsorted(bucket, over, side="right")
                if n:
                    yield batch_of(np.stack([bucket[:n].view(np.uint64), bits[:n]], axis=1), True)
                bucket, bits = bucket[n:], bits[n:]
                if not len(bucket):
                    continue
                over = None
            last = np.searchsorted(bucket, bucket[-1], side="left") if len(bucket) else 0
            if len(bucket) - last > BLOCK:
                over = bucket[-1]
                rest = np.stack([bucket[last:].view(np.uint64), bits[last:]], axis=1)
                yield batch_of(rest, True)
                if last:
                    yield batch_of(compare(bucket[:last], bits[:last]), False)
                bucket, bits = bucket[:0], bits[:0]
            elif last >= BLOCK:
                yield batch_of(compare(bucket[:last], bits[:last]), False)
                bucket, bits = bucket[last:], bits[last:]
        if len(bucket):
            yield batch_of(compare(bucket, bits), False)

    return sorted_rows.mapInArrow(scan, "u bigint, v bigint, overflow boolean")


def overflow_edges(rows: DataFrame, most: int) -> DataFrame:
    """Edges of buckets over ``BLOCK``: each pair of blocks of a bucket is one group."""
    sizes = rows.groupBy("bucket").agg(F.ceil(F.count("*") * 2 / BLOCK).cast("int").alias("blocks"))
    dealt = rows.join(sizes, "bucket").withColumn(
        "own", F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = dealt.withColumn("other", other).select(
        "bucket", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "fingerprint"
    )

    def linked(key, frame):
        edges = forest(frame["fingerprint"].to_numpy().view(np.uint64), most)
        import pandas as pd

        return pd.DataFrame(np.array(edges, np.uint64).reshape(-1, 2).view(np.int64), columns=["u", "v"])

    return paired.groupBy("bucket", "a", "b").applyInPandas(linked, "u bigint, v bigint")


def fingerprint_links(distinct: DataFrame, most: int = MOST_BITS) -> DataFrame:
    """``(u, v)``: edges that connect fingerprints exactly as all links of ``most`` bits do."""
    if not 0 <= most <= MOST_BITS:
        raise ValueError(f"the keys find up to {MOST_BITS} differing bits")
    found = stored(bucket_edges(keyed(distinct), most), "bucket-edges")
    few = found.filter("NOT overflow").select("u", "v")
    rest = found.filter("overflow").select(F.col("u").alias("bucket"), F.col("v").alias("fingerprint"))
    return few.unionByName(overflow_edges(rest, most))


def near_duplicates(
    df: DataFrame, key: str, text: str, *, words: int = SHINGLE_WORDS, most: int = MOST_BITS
) -> DataFrame:
    """``(key, fingerprint, component)``: one row per row of ``df``.

    ``component`` is the smallest key that links of ``most`` or fewer differing
    bits reach, the row's own included. Equal fingerprints become one node, each
    with several Golay keys; fingerprints that share a key are compared, and every
    key adds at most a tree of verified links, so copies are never expanded into
    pairs and no link between different fingerprints is lost.

    A NULL text is an empty one; texts without words have fingerprint 0 and are
    linked like any other. NULL keys have a row; a component of NULL keys alone
    has NULL. Repeated keys and rows stay. Very long texts are hashed whole. An empty
    table gives an empty table. Other columns are left out.
    """
    hashed = stored(fingerprints(df, key, text, words), "fingerprints")
    distinct = hashed.groupBy("fingerprint").agg(F.min("key").alias("least"))
    distinct = stored(distinct, "distinct-fingerprints")
    groups = connected_components(fingerprint_links(distinct, most))
    placed = distinct.join(groups, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "least", F.coalesce("component", "fingerprint").alias("group")
    )
    # Both are written, so that the join deals out its sides itself and can split a large component.
    placed = stored(placed, "placed")
    smallest = stored(placed.groupBy("group").agg(F.min("least").alias("component")), "smallest")
    named_groups = placed.join(smallest, "group").select("fingerprint", "component")
    return hashed.join(named_groups, "fingerprint").select("key", "fingerprint", "component")
