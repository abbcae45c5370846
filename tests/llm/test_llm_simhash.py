import random

import numpy as np
import pytest
import xxhash

from tallyshelf.llm import golay, simhash
from tallyshelf.llm.components import connected_components
from tallyshelf.llm.simhash import bucket_keys, fingerprint, fingerprint_links, near_duplicates


def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text).translate(
        str.maketrans("\t\n\x0b\x0c\r", "     ")
    )
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(bits, keys):
    least = list(keys)
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(bits):
            near = [least[j] for j, b in enumerate(bits) if (a ^ b).bit_count() <= 4]
            smallest = min((k for k in near if k is not None), default=None)
            if smallest != least[i]:
                least[i], changed = smallest, True
    return least


def signed(bits):
    return [b - (1 << 64) if b >> 63 else b for b in bits]


def planted(rng, n=120):
    """Random fingerprints, with chains and clusters of up to four flipped bits."""
    bits = [rng.getrandbits(64) for _ in range(n)]
    for _ in range(2 * n):
        one = rng.choice(bits)
        for b in rng.sample(range(64), rng.randint(1, 6)):
            one ^= 1 << b
        bits.append(one)
    return sorted(set(bits))


def test_every_word_is_within_three_bits_of_its_codeword():
    words = np.random.default_rng(1).integers(0, 1 << 23, 5000, dtype=np.uint32)
    errors = golay.errors()[golay.syndrome(words)]
    assert np.bitwise_count(errors).max() <= 3
    assert not golay.syndrome(words ^ errors).any()
    assert len(np.unique(golay.codeword_indices())) == 4096


@pytest.mark.parametrize("bits", [21, 22, 23])
def test_words_two_bits_apart_share_a_key(bits):
    rng = random.Random(bits)
    for _ in range(500):
        a = rng.getrandbits(bits)
        b = a
        for k in rng.sample(range(bits), rng.randint(0, 2)):
            b ^= 1 << k
        found, counts = golay.keys(np.array([a, b]), bits)
        assert set(found[0][counts[0]]) & set(found[1][counts[1]])


def test_fingerprints_four_bits_apart_share_a_bucket():
    rng = random.Random(5)
    for _ in range(400):
        a = rng.getrandbits(64)
        b = a
        for k in rng.sample(range(64), 4):
            b ^= 1 << k
        row, key = bucket_keys(np.array([a, b], np.uint64))
        assert set(key[row == 0].tolist()) & set(key[row == 1].tolist())


@pytest.mark.parametrize(
    "text", ["", "  \n", "One", "one two THREE", "a b c d", "Ünï a b c\x0bd e f g", "x " * 9000 + "y"]
)
def test_fingerprint_of_odd_texts(text):
    assert fingerprint(text.encode()) == brute_fingerprint(text)


def test_links_connect_as_all_pairs_do(spark, monkeypatch):
    bits = planted(random.Random(2))
    frame = spark.createDataFrame([(b,) for b in signed(bits)], "fingerprint bigint")
    edges = fingerprint_links(frame).collect()
    for u, v in edges:
        assert ((u ^ v) & (1 << 64) - 1).bit_count() <= 4
    found = {r.node: r.component for r in connected_components(fingerprint_links(frame)).collect()}
    expected = brute_components(bits, range(len(bits)))
    ours = [found.get(b, b) for b in signed(bits)]
    assert len(set(ours)) == len(set(expected)) == len(set(zip(ours, expected, strict=True)))


def test_large_buckets_are_compared_in_blocks(spark, monkeypatch):
    """A bucket beyond the block size goes the other way and loses no link."""
    rng = random.Random(8)
    middle = rng.getrandbits(64)
    bits = sorted({middle ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(64)})
    rows = [(1, b) for b in signed(bits)]
    frame = spark.createDataFrame(rows, "bucket bigint, fingerprint bigint")
    # The setting goes to the workers with the function.
    edges = simhash.overflow_edges(frame, 4).collect()
    groups = {r.component for r in connected_components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert len(groups) == 1
    assert {x for e in edges for x in e} == set(signed(bits))


def test_bucket_scan_over_batches(spark):
    """Buckets that cross Arrow batches, and one that overflows."""
    rng = random.Random(9)
    few = [(k, signed([rng.getrandbits(64)])[0]) for k in range(400) for _ in range(k % 5)]
    base = rng.getrandbits(63)
    many = [(1000, base ^ i) for i in range(simhash.BLOCK + 10)]
    frame = spark.createDataFrame(few + many, "bucket bigint, fingerprint bigint")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
    try:
        out = simhash.bucket_edges(frame, 4).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    over = [(r.u, r.v) for r in out if r.overflow]
    assert sorted(over) == sorted(many)


def test_documents_with_copies_nulls_and_ties(spark):
    rng = random.Random(4)
    words = ["lorem", "ipsum", "dolor", "sit", "amet", "elit", "Sed", "do"]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(60)]
    texts += texts[:20] + [t + " tail" for t in texts[:20]] + [None, "", "  ", "one"]
    keys = [*range(100, 100 + len(texts) - 3), 7, 7, None]
    frame = spark.createDataFrame(list(zip(keys, texts, strict=True)), "doc_id bigint, text string")
    out = near_duplicates(frame, "doc_id", "text").collect()
    bits = [brute_fingerprint(t or "") for t in texts]
    expected = sorted(
        zip(keys, signed(bits), brute_components(bits, keys), strict=True), key=str
    )
    assert sorted(map(tuple, out), key=str) == expected


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id bigint, text string")
    assert near_duplicates(frame, "doc_id", "text").count() == 0


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    frame = spark.createDataFrame([*chain, *star, (5000, 5000), *chain[:5]], "u bigint, v bigint")
    out = {r.node: r.component for r in connected_components(frame).collect()}
    assert len({out[i] for i in range(201)}) == 1
    assert len({out[1000 + i] for i in range(300)}) == 1
    assert out[0] != out[1000] and 5000 not in out


def test_one_large_component(spark):
    """Hundreds of texts that differ in a word are one component, copies and far texts beside it."""
    rng = random.Random(12)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(400)]
    rows = []
    for i in range(300):
        near = list(words)
        near[rng.randrange(400)] = f"x{i}"
        rows.append((i, " ".join(near)))
    rows += [(1000 + i, rows[0][1]) for i in range(50)]
    rows += [(2000 + i, " ".join(rng.choices("klmnop", k=60))) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {r.key: r.component for r in near_duplicates(df, "doc_id", "text").collect()}
    want = dict(zip([k for k, _ in rows], brute_components([brute_fingerprint(t) for _, t in rows], [k for k, _ in rows]), strict=True))
    assert got == want and sum(c == 0 for c in got.values()) > 250


def test_other_columns_may_have_any_name(spark):
    rows = [(i, f"some words of text number {i % 3} and a few more of them") for i in range(12)]
    schema = "doc_id bigint, text string, key int, fingerprint int, component int, node int, least int"
    plain = near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), "doc_id", "text")
    other = near_duplicates(spark.createDataFrame([(*r, 1, 2, 3, 4, 5) for r in rows], schema), "doc_id", "text")
    assert sorted(other.collect()) == sorted(plain.collect())
