import zlib
from functools import cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyshelf.llm.packing import WordTokens, pack_documents, shortest_pack_first

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def packed(spark, rows, schema="doc_id bigint, text string", **more):
    return pack_documents(spark.createDataFrame(rows, schema), "text", PATH, **more)


@cache
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def ids_of(text):
    found = tokenizer().encode(text or "", add_special_tokens=False).ids
    return np.array([*found, 2], "<u4")


def check(rows, out, most):
    """Every id of every text in exactly one piece, sequences gapless and in bounds."""
    texts = {key: ids_of(text) for key, text in rows}
    by_doc, by_sequence = {}, {}
    for r in out:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == texts.keys()
    for key, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            part = texts[key][at : at + r.length]
            assert (r.start, r.doc_tokens) == (at, len(texts[key]))
            assert r.ids_crc32 == zlib.crc32(part.tobytes())
            at += r.length
        assert at == len(texts[key])
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= most
    assert sorted(by_sequence) == list(range(len(by_sequence)))


def test_pieces_cover_all_texts(spark):
    rows = [(i, "the quick brown fox " * (i % 40)) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, "word " * 5000), (1003, "<|endoftext|> Ünïcode 日本 don't")]
    check(rows, packed(spark, rows, most=256).collect(), 256)


def test_repeated_rows_and_null_keys_have_places_of_their_own(spark):
    out = packed(spark, [(None, "a b")] * 5 + [(7, "a b")] * 3, most=8).collect()
    assert len(out) == 8
    assert len({(r.sequence_id, r.offset) for r in out}) == 8


def test_empty_table(spark):
    assert packed(spark, []).count() == 0


def test_other_columns_stay_and_clashing_ones_are_replaced(spark):
    df = spark.createDataFrame([(1, "a", "x", 5)], "doc_id bigint, text string, lang string, offset int")
    row = pack_documents(df, "text", PATH, with_ids=True).first()
    assert (row.lang, row.offset, row.ids) == ("x", 0, ids_of("a").tolist())


def test_hot_length_is_ranked_over_salts(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"))
    out = pack_documents(df, "text", PATH, most=16).collect()
    assert len({(r.sequence_id, r.offset) for r in out}) == 3000
    assert max(r.sequence_id for r in out) == 3000 // 5 - 1  # three ids each, five in a sequence


def test_patterns_hold_the_histogram():
    rng = np.random.default_rng(4)
    lengths = rng.integers(1, 100, 5000)
    histogram = dict(zip(*np.unique(lengths, return_counts=True), strict=True))
    patterns = shortest_pack_first({int(k): int(v) for k, v in histogram.items()}, 100)
    placed = dict.fromkeys(histogram, 0)
    for count, pattern in patterns:
        assert sum(length * copies for length, copies in pattern) <= 100
        for length, copies in pattern:
            placed[length] += count * copies
    assert placed == histogram
    assert sum(count for count, _ in patterns) <= 1.02 * lengths.sum() / 100


def test_patterns_of_few_lengths():
    assert shortest_pack_first({}, 10) == []
    assert sum(n for n, _ in shortest_pack_first({1: 25}, 10)) == 3
    # Longest first, into the emptiest pack: 6+3 and 6+3, not 6 and 6+3.
    assert shortest_pack_first({6: 2, 3: 2}, 10) == [(2, ((6, 1), (3, 1)))]


def test_words_are_encoded_as_in_context():
    import random

    rng = random.Random(3)
    tokens = WordTokens(PATH)
    alphabet = [chr(i) for i in range(0x20, 0x100)] + list("''stvemlrd<|>ΣσİÉ日本🙂\x0b\x1c\x85\n\t́")
    alphabet += ["<|endoftext|>", " ", " "]
    for _ in range(2000):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 30)))
        assert tokens(text) == ids_of(text)[:-1].tobytes()
