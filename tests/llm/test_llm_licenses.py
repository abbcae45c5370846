import random
import re

import pytest

from tallyshelf.llm.license_texts import NOTICES, PHRASES
from tallyshelf.llm.licenses import LicenceScanner, SuffixAutomaton, scan_licenses, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_places(found):
    return sorted(
        (k, label)
        for phrase, label in PHRASES.items()
        for k in range(len(found))
        if found[k : k + len(phrase.split())] == phrase.split()
    )


def scan(spark, texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    return {r.key: r for r in scan_licenses(frame, "doc_id", "text").collect()}


TEXTS = [
    None,
    "",
    "CC-BY cc by CC\x00BY ccby",
    "GNU General Public\nLicense general public license, All Rights Reserved all rights reserved",
    "général public license 日本 all rights resérved 3 x",
    "word " * 30000 + "cc by",
]


def test_words_and_phrases_equal_brute_force(spark):
    rng = random.Random(1)
    pieces = ["cc", "by", "CC", "general", "Public", "license", "all", "rights", "reserved", "é", "-", "\n", " ", " "]
    texts = [*TEXTS, *("".join(rng.choices(pieces, k=rng.randint(0, 60))) for _ in range(200))]
    out = scan(spark, texts)
    for i, text in enumerate(texts):
        found = brute_words(text)
        assert out[i].n_words == len(found)
        assert [tuple(p) for p in out[i].base] == brute_places(found)


def test_automaton_gives_matching_statistics():
    rng = random.Random(2)
    for _ in range(30):
        sequences = [[rng.randint(1, 4) for _ in range(rng.randint(1, 25))] for _ in range(3)]
        items = [rng.randint(1, 5) for _ in range(60)]
        automaton = SuffixAutomaton(sequences)
        got = {(end, n) for end, n, _ in automaton.maximal_matches(items, 2)}

        def longest(end, items=items, sequences=sequences):
            for n in range(end, 0, -1):
                part = items[end - n : end]
                if any(part == s[k : k + n] for s in sequences for k in range(len(s) - n + 1)):
                    return n
            return 0

        best = [longest(end) for end in range(len(items) + 1)]
        want = {(e, best[e]) for e in range(1, len(items) + 1) if best[e] >= 2 and (e == len(items) or best[e + 1] <= best[e])}
        assert got == want
        for end, n, state in automaton.maximal_matches(items, 2):
            ends = {
                (k, at + n)
                for k, s in enumerate(sequences)
                for at in range(len(s) - n + 1)
                if s[at : at + n] == items[end - n : end]
            }
            assert set(automaton.ends[state]) == ends


@pytest.mark.parametrize("label", sorted(NOTICES))
def test_whole_notices_are_found(spark, label):
    out = scan(spark, ["some prose before.\n" + text + "\nand after" for text in NOTICES[label]])
    for row in out.values():
        assert label in {s.label for s in row.spans}
        span = next(s for s in row.spans if s.label == label)
        assert span.first == 3 and span.share == 1.0


def test_changed_and_cut_notices():
    scanner = LicenceScanner(NOTICES, PHRASES)
    mit = words(NOTICES["mit"][1].encode())
    changed = [b"zzz" if i % 20 == 10 else w for i, w in enumerate(mit)]
    assert {s[2] for s in scanner.spans(scanner.numbers(changed))} == {"mit"}
    assert scanner.spans(scanner.numbers(mit[: len(mit) // 2])) == []
    twice = [*mit, *[b"other"] * 50, *mit]
    assert len([s for s in scanner.spans(scanner.numbers(twice)) if s[2] == "mit"]) == 2


def test_prose_is_no_licence(spark):
    out = scan(spark, ["the of and to in a is that for it was with be by on not he " * 40])
    assert out[0].spans == [] and out[0].base == []


def test_empty_table_null_keys_and_repeats(spark):
    assert scan(spark, []) == {}
    frame = spark.createDataFrame([(None, "cc by")] * 2, "doc_id int, text string")
    assert [(r.key, r.n_words) for r in scan_licenses(frame, "doc_id", "text").collect()] == [(None, 2)] * 2


@pytest.mark.parametrize("label", sorted(NOTICES))
def test_siblings_are_told_apart(label):
    scanner = LicenceScanner(NOTICES, PHRASES)
    for text in NOTICES[label]:
        found = words(("some prose before " + text + " and after").encode())
        assert [s[2] for s in scanner.spans(scanner.numbers(found))] == [label], text


def test_unknown_words_where_siblings_differ_are_no_gap():
    scanner = LicenceScanner(NOTICES, PHRASES)
    for text in (NOTICES["gpl-3.0"][1].replace("GNU", "GNU Library"), NOTICES["cc-by-4.0"][1].replace("4.0", "Sampling 4.0")):
        assert scanner.spans(scanner.numbers(words(text.encode()))) == []


def test_notices_close_to_one_another_are_all_found():
    scanner = LicenceScanner(NOTICES, PHRASES)
    for label in ("mit", "bsd", "gpl-3.0"):
        one = words(NOTICES[label][-1].encode())
        found = scanner.spans(scanner.numbers([*one, *[b"other"] * 3, *one, *one]))
        n = len(one)
        assert found == [(k, k + n, label, 1.0) for k in (0, n + 3, 2 * n + 3)]


def test_empty_table_and_other_columns_of_any_name(spark):
    assert scan(spark, []) == {}
    schema = "doc_id int, text string, key int, base int, spans int, n_words int"
    frame = spark.createDataFrame([(i, t, 1, 2, 3, 4) for i, t in enumerate(TEXTS)], schema)
    assert {r.key: r for r in scan_licenses(frame, "doc_id", "text").collect()} == scan(spark, TEXTS)
