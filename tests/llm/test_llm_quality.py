import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyshelf.llm.quality import VECTOR, quality_verdicts, robust_shapes, text_statistics

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_capitals"]


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    count = Counter(windows)
    covered = {k + i for k, w in enumerate(windows) if count[w] > 1 for i in range(5)}
    capitals = len(re.findall("[A-Z]", text))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered), capitals)


def prose(rng, n):
    vocabulary = [f"w{'abcdefghij'[i % 10] * (1 + i % 7)}{i}" for i in range(400)]
    return " ".join(rng.choices(vocabulary, k=n))


TEXTS = [
    None,
    "",
    " \n\t ",
    "a",
    "a a a a a a a a",
    "one two three four five one two three four five",
    "x\ny\nx\n \n\nx \nx",
    "# * | <> tab\tand\x0bfeed\x0c 日本 🙂 x",
    "a b c d e f a b c d e g " * 3,
    "long " * 6000 + "tail",
]


def test_statistics_equal_brute_force(spark):
    rng = random.Random(1)
    texts = [*TEXTS, *(prose(rng, rng.randint(0, 80)) + "\n" + prose(rng, 3) for _ in range(60))]
    texts += [t + "\n" + t for t in texts[-20:]]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    out = {r.doc_id: tuple(r[n] for n in NAMES) for r in text_statistics(frame, "text").collect()}
    assert out == {i: brute(t) for i, t in enumerate(texts)}


def documents(rng, n=400):
    rows = []
    for i in range(n):
        text = prose(rng, rng.randint(30, 200))
        if i % 40 == 0:
            text = " | ".join(text.split()[:60])
        if i % 40 == 1:
            text = text.upper()
        rows.append((i, text, ["en", "de", None][i % 3], ["s0", "s0", "s1", None][i % 4]))
    return rows


SCHEMA = "doc_id bigint, text string, lang string, source string"


def test_outliers_are_rejected_and_clean_documents_kept(spark):
    rows = documents(random.Random(2))
    out = quality_verdicts(spark.createDataFrame(rows, SCHEMA), "text", "lang", "source").collect()
    assert len(out) == len(rows)
    for r in out:
        assert not r.base_failed
        assert r.kept == (r.doc_id % 40 > 1), (r.doc_id, r.distance)


def test_copies_do_not_make_the_rest_outliers(spark):
    """A group that is mostly one text has no spread; the floors keep its other documents."""
    rng = random.Random(3)
    same = prose(rng, 50)
    rows = [(i, same, "en", "s0") for i in range(300)] + [(1000 + i, prose(rng, 60), "en", "s0") for i in range(60)]
    assert quality_verdicts(spark.createDataFrame(rows, SCHEMA), "text", "lang", "source").filter("NOT kept").count() == 0


def test_base_rules(spark):
    rng = random.Random(4)
    rows = [(1, "too few words", "en", "a"), (2, None, None, None), (3, "a b c d e " * 10, "en", "a")]
    rows += [(4, prose(rng, 40), "en", "a")]
    out = {r.doc_id: r for r in quality_verdicts(spark.createDataFrame(rows, SCHEMA), "text", "lang", "source").collect()}
    assert {k: r.base_failed for k, r in out.items()} == {1: True, 2: True, 3: True, 4: False}
    assert {k: r.kept for k, r in out.items()} == {1: False, 2: False, 3: False, 4: True}


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert quality_verdicts(empty, "text", "lang", "source").count() == 0
    frame = spark.createDataFrame(
        [(1, "x", None, "s", 5, "k", 0.5)],
        "doc_id bigint, text string, lang string, source string, n_words int, kept string, c_0 double",
    )
    row = quality_verdicts(frame, "text", "lang", "source").first()
    assert (row.doc_id, row.n_words, row.kept, row.text) == (1, 1, False, "x")


def test_filters_on_the_verdict_do_not_change_it(spark):
    rows = documents(random.Random(5), 120)
    judged = quality_verdicts(spark.createDataFrame(rows, SCHEMA), "text", "lang", "source")
    kept = {r.doc_id for r in judged.filter("kept").select("doc_id").collect()}
    assert kept == {r.doc_id for r in judged.collect() if r.kept}


def test_shapes_are_those_of_the_inner_three_quarters(spark):
    """The estimate of a contaminated normal sample is close to the clean sample's."""
    rng = np.random.default_rng(6)
    mix = rng.normal(size=(5, 5)) * 0.4 + np.eye(5)
    clean = rng.normal(size=(3000, 5)) @ mix.T + 3
    rows = np.r_[clean, rng.normal(size=(400, 5)) + 40].tolist()
    frame = spark.createDataFrame([("g", *map(float, r)) for r in rows], ["group", *VECTOR])
    shape = robust_shapes(frame).filter(F.col("group") == "g").first()
    centre = [shape[f"c_{i}"] for i in range(5)]
    lower = np.array([[shape[f"l_{i}_{j}"] if j <= i else 0.0 for j in range(5)] for i in range(5)])
    assert centre == pytest.approx(clean.mean(axis=0), abs=0.15)
    # Three quarters of all rows are more than that of the clean ones: the spread comes out a little wide.
    ratio = np.linalg.det(lower @ lower.T) / np.linalg.det(np.cov(clean.T))
    assert 0.9 < ratio ** (1 / 10) < 1.1


def test_groups_of_different_spread_judge_the_same_text_differently(spark):
    """Where all lines have many symbols a text with two in 100 words is ordinary; where none has any it is not."""
    rng = random.Random(7)

    def marked(n, symbols):
        words = prose(rng, n).split()
        for at in rng.sample(range(n), symbols):
            words[at] = "#"
        return " ".join(words)

    rows = [(i, marked(400, 0), "en", "plain") for i in range(300)]
    rows += [(1000 + i, marked(400, rng.randint(0, 40)), "en", "wide") for i in range(300)]
    rows += [(2000, marked(400, 12), "en", "plain"), (2001, marked(400, 12), "en", "wide")]
    out = {r.doc_id: r for r in quality_verdicts(spark.createDataFrame(rows, SCHEMA), "text", "lang", "source").collect()}
    assert (out[2000].kept, out[2001].kept) == (False, True)
    assert all(r.kept for i, r in out.items() if i != 2000)


def test_small_groups_keep_their_own_centre(spark):
    """Unspaced words are far from the pool; the documents of a small language stay, as more of them come."""
    rng = random.Random(8)
    rows = [(i, prose(rng, rng.randint(60, 200)), "en", f"s{i % 2}") for i in range(400)]
    unspaced = [" ".join("".join(rng.choices("日本語文字", k=30)) for _ in range(30)) for _ in range(60)]
    for size in (5, 50):
        more = [(1000 + i, text, "ja", "s0") for i, text in enumerate(unspaced[:size])]
        out = quality_verdicts(spark.createDataFrame(rows + more, SCHEMA), "text", "lang", "source")
        assert out.filter("NOT kept").count() == 0, size
