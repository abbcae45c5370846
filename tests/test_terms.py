import math
import random
import re
from collections import Counter

import pytest

from registered.queries import QUERIES
from tallyshelf.operators.terms import best_threshold, term_counts, term_log_odds, term_vectors, term_weights, text_scores, top_terms

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
TEXTS = {1: "Red red blue É é 1x", 2: "blue, BLUE-green", 3: "blue", 4: None, 5: "", 6: "12 ..", 7: "red blue Green green"}


def frame(spark, texts=TEXTS):
    return spark.createDataFrame(list(texts.items()), "id int, text string").repartition(3)


def counted(texts=TEXTS):
    fold = {k: "".join(c.lower() if c.isascii() else c for c in t or "") for k, t in texts.items()}
    return {k: Counter(TERM.findall(t)) for k, t in fold.items() if TERM.findall(t)}


def test_counts(spark):
    got = {(r.key, r.term): r.n for r in term_counts(frame(spark), "id", "text").collect()}
    assert got == {(k, t): n for k, c in counted().items() for t, n in c.items()}
    assert ("x" in counted()[1], (1, "É") in got, (1, "é") in got) == (True, True, True)


def test_rows_of_one_key_are_one_text(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "b"), (None, "a")], "id int, text string")
    assert sorted(map(tuple, term_counts(df, "id", "text").collect()), key=repr) == [(1, "a", 1), (1, "b", 2), (None, "a", 1)]


def brute_weights(least=1):
    docs = Counter(t for c in counted().values() for t in c)
    size = len(counted())
    return {(k, t): (n, docs[t], n * math.log(size / docs[t])) for k, c in counted().items() for t, n in c.items() if docs[t] >= least}


@pytest.mark.parametrize("least", [1, 2])
def test_weights(spark, least):
    got = {(r.key, r.term): (r.n, r.docs, r.weight) for r in term_weights(term_counts(frame(spark), "id", "text"), least_docs=least).collect()}
    want = brute_weights(least)
    assert set(got) == set(want) and all(got[p] == pytest.approx(want[p]) for p in want)
    assert got[3, "blue"][2] == 0.0


def test_top_terms_and_vectors(spark):
    weights = term_weights(term_counts(frame(spark), "id", "text"))
    top = {(r.key, r.rank): r.term for r in top_terms(weights, 2).collect()}
    # Three terms are in one text once: ties go by name.
    assert (top[1, 1], top[1, 2], top[7, 1], top[3, 1]) == ("red", "x", "green", "blue")
    for r in term_vectors(weights).collect():
        want = sorted((t, w) for (k, t), (_, _, w) in brute_weights().items() if k == r.key)
        norm = math.sqrt(sum(w * w for _, w in want))
        assert r.norm == pytest.approx(norm)
        assert [(t.term, t.weight) for t in r.terms] == [(t, pytest.approx(w / norm if norm else 0.0)) for t, w in want]


def test_empty_table(spark):
    counts = term_counts(frame(spark, {1: None}), "id", "text")
    assert term_weights(counts).count() == 0 == term_vectors(term_weights(counts)).count()
    labels = spark.createDataFrame([], "key int, label int")
    assert text_scores(counts, term_log_odds(counts, labels)).count() == 0
    assert [tuple(r) for r in best_threshold(text_scores(counts, term_log_odds(counts, labels)), labels).collect()] == [(None, None)]


def test_log_odds_and_scores(spark):
    counts = term_counts(frame(spark), "id", "text")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (7, None), (99, 1)], "key int, label int")
    yes, no = counted()[1] + counted()[3], counted()[2]
    vocabulary = set(yes) | set(no)
    want = {
        t: math.log((yes[t] + 1) / (sum(yes.values()) + len(vocabulary)) / ((no[t] + 1) / (sum(no.values()) + len(vocabulary))))
        for t in vocabulary
    }
    odds = term_log_odds(counts, labels)
    assert {r.term: r.log_odds for r in odds.collect()} == {t: pytest.approx(v) for t, v in want.items()}
    got = {r.key: r for r in text_scores(counts, odds).collect()}
    for k, c in counted().items():
        known = sum(n for t, n in c.items() if t in want)
        assert (got[k].n_terms, got[k].n_known) == (sum(c.values()), known)
        assert got[k].score == pytest.approx(sum(n * want[t] for t, n in c.items() if t in want) / known)


def test_threshold(spark):
    draw = random.Random(4)
    rows = [(i, draw.gauss(1 if i % 3 else -1, 0.8), int(i % 3 > 0)) for i in range(300)]
    scores = spark.createDataFrame([r[:2] for r in rows], "key int, score double")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "key int, label int")
    (row,) = best_threshold(scores, labels).collect()

    def accuracy(cut):
        sides = [[(s >= cut) == bool(label) for _, s, label in rows if label == side] for side in (0, 1)]
        return sum(sum(x) / len(x) for x in sides) / 2

    low, high = min(r[1] for r in rows), max(r[1] for r in rows)
    assert row.accuracy == pytest.approx(accuracy(row.threshold), abs=0.01)
    assert row.accuracy >= max(accuracy(low + (high - low) * i / 1000) for i in range(1000)) - 0.01


def test_learned_labels_hold_on_texts_not_learned_from(spark):
    draw = random.Random(5)
    good, bad, both = ["sun", "clear", "warm"], ["mud", "cold", "grey"], [f"w{c}" for c in "abcdefghij"]
    texts, labels = {}, {}
    for i in range(400):
        labels[i] = i % 2
        texts[i] = " ".join(draw.choices(both, k=20) + draw.choices(good if i % 2 else bad, k=3) + draw.choices(good + bad, k=2))
    counts = term_counts(frame(spark, texts), "id", "text")
    known = spark.createDataFrame(list(labels.items()), "key int, label int")
    scores = text_scores(counts, term_log_odds(counts, known.filter("key >= 200"))).filter("key < 100")
    assert best_threshold(scores, known).first().accuracy > 0.9


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_texts_not_terms_are_dealt_by_key(spark):
    df = spark.createDataFrame(list(TEXTS.items()), "id int, text string")
    text = plan(term_counts(df, "id", "text"))
    assert text.count("Exchange") == 1 and not re.search(r"hashpartitioning\(key#\d+L?, term", text)


@pytest.mark.parametrize("name", ["top_terms", "document_scores"])
def test_terms_are_counted_once(spark, tmp_path, name):
    spark.createDataFrame(list(TEXTS.items()), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, i % 2, 0) for i in TEXTS]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    df = QUERIES[name](spark, str(tmp_path))
    assert "regexp_extract_all" not in plan(df)
    if name == "document_scores":
        assert {r.doc_id: r.n_terms for r in df.collect()} == {k: sum(c.values()) for k, c in counted().items()}
    else:
        assert {(r.doc_id, r.term, r.n) for r in df.collect()} == {(3, "blue", 1), (2, "blue", 2), (2, "green", 1), (1, "red", 2), (1, "blue", 1), *[(7, t, counted()[7][t]) for t in ("red", "blue", "green")]}
