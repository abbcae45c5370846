import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyshelf.llm import divergence
from tallyshelf.llm.divergence import Forest, pair_prices, smoothed, source_divergence, terms_of

SCHEMA = "lang string, source string, text string"
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows, least_docs, top):
    rows = [(a or "", b or "", Counter(TERM.findall(fold(t or "")))) for a, b, t in rows]
    out = []
    for lang in {r[0] for r in rows}:
        own = [(s, c) for a, s, c in rows if a == lang]
        docs, total = Counter(t for _, c in own for t in c), Counter()
        kept = sorted(t for t, n in docs.items() if n >= least_docs)
        groups = defaultdict(Counter)
        for source, c in own:
            groups[source].update({t: c[t] for t in kept if t in c})
            total.update({t: c[t] for t in kept if t in c})

        def shares(counts, kept=kept):
            whole = sum(counts.values()) + 2 * len(kept)
            return [1 + 10**9 * (counts[t] + 2) // whole for t in kept]

        q = shares(total)
        p = {s: shares(c) for s, c in groups.items()}
        for source in groups:
            pairs = [
                (-sum((a - b) ** 2 // (a + b) for a, b in zip(p[source], p[o], strict=True)), o.encode(), o)
                for o in groups
                if o != source
            ]
            terms = [
                (-((a - b) ** 2 // (a + b)), t.encode(), t)
                for t, a, b in zip(kept, p[source], q, strict=True)
                if groups[source][t] and a > b
            ]
            out += [(lang, source, "pair", n, -v, r) for r, (v, _, n) in enumerate(sorted(pairs), 1)]
            out += [(lang, source, "term", n, -v, r) for r, (v, _, n) in enumerate(sorted(terms)[:top], 1)]
    return sorted(out)


def found(spark, rows, least_docs=2, top=3, schema=SCHEMA, **more):
    df = spark.createDataFrame(rows, schema).repartition(3)
    audit = source_divergence(df, "lang", "source", "text", least_docs=least_docs, top=top, **more)
    return sorted(map(tuple, audit.collect()))


def corpus(seed, n=120):
    rng = np.random.default_rng(seed)
    words = ["Ab", "c", "Éa", "éa", "d7e", "x_y", "日本", "naïve", "Z", "q'r"] + [f"w{chr(97 + i)}" for i in range(20)]
    langs, sources = ["en", "de", None, ""], ["a", "b", "B", "é", None, "zz"]
    return [
        (
            langs[rng.integers(4)],
            sources[rng.integers(6)],
            " ".join(rng.choice(words, rng.integers(0, 30), p=np.arange(30, 0, -1) / 465)),
        )
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed, least_docs, top", [(1, 2, 3), (2, 10, 10), (3, 1, 1)])
def test_equal_to_brute_force(spark, seed, least_docs, top):
    rows = corpus(seed)
    assert found(spark, rows, least_docs, top) == brute(rows, least_docs, top)


def test_several_segments_and_blocks_of_sources(spark):
    rows = corpus(4, 200)
    assert found(spark, rows, segment=8, block=2) == brute(rows, 2, 3)


def test_groups_and_languages_without_terms(spark):
    rows = [("en", "a", "one two"), ("en", "b", "one two"), ("en", "c", None), ("en", "d", "12 34")]
    rows += [("xx", "a", ""), ("xx", "b", "only once"), ("yy", "a", "alone")]
    got = found(spark, rows)
    assert got == brute(rows, 2, 3)
    assert [r[4] for r in got if r[0] == "xx"] == [0, 0] and not [r for r in got if r[0] == "yy"]


def test_hot_source_ties_and_repeated_rows(spark):
    rows = [("en", "hot", "a a b c")] * 100 + [("en", s, "a b") for s in "mnop"] * 3
    assert found(spark, rows) == brute(rows, 2, 3)


def test_empty_table_and_clashing_names(spark):
    assert found(spark, []) == []
    rows = corpus(5, 40)
    schema = SCHEMA + ", n int, term int, sid int, id int, total int"
    assert found(spark, [(*r, 1, 2, 3, 4, 5) for r in rows], schema=schema) == brute(rows, 2, 3)


def test_counts_are_sent_on_in_parts(spark):
    rows = corpus(6, 40)
    assert found(spark, rows, held=5) == brute(rows, 2, 3)


def test_terms_of_a_long_text_in_pieces(monkeypatch):
    monkeypatch.setattr(divergence, "PIECE", 10)
    text = "Aé b7c  " * 50 + "x" * 40 + " y"
    assert [t.decode() for part in terms_of(text) for t in part] == TERM.findall(fold(text))


def test_prices_of_whole_trees(monkeypatch):
    monkeypatch.setattr(divergence, "PAIRS", 4)
    rng = np.random.default_rng(7)
    counts = rng.integers(0, 4, size=(6, 64)) * (rng.random((6, 64)) < 0.4)
    counts[3], counts[4], counts[:, 60:] = counts[2], 0, -1
    whole = counts[:, :60].sum(axis=1) + 120
    first, second = np.triu_indices(6, 1)
    got = pair_prices(counts, whole, first, second)
    share = [[1 + 10**9 * (int(c) + 2) // int(w) for c in row[:60]] for row, w in zip(counts, whole, strict=True)]
    want = [sum((p - q) ** 2 // (p + q) for p, q in zip(share[a], share[b], strict=True)) for a, b in zip(first, second, strict=True)]
    assert got.tolist() == want


def test_equal_subtrees_are_one_node():
    counts = np.tile(np.array([1, 2, 0, 0]), (3, 16))
    forest = Forest(counts)
    assert forest.sizes == [3, 2, 1, 1, 1, 1, 1] and len(set(forest.roots)) == 1
    pair, x, y, times = forest.walk(np.array([0]), np.array([1]))
    assert len(pair) == 3 and times.sum() == 64


def test_shares_of_counts_beyond_a_bigint_product():
    counts, whole = np.array([0, 7, 10**13]), np.array([3 * 10**13 + 1])
    assert smoothed(counts, whole).tolist() == [[1 + 10**9 * (int(c) + 2) // int(whole[0]) for c in counts]]
