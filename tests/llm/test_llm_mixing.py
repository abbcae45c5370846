from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallyshelf.llm.mixing import mix_sources

SCHEMA = "doc_id bigint, source string, size bigint"


def mixed(spark, rows, **more):
    documents, blocks = mix_sources(spark.createDataFrame(rows, SCHEMA), "doc_id", "source", "size", **more)
    return documents.collect(), blocks


def brute_targets(sizes, weights=(5.0, 2.0, 1.0), most=3.0):
    """Water filling in rounds, as it is told."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    targets, left, free = {}, float(sum(sizes.values())), set(names)
    while free:
        share = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s for s in free if share[s] >= most * sizes[s]}
        if not over:
            return targets | share
        for s in over:
            targets[s] = most * sizes[s]
        left -= sum(targets[s] for s in over)
        free -= over
    return targets


@pytest.mark.parametrize("sizes", [[100, 100, 100], [1, 900, 900], [1, 2, 3, 4000], [0, 50, 5], [10]])
def test_targets_and_taken_words(spark, sizes):
    rows = [(100 * s + i, f"s{s}", 1) for s, n in enumerate(sizes) for i in range(n)]
    rows += [(100000 + s, f"s{s}", 0) for s in range(len(sizes))]
    rows += [(9, None, 7), (10, None, None)]
    out, _ = mixed(spark, rows, slots=64)
    expected = brute_targets({f"s{s}": n for s, n in enumerate(sizes)} | {None: 7})
    taken = defaultdict(int)
    assert len(out) == len(rows)
    for r in out:
        assert r.target == pytest.approx(expected[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - expected[s]) <= 0.5 for s in expected)


def test_blocks_are_spread_evenly(spark):
    """After any number of slots no source is far from its share."""
    rows = [(i, f"s{i % 3}", 10) for i in range(3000)]
    _, blocks = mixed(spark, rows, slots=600)
    order = [r.source_id for r in blocks.groupBy("source_id", "slot", "position").count().orderBy("position").collect()]
    shares = {1: 5 / 8, 2: 2 / 8, 3: 1 / 8}
    for n in range(1, len(order) + 1):
        assert all(abs(order[:n].count(s) - n * share) < 4 for s, share in shares.items())


def test_blocks_cover_the_stream_once_an_epoch(spark):
    _, blocks = mixed(spark, [(i, f"s{i % 2}", 3 + i % 5) for i in range(200)], slots=50)
    for key in blocks.select("source_id", "epoch").distinct().collect():
        rows = blocks.filter((F.col("source_id") == key[0]) & (F.col("epoch") == key[1]))
        at = 0
        for r in rows.orderBy("first").collect():
            assert r["first"] == at
            at = r["end"]


def test_reruns_and_row_order_agree(spark):
    rows = [(i % 40, f"s{i % 3}", 1 + i % 9) for i in range(300)]
    first, _ = mixed(spark, rows)
    second, _ = mixed(spark, rows[::-1])
    assert sorted(first) == sorted(second)


def test_empty_and_wordless_tables(spark):
    assert mixed(spark, [])[0] == []
    out, _ = mixed(spark, [(1, "a", 0), (None, None, None)])
    assert [(r.taken, r.target) for r in out] == [(0, 0.0), (0, 0.0)]


def prefix_gap(rows, shares):
    """How far, in tokens, the first part of the mix by ``positions`` is from the shares, at worst."""
    order = sorted((p, r.source, r.size) for r in rows for p in r.positions)
    got, done, worst = defaultdict(int), 0, 0.0
    for _, source, size in order:
        got[source] += size
        done += size
        worst = max(worst, *(abs(got[s] - share * done) for s, share in shares.items()))
    return worst


def test_any_first_part_of_the_mix_is_close_to_the_weights(spark):
    rows = [(i, f"s{i % 3}", 10) for i in range(3000)]
    out, _ = mixed(spark, rows, slots=600)
    shares = {"s0": 5 / 8, "s1": 2 / 8, "s2": 1 / 8}
    # Four slots of 50 tokens, and what a document reaches over its last slot.
    assert prefix_gap(out, shares) <= 5 * 50
    plain = [r.asDict() | {"positions": [r.key]} for r in out]
    assert prefix_gap([type(out[0])(**r) for r in plain], shares) > 5 * 50


def test_positions_follow_the_blocks(spark):
    rows = [(i, f"s{i % 4}", 1 + i % 9) for i in range(400)] + [(900, "s0", 0), (901, None, 3)]
    out, blocks = mixed(spark, rows, slots=40)
    taken = [r for r in out if r.taken]
    assert all(r.positions == sorted(r.positions) and len(r.positions) == -(-r.taken // r.size) for r in taken)
    assert all(r.positions == [] for r in out if not r.taken)
    assert {p for r in out for p in r.positions} <= {r.position for r in blocks.collect()}
    where = blocks.groupBy("position").agg(F.count_distinct("source_id").alias("n"))
    assert where.filter("n > 1").count() == 0


def test_other_columns_may_have_any_name(spark):
    schema = SCHEMA + ", key int, slot int, begin int, target int, position int"
    rows = [(i, f"s{i % 3}", 4, 1, 2, 3, 4, 5) for i in range(50)]
    documents, _ = mix_sources(spark.createDataFrame(rows, schema), "doc_id", "source", "size")
    plain, _ = mixed(spark, [r[:3] for r in rows])
    assert sorted(documents.collect()) == sorted(plain)
