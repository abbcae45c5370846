from collections import Counter

import pytest

from tallyshelf.llm.sharding import assign_arcs, ring, ring_place, shard_rows


def shards(spark, rows, n=5, schema="doc_id bigint, size bigint"):
    return shard_rows(spark.createDataFrame(rows, schema), "doc_id", n, vnodes=16).collect()


def check(out, n):
    counts = Counter(r.shard for r in out)
    assert set(counts) <= set(range(n))
    assert max(counts.values()) - min([counts.get(s, 0) for s in range(n)]) <= 1
    for s in counts:
        assert sorted(r.slot for r in out if r.shard == s) == list(range(counts[s]))


@pytest.mark.parametrize("size", [1, 4, 5, 23, 500])
def test_counts_differ_by_one_at_most(spark, size):
    out = shards(spark, [(i, i) for i in range(size)])
    assert len(out) == size
    check(out, 5)


def test_hot_and_null_keys_overflow_to_the_next_shards(spark):
    out = shards(spark, [(7, i) for i in range(200)] + [(None, 1)] * 200 + [(i, 0) for i in range(100)])
    assert len(out) == 500
    check(out, 5)


def test_the_result_does_not_depend_on_the_order_of_rows(spark):
    rows = [(i, i % 7) for i in range(300)]
    assert sorted(shards(spark, rows)) == sorted(shards(spark, rows[::-1]))


def test_empty_table_and_clashing_columns(spark):
    assert shards(spark, []) == []
    out = shards(spark, [(1, "x", 9), (2, None, 8)], 2, "doc_id bigint, shard string, slot int")
    assert sorted((r.shard, r.slot) for r in out) == [(0, 0), (1, 0)]


def test_most_keys_stay_with_their_home_shard(spark):
    """Bounded loads move only what overflows: compared by brute force with the bare ring."""
    nodes = ring(spark, 6, 64)
    counts = dict.fromkeys(range(len(nodes)), 100)
    moved = Counter()
    for arc, first, end, shard, _ in assign_arcs(nodes, counts, 6):
        moved[nodes[arc][1] == shard] += end - first
    homes = Counter()
    for arc, n in counts.items():
        homes[nodes[arc][1]] += n
    least = sum(max(0, n - 6400) for n in homes.values())
    assert moved[True] + moved[False] == 38400
    assert moved[False] == least


def test_a_further_shard_only_adds_nodes(spark):
    assert set(ring(spark, 5, 16)) < set(ring(spark, 6, 16))


def test_overflow_goes_clockwise():
    nodes = [(10, 0), (20, 1), (30, 2)]
    out = assign_arcs(nodes, {0: 6, 1: 0, 2: 0}, 3)
    assert out == [(0, 0, 2, 0, 0), (0, 2, 4, 1, 0), (0, 4, 6, 2, 0)]


def one_by_one(homes, nodes, shards):
    """Rows per arc and shard, each row placed on its own: home first, then clockwise to a shard with room.

    ``homes`` lists each row's arc. Shards that more rows call home have the larger capacities.
    """
    home = Counter(nodes[arc][1] for arc in homes)
    least, more = divmod(len(homes), shards)
    larger = sorted(range(shards), key=lambda s: (-home[s], s))[:more]
    room = {s: least + (s in larger) for s in range(shards)}
    out, left = Counter(), []
    for arc in sorted(homes):
        shard = nodes[arc][1]
        if room[shard]:
            room[shard] -= 1
            out[arc, shard] += 1
        else:
            left.append(arc)
    for arc in left:
        at = arc
        while not room[nodes[at][1]]:
            at = (at + 1) % len(nodes)
        room[nodes[at][1]] -= 1
        out[arc, nodes[at][1]] += 1
    return out


@pytest.mark.parametrize("size, shards_n", [(1, 3), (40, 7), (700, 5)])
def test_equal_to_placing_row_by_row(spark, size, shards_n):
    rows = [(i % 150 if i % 3 else 7, i) for i in range(size)]
    df = spark.createDataFrame(rows, "doc_id bigint, size bigint")
    nodes = ring(spark, shards_n, 16)
    places = {r.doc_id: r.place for r in df.select("doc_id", ring_place("doc_id").alias("place")).collect()}

    def arc(key):
        return next((i for i, (place, _) in enumerate(nodes) if places[key] <= place), 0)

    out = shard_rows(df, "doc_id", shards_n, vnodes=16).collect()
    assert Counter((arc(r.doc_id), r.shard) for r in out) == one_by_one([arc(k) for k, _ in rows], nodes, shards_n)
    assert sorted((r.doc_id, r.size) for r in out) == sorted(rows)
