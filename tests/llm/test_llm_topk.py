import numpy as np
import pytest

from tallyshelf.llm import topk
from tallyshelf.llm.topk import SortedLists, top_k

SCHEMA = "vec_id bigint, embedding array<float>"


def brute(rows, k=5, every=50):
    usable = [
        (i, n, np.floor(256 * np.array(v, np.float32).astype(float)).astype(int))
        for i, (n, v) in enumerate(rows)
        if n is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for i, n, q in usable:
        if n % every == 0:
            scored = sorted(
                (-int(sum(a * b for a, b in zip(q, v, strict=False))), m) for j, m, v in usable if j != i
            )
            out += [(n, r, m, -s) for r, (s, m) in enumerate(scored[:k], 1)]
    return sorted(out)


def found(spark, rows, **more):
    return sorted(map(tuple, top_k(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding", **more).collect()))


def vectors(rng, n, width=8):
    return [(i, (rng.normal(size=width) * 0.2).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("n", [1, 3, 60, 400])
def test_equal_to_brute_force(spark, n):
    rows = vectors(np.random.default_rng(n), n)
    assert found(spark, rows) == brute(rows)


def test_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 100)
    monkeypatch.setattr(topk, "QUERIES", 3)
    rows = vectors(np.random.default_rng(2), 500)
    assert found(spark, rows) == brute(rows)


def test_ties_copies_and_unusable_vectors(spark):
    rows = vectors(np.random.default_rng(3), 200, 4)
    rows += [(1000 + i, [0.5, -0.5, 0.25, 0.0]) for i in range(100)]
    rows += [(50, [0.0] * 4), (50, [0.5, -0.5, 0.25, 0.0]), (2000, None), (2050, [1.0, None, 0.0, 0.0])]
    rows += [(2100, [float("nan"), 0.0, 0.0, 0.0]), (2150, [float("inf"), 0.0, 0.0, 0.0]), (None, [1.0] * 4)]
    rows += [(2200, []), (2250, [0.5])]
    assert found(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert found(spark, []) == []


def exact_top(block, query, ids, k, own):
    scores = block @ query
    best = [i for i in np.lexsort((ids, -scores)) if i != own][:k]
    return best, scores[best].tolist()


def test_the_best_are_found_with_and_without_a_floor():
    rng = np.random.default_rng(5)
    block = np.floor(rng.normal(size=(2000, 16)) * 40).astype(np.int64)
    lists, ids = SortedLists(block), rng.permutation(2000)
    for own in [*range(20), *[-1] * 20]:
        query = np.floor(rng.normal(size=16) * 40).astype(np.int64)
        best, scores = exact_top(block, query, ids, 5, own)
        places, got, read = lists.top(query, ids, 5, own)
        assert places.tolist() == best and got.tolist() == scores
        # A floor that the fifth reaches loses nothing, and saves reading.
        again, got, less = lists.top(query, ids, 5, own, scores[-1])
        assert again.tolist() == best and got.tolist() == scores and less <= read
        high, got, least = lists.top(query, ids, 5, own, scores[0] + 1)
        assert not set(got) & set(range(scores[0] + 1, scores[0] + 10**6)) and least <= less


def test_skewed_vectors_need_few_entries():
    """Where few components are large the lists are read to a small depth only."""
    rng = np.random.default_rng(8)
    block = (np.exp(rng.normal(size=(4000, 24)) * 2.5)).astype(np.int64)
    lists, ids = SortedLists(block), np.arange(4000)
    read = 0
    for _ in range(20):
        query = np.exp(rng.normal(size=24) * 2).astype(np.int64)
        places, scores, entries = lists.top(query, ids, 5)
        assert (places.tolist(), scores.tolist()) == exact_top(block, query, ids, 5, -1)
        read += entries
    assert read < 0.35 * 20 * block.size


def test_bounds_hold_at_every_depth():
    rng = np.random.default_rng(6)
    block = rng.integers(-9, 9, (50, 4))
    lists, everyone = SortedLists(block), np.arange(50)
    for query in rng.integers(-9, 9, (10, 4)):
        reader, exact, width = topk.Reader(lists, query), block @ query, 100
        for depth in range(1, 51):
            reader.read(depth)
            lower, upper = reader.bounds(everyone)
            assert (lower <= exact).all() and (exact <= upper).all()
            assert (upper - lower).max() <= width or depth == 1
            width = (upper - lower).max()
        assert (lower == exact).all() and (upper == exact).all()
        assert reader.entries == 50 * np.count_nonzero(query)


def test_query_of_zeros_and_negative_weights():
    block = np.array([[1, -2], [3, 4], [0, 0], [-5, 6]] * 30)
    lists, ids = SortedLists(block), np.arange(120)
    for query in np.array([[0, 0], [-1, 0], [0, -3], [2, 2]]):
        places, _, _ = lists.top(query, ids, 3)
        assert (places == np.lexsort((ids, -(block @ query)))[:3]).all()


def test_other_columns_may_have_any_name(spark):
    rows = vectors(np.random.default_rng(9), 120)
    df = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], SCHEMA + ", v int, query int, block int, floor int")
    assert sorted(map(tuple, top_k(df, "vec_id", "embedding").collect())) == brute(rows)


def test_bounds_are_compared_only_where_some_can_fall(monkeypatch):
    """No upper bound is under that of a candidate in no list yet, so until it is under the floor none is made."""
    rng = np.random.default_rng(10)
    block = np.floor(rng.normal(size=(2000, 16)) * 40).astype(np.int64)
    lists, ids, compared, bounds = SortedLists(block), np.arange(2000), [], topk.Reader.bounds

    def noted(reader, candidates):
        lower, upper = bounds(reader, candidates)
        compared.append((reader.depth, upper.min()))
        return lower, upper

    monkeypatch.setattr(topk.Reader, "bounds", noted)
    for _ in range(20):
        query = np.floor(rng.normal(size=16) * 40).astype(np.int64)
        best, scores = exact_top(block, query, ids, 5, -1)
        places, got, _ = lists.top(query, ids, 5, -1, scores[-1])
        assert places.tolist() == best and got.tolist() == scores
        reader = topk.Reader(lists, query)
        assert all(reader._at(depth - 1).sum() < scores[-1] for depth, _ in compared if depth < 2000)
        assert all(least >= reader._at(depth - 1).sum() - reader.slack for depth, least in compared)
        compared.clear()
