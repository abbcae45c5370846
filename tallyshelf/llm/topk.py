"""Exact top-k inner products by no-random-access aggregation of sorted lists."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyshelf.functions.names import named
from tallyshelf.llm.common import stored

#: Candidates and queries that meet in one group.
CANDIDATES, QUERIES = 2048, 2048
#: Shares of a block's lists after which bounds are compared.
DEPTHS = (1 / 64, 1 / 32, 1 / 16, 1 / 8, 1 / 4, 1 / 2, 5 / 8, 3 / 4, 7 / 8, 1.0)
#: So many candidates are left for their scores to be resolved, per row wanted.
RESOLVED = 10


class SortedLists:
    """One list per dimension of a block's candidates, by value, largest first, and once more from its other end.

    ``places`` says where in the first lists a candidate stands, and so what has been read of it.
    """

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        down = np.argsort(-vectors, axis=0, kind="stable")
        self.names = np.ascontiguousarray(np.concatenate([down, down[::-1]], axis=1).T)
        values = np.take_along_axis(vectors, down, axis=0).astype(np.float64)
        self.values = np.ascontiguousarray(np.concatenate([values, values[::-1]], axis=1).T)
        self.places = np.empty(vectors.shape, np.int32)
        np.put_along_axis(self.places, down, np.arange(len(vectors), dtype=np.int32)[:, None], axis=0)

    def top(self, query: np.ndarray, ids: np.ndarray, wanted: int, own: int = -1, floor: float = -np.inf):
        """``(places, scores, read)`` of the ``wanted`` best candidates, ties to the smaller id.

        The lists are read side by side, entry by entry, until no more candidates than a
        few per row wanted can qualify; their scores are then resolved. A candidate
        cannot qualify if its upper bound is under the ``wanted``-th best lower
        bound, or under ``floor``, a score that so many rows elsewhere reach. Equal
        bounds stay, for ties. ``own`` is the query's own place, -1 for none.
        ``read`` counts the entries read. No upper bound is under that of a candidate not
        seen at all: until that one falls under ``floor`` bounds are not compared.
        """
        reader = Reader(self, query)
        left = np.arange(len(self.vectors))
        left = left[left != own]
        for share in DEPTHS if len(left) > RESOLVED * wanted else ():
            depth = max(1, int(len(self.vectors) * share))
            if share < 1 and reader.unseen(depth) >= floor > -np.inf:
                continue
            reader.read(depth)
            lower, upper = reader.bounds(left)
            best = np.partition(lower, len(lower) - wanted)[len(lower) - wanted]
            left = left[upper >= max(best, floor) - reader.slack]
            if len(left) <= RESOLVED * wanted:
                break
        scores = self.vectors[left] @ query
        best = np.lexsort((ids[left], -scores))[:wanted]
        return left[best], scores[best], reader.entries


class Reader:
    """Sorted access to a block's lists for one query, and what it has seen of each candidate.

    A list is read from the query's best end: the top for a positive weight, the
    bottom for a negative one; lists of weight 0 are not read.
    """

    def __init__(self, lists: SortedLists, query: np.ndarray):
        self.lists = lists
        self.down, self.up = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        self.weights = query[np.r_[self.down, self.up]].astype(np.float64)
        #: The lists to read, each from the query's best end.
        self.rows = np.r_[self.down, self.up + lists.vectors.shape[1]]
        size = len(lists.vectors)
        self.known = np.zeros(size)
        self.depth = self.entries = 0
        ends = np.abs(np.stack([self._at(0), self._at(size - 1)])) if size else np.zeros((2, len(self.weights)))
        #: Far more than floating point can be off in a sum of all dimensions.
        self.slack = 1e-9 * ends.max(axis=0).sum()

    def _at(self, place: int) -> np.ndarray:
        """What the entry at ``place`` of each list, from the best end on, is worth."""
        return self.lists.values[self.rows, place] * self.weights

    def unseen(self, depth: int) -> float:
        """Upper bound, at ``depth`` entries of each list, of a candidate in none of them."""
        return self._at(depth - 1).sum()

    def read(self, depth: int) -> None:
        """Go on to ``depth`` entries of each list."""
        names = self.lists.names[self.rows, self.depth : depth]
        worth = self.lists.values[self.rows, self.depth : depth] * self.weights[:, None]
        self.known += np.bincount(names.ravel(), worth.ravel(), len(self.known))
        self.depth, self.entries = depth, self.entries + names.size

    def bounds(self, candidates: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the candidates' scores.

        An entry not yet read is worth no more than the last one read of its list and
        no less than the list's other end.
        """
        ends = np.stack([self._at(len(self.known) - 1), self._at(self.depth - 1)], axis=1)
        size, width = self.lists.vectors.shape
        first, last, worth = np.zeros(width, np.int32), np.full(width, size, np.int32), np.zeros((width, 2))
        first[self.down], last[self.up] = self.depth, size - self.depth
        worth[self.rows % width] = ends
        places = self.lists.places[candidates]
        rest = ((places >= first) & (places < last)) @ worth
        return self.known[candidates] + rest[:, 0], self.known[candidates] + rest[:, 1]


def quantised(df: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """``(_row, id, v)``: floor(scale * x) of each component; unusable vectors left out."""
    finite = F.forall(named(vector), lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    usable = F.when(finite, named(vector))
    whole = F.transform(usable, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("bigint"))
    rows = df.select(F.monotonically_increasing_id().alias("_row"), named(key).alias("id"), whole.alias("v"))
    return rows.filter("v IS NOT NULL AND id IS NOT NULL")


def top_k(
    df: DataFrame,
    key: str,
    vector: str,
    *,
    every: int = 50,
    k: int = 5,
    scale: float = 256.0,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best other rows of each query row, exactly.

    Queries are the rows whose key is divisible by ``every``, candidates all rows;
    scores are inner products of the components' whole multiples of 1 / ``scale``,
    ties go to the smaller key. Candidates and queries are dealt into blocks of
    bounded size, each pair of blocks is one group: it sorts its lists once and
    reads them for its queries, without random access, until outsiders cannot qualify.
    The first block of candidates is searched for all queries before the others,
    whose reading then ends where the scores it found cannot be reached. The
    groups' best rows are ranked per query.

    Vectors that are NULL or hold NULL or non-finite components, and rows with a
    NULL key, take no part. Shorter vectors count as filled up with zeros. Rows
    with equal keys are different candidates; a query is never its own. Scores must
    fit a bigint. An empty table gives an empty table. Other columns are left out.
    """
    vectors = stored(quantised(df, key, vector, scale), "vectors")
    is_query = F.pmod(F.col("id"), F.lit(every)) == 0
    size, asked, width = vectors.agg(
        F.count("*"), F.count_if(is_query), F.coalesce(F.max(F.size("v")), F.lit(0))
    ).first()
    blocks, asks = max(1, -(-size // CANDIDATES)), max(1, -(-asked // QUERIES))
    salt = F.xxhash64("_row")
    rows = vectors.select("_row", "id", "v")
    none = F.lit(None).cast("bigint")
    candidates = rows.select(
        "*",
        F.lit(False).alias("query"),
        none.alias("floor"),
        F.pmod(salt, F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(asks - 1))).alias("ask"),
    )
    queries = rows.filter(is_query).select(
        "*", F.lit(True).alias("query"), F.pmod(salt, F.lit(asks)).cast("int").alias("ask")
    )

    def search(group: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_row", "query_id", "vec_id", "score"]
        asked, held = group[group["query"]], group[~group["query"]].sort_values("_row")
        if asked.empty or held.empty:
            return pd.DataFrame(columns=columns).astype("int64")

        def matrix(frame):
            out = np.zeros((len(frame), max(width, 1)), np.int64)
            for i, v in enumerate(frame["v"]):
                out[i, : len(v)] = v
            return out

        lists, ids, places = SortedLists(matrix(held)), held["id"].to_numpy(), held["_row"].to_numpy()
        numbers, names, wanted = asked["_row"].to_numpy(), asked["id"].to_numpy(), matrix(asked)
        floors = asked["floor"].astype("float64").fillna(-np.inf).to_numpy()
        at = np.minimum(np.searchsorted(places, numbers), len(places) - 1)
        own = np.where(places[at] == numbers, at, -1)
        parts = []
        for number, name, query, mine, floor in zip(numbers, names, wanted, own, floors, strict=True):
            place, scores, _ = lists.top(query, ids, k, mine, floor)
            parts.append(np.stack([np.full(len(place), number), np.full(len(place), name), ids[place], scores]))
        return pd.DataFrame(np.concatenate(parts, axis=1).T, columns=columns)

    def searched(asking: DataFrame, held: DataFrame) -> DataFrame:
        together = held.unionByName(asking.select(*held.columns))
        return together.groupBy("block", "ask").applyInPandas(
            search, "query_row bigint, query_id bigint, vec_id bigint, score bigint"
        )

    head = queries.withColumns({"floor": none, "block": F.lit(0)})
    found = searched(head, candidates.filter("block = 0"))
    if blocks > 1:
        found = stored(found, "first-found")
        reached = found.groupBy("query_row").agg(F.min("score").alias("floor"), F.count("*").alias("n"))
        floors = reached.filter(F.col("n") >= k).select(F.col("query_row").alias("_row"), "floor")
        others = F.explode(F.sequence(F.lit(1), F.lit(blocks - 1))).alias("block")
        tail = queries.join(floors, "_row", "left").select(*queries.columns, "floor", others)
        found = found.unionByName(searched(tail, candidates.filter("block > 0")))
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
