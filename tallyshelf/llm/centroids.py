"""Exact centroid clustering, centroids ruled out by bounds in rotated coordinates."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyshelf.functions.names import named
from tallyshelf.llm.common import stored

#: Whole components up to this size have squared distances over 64 dimensions within 62 bits.
NARROW = 1 << 27
#: Components of this size or more take no part: no squared distance to them fits a bigint.
WIDEST = float(1 << 62)
LARGEST = (1 << 63) - 1
#: Share of the squared lengths by which a bound in floating point is lowered; its error is far smaller.
SLACK = 1e-9


class Rotation(NamedTuple):
    """The principal axes of all vectors, strongest first, and their mean."""

    mean: np.ndarray
    axes: np.ndarray
    leading: int

    def near(self, vectors: np.ndarray) -> np.ndarray:
        """Leading rotated coordinates, then the length of what the other axes hold."""
        turned = (vectors.astype(np.float64) - self.mean) @ self.axes
        rest = np.sqrt((turned[:, self.leading :] ** 2).sum(axis=1, keepdims=True))
        return np.concatenate([turned[:, : self.leading], rest], axis=1)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def whole_distances(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Squared distances in integers; of any size if the vectors are Python integers."""
    apart = vectors - centroid
    return (apart * apart).sum(axis=1)


def assign(
    vectors: np.ndarray, near: np.ndarray, centroids: np.ndarray, centroids_near: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """``(cluster, distance, verified)``: the nearest centroid of each vector, ties to the smaller number.

    The squared distance is at least that of the leading coordinates plus the
    squared difference of the two residual norms. The centroid of least bound is
    measured in integers first; any other is measured only if its bound, lowered
    by the error of floating point, does not exceed the best distance so far.
    ``verified`` counts the distances taken.
    """
    if max(np.abs(vectors).max(initial=0), np.abs(centroids).max(initial=0)) >= NARROW:
        vectors, centroids = vectors.astype(object), centroids.astype(object)
    length, centroid_length = (near**2).sum(axis=1), (centroids_near**2).sum(axis=1)
    together = length[:, None] + centroid_length[None, :]
    # With the residual norm as one more coordinate, the bound is a squared distance itself.
    bounds = together - 2 * (near @ centroids_near.T) - SLACK * (together + 1)
    first = bounds.argmin(axis=1)
    cluster, distance = first.copy(), whole_distances(vectors, centroids[first])
    verified = len(vectors)
    for number in range(len(centroids)):
        rows = np.flatnonzero((first != number) & (bounds[:, number] <= distance.astype(np.float64)))
        if len(rows):
            measured = whole_distances(vectors[rows], centroids[number])
            better = (measured < distance[rows]) | ((measured == distance[rows]) & (number < cluster[rows]))
            cluster[rows[better]], distance[rows[better]] = number, measured[better]
            verified += len(rows)
    return cluster, distance, verified


def _usable(vector: Column, width: int, scale: float) -> Column:
    """Whole multiples of 1 / ``scale``; NULL unless there are ``width`` finite components."""
    scaled = F.transform(vector, lambda x: F.lit(scale) * x.cast("double"))
    fits = F.forall(scaled, lambda x: x.isNotNull() & (F.abs(x) < F.lit(WIDEST)))
    whole = F.transform(scaled, lambda x: F.floor(x).cast("bigint"))
    return F.when((F.size(vector) == width) & fits, whole)


def _rotation(vectors: DataFrame, width: int, leading: int) -> Rotation:
    """Principal axes from the sums and products of all vectors, added up per task."""
    size = 1 + width + width * width

    def moments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            x = matrix(batch.column(0), width).astype(np.float64)
            total += np.concatenate([[len(x)], x.sum(axis=0), (x.T @ x).ravel()])
        if total[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), pa.array(total)], ["at", "total"])

    sums = vectors.select("v").mapInArrow(moments, "at int, total double").groupBy("at").agg(F.sum("total"))
    total = np.zeros(size)
    for at, value in sums.collect():
        total[at] = value
    count = max(total[0], 1.0)
    mean = total[1 : 1 + width] / count
    spread = total[1 + width :].reshape(width, width) / count - np.outer(mean, mean)
    if not np.isfinite(spread).all():
        spread = np.eye(width)
    _, axes = np.linalg.eigh((spread + spread.T) / 2)
    return Rotation(mean, axes[:, ::-1].copy(), min(leading, width))


def _sums(rotated: DataFrame, centroids: np.ndarray, rotation: Rotation) -> dict[int, tuple[int, list[int]]]:
    """Per non-empty cluster the number of its vectors and their exact sums."""
    k, width = centroids.shape
    centroids_near = rotation.near(centroids)

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = [0] * k, np.zeros((k, width), dtype=object)
        for batch in batches:
            x = matrix(batch.column(0), width)
            cluster, _, _ = assign(x, matrix(batch.column(1), rotation.leading + 1), centroids, centroids_near)
            narrow = np.abs(x).max(initial=0) < NARROW
            for number in np.unique(cluster):
                own = x[cluster == number]
                counts[number] += len(own)
                sums[number] += (own if narrow else own.astype(object)).sum(axis=0)
        rows = [(c, -1, counts[c]) for c in range(k) if counts[c]]
        rows += [(c, at, int(v)) for c in range(k) if counts[c] for at, v in enumerate(sums[c])]
        if rows:
            cluster, at, total = zip(*rows, strict=True)
            exact = pa.array([Decimal(t) for t in total], pa.decimal128(38, 0))
            columns = [pa.array(cluster, pa.int32()), pa.array(at, pa.int32()), exact]
            yield pa.RecordBatch.from_arrays(columns, ["cluster", "at", "total"])

    parts = rotated.select("v", "near").mapInArrow(partial, "cluster int, at int, total decimal(38,0)")
    found: dict[int, list[int]] = {}
    for cluster, at, total in parts.groupBy("cluster", "at").agg(F.sum("total")).collect():
        found.setdefault(cluster, [0] * (width + 1))[at + 1] = int(total)
    return {c: (values[0], values[1:]) for c, values in found.items()}


def cluster_vectors(
    df: DataFrame,
    key: str,
    vector: str,
    *,
    k: int = 40,
    rounds: int = 5,
    width: int = 64,
    scale: float = 256.0,
    leading: int = 16,
    seed: str = "2:",
) -> tuple[DataFrame, DataFrame]:
    """Vectors by nearest centroid after ``rounds`` rounds, exact to the last digit.

    Returns ``(key, cluster, distance)``, one row per usable row of ``df``, and
    ``(cluster, centroid, n, cluster_inertia, inertia)``, one row per centroid.
    Components count as whole multiples of 1 / ``scale``. Centroids begin as the
    ``k`` vectors whose key has the smallest SHA-256 behind ``seed``; a round gives
    every vector to the nearest centroid and moves each non-empty centroid to its
    vectors' mean, rounded down per component.

    All vectors are turned onto their principal axes once, and written with their
    ``leading`` coordinates and the norm of the rest. A round is one pass: each
    task rules out centroids by these, measures the others in integers and gives
    sums per cluster; ``k`` rows of sums reach the driver, and nothing shuffles by
    cluster, so one that holds most vectors costs no more.

    Vectors that are NULL, have not exactly ``width`` components, or hold a NULL,
    non-finite or too large one (2^62 after scaling) take no part. NULL keys hash as an
    empty text. Keys may repeat: rows are clustered one by one, and rows alike are
    interchangeable. With fewer vectors than ``k`` each is a centroid. A distance or inertia beyond
    a bigint is given as the largest. An empty table gives empty tables. Other columns are left out.
    """
    whole = _usable(named(vector), width, float(scale))
    vectors = df.select(named(key).alias("key"), whole.alias("v")).filter("v IS NOT NULL")
    rotation = _rotation(vectors, width, leading)
    kind = vectors.schema["key"].dataType.simpleString()

    def rotate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = rotation.near(matrix(batch.column(1), width))
            lists = pa.ListArray.from_arrays(
                np.arange(len(near) + 1, dtype=np.int32) * near.shape[1], pa.array(near.ravel())
            )
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], ["key", "v", "near"])

    rotated = stored(
        vectors.mapInArrow(rotate, f"key {kind}, v array<bigint>, near array<double>"), "rotated"
    )
    hashed = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("key").cast("string"), F.lit(""))), 256)
    starts = rotated.select(hashed.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    centroids = np.array([row.v for row in starts], dtype=np.int64).reshape(-1, width)
    if len(centroids):
        for _ in range(rounds):
            for number, (n, sums) in _sums(rotated, centroids, rotation).items():
                centroids[number] = [total // n for total in sums]
    centroids_near = rotation.near(centroids)

    def last(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, near = matrix(batch.column(1), width), matrix(batch.column(2), rotation.leading + 1)
            cluster, distance, _ = assign(x, near, centroids, centroids_near)
            if distance.dtype == object:
                distance = np.array([min(d, LARGEST) for d in distance], dtype=np.int64)
            columns = [batch.column(0), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "cluster", "distance"])

    assigned = stored(rotated.mapInArrow(last, f"key {kind}, cluster int, distance bigint"), "assigned")
    distances = F.sum(F.col("distance").cast("decimal(38,0)"))
    counts: dict[int, int] = {}
    inertias: dict[int, int] = {}
    for cluster, n, total in assigned.groupBy("cluster").agg(F.count("*"), distances).collect():
        counts[cluster], inertias[cluster] = n, int(total)
    whole_inertia = min(sum(inertias.values()), LARGEST)
    rows = [
        (c, centroids[c].tolist(), counts.get(c, 0), min(inertias.get(c, 0), LARGEST), whole_inertia)
        for c in range(len(centroids))
    ]
    fields = "cluster int, centroid array<bigint>, n bigint, cluster_inertia bigint, inertia bigint"
    return assigned, df.sparkSession.createDataFrame(rows, fields)
