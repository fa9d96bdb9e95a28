"""Centroid clustering of whole-number vectors, with centroids filtered by n-simplex projection.

The distances of a vector to a few pivots are measured once and kept as the coordinates of the apex of a simplex over
the pivots: the place of the vector's foot in the pivots' span and its height above it. Between two apexes the
Euclidean distance is a lower bound of the true one, and with the second height turned down an upper bound, so a
centroid whose lower bound exceeds another one's upper bound is never compared. What is left is compared in whole
numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsfold.llm.scratch import Scratch

DIMENSION = 64
SCALE = 64
CENTROIDS = 16
ROUNDS = 3
#: Most pivots, and how many vectors they are picked from; fewer if these span less. One pivot more than dimensions
#: leaves no height, so that bounds are tight whatever the data; with fewer, coordinates are shorter and bounds wider.
PIVOTS, CANDIDATES = DIMENSION + 1, 512
#: Most that rounding may grow by on the way from distances to coordinates (condition of the pivots' simplex).
CONDITION = 1e5
#: Whole numbers beyond +-LARGEST count as +-LARGEST, so that a squared distance fits a long.
LARGEST = 2**27
#: Relative slack of the bounds, far above the rounding of coordinates, which are kept as 32-bit floats.
SLACK = 1e-5
#: Vectors of one step within a task.
BLOCK = 8192


@dataclass(frozen=True)
class Simplex:
    """Pivots, and an orthonormal basis of their span from the first one."""

    pivots: np.ndarray
    basis: np.ndarray

    @classmethod
    def over(cls, candidates: np.ndarray, most: int = PIVOTS) -> Simplex:
        """Pivots picked one by one, each the candidate highest above the span so far."""
        points = candidates.astype(np.float64)
        simplex, rest = cls(points[:1], np.zeros((0, points.shape[1]))), points - points[0]
        while len(simplex.pivots) < most:
            heights = np.sqrt((rest**2).sum(axis=1))
            far = int(heights.argmax())
            if not heights[far]:
                break
            axis = rest[far] / heights[far]
            rest = rest - np.outer(rest @ axis, axis)
            wider = cls(np.vstack([simplex.pivots, points[far]]), np.vstack([simplex.basis, axis]))
            if np.linalg.cond(wider.vertices()[1:]) > CONDITION:
                break
            simplex = wider
        return simplex

    def vertices(self) -> np.ndarray:
        """The pivots as a simplex: each has one coordinate more than the one before."""
        return (self.pivots - self.pivots[0]) @ self.basis.T

    def distances(self, vectors: np.ndarray) -> np.ndarray:
        """Squared distances of each vector to each pivot."""
        points = vectors.astype(np.float64)
        return np.maximum(0, (points**2).sum(axis=1)[:, None] + (self.pivots**2).sum(axis=1) - 2 * points @ self.pivots.T)

    def apexes(self, squared: np.ndarray) -> np.ndarray:
        """Apex coordinates from squared distances to the pivots: the foot, then the height."""
        vertices = self.vertices()
        foot = np.zeros((len(squared), len(vertices) - 1))
        for at in range(1, len(vertices)):
            vertex = vertices[at]
            known = foot[:, : at - 1] @ vertex[: at - 1]
            foot[:, at - 1] = ((squared[:, 0] - squared[:, at] + vertex @ vertex) / 2 - known) / vertex[at - 1]
        height = np.sqrt(np.maximum(0, squared[:, 0] - (foot**2).sum(axis=1)))
        return np.hstack([foot, height[:, None]])


def bounds(apexes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of squared distances from apexes to centroids' apexes, with slack for rounding."""
    foot, height = apexes[:, :-1], apexes[:, -1:]
    own_foot, own_height = centroids[:, :-1], centroids[:, -1]
    size, own_size = (foot**2).sum(axis=1)[:, None], (own_foot**2).sum(axis=1)
    along = np.maximum(0, size + own_size - 2 * foot @ own_foot.T)
    slack = SLACK * (size + own_size + height**2 + own_height**2 + 1)
    return along + (height - own_height) ** 2 - slack, along + (height + own_height) ** 2 + slack


def nearest(vectors: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of the nearest centroid, ties to the smaller number, and how many pairs were compared."""
    lower, upper = bounds(apexes, own)
    left = lower <= upper.min(axis=1)[:, None]
    best = np.full(len(vectors), np.iinfo(np.int64).max)
    cluster = np.full(len(vectors), -1, dtype=np.int32)
    for number, centroid in enumerate(centroids):
        rows = np.flatnonzero(left[:, number])
        found = ((vectors[rows] - centroid) ** 2).sum(axis=1)
        closer = (found < best[rows]) | (cluster[rows] < 0)
        best[rows[closer]], cluster[rows[closer]] = found[closer], number
    return cluster, best, int(left.sum())


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """``vec_id, vector`` of the rows that take part: all components there and finite, exactly ``DIMENSION`` of them."""
    number = F.transform("embedding", lambda x: x.cast("double"))
    finite = F.forall(number, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    whole = F.transform(number, lambda x: F.greatest(F.least(F.floor(F.greatest(F.least(x, F.lit(1e12)), F.lit(-1e12)) * SCALE), F.lit(LARGEST)), F.lit(-LARGEST)))
    rows = embeddings.where(F.size("embedding") == DIMENSION).where(finite)
    return rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), whole.cast("array<int>").alias("vector"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            yield batch.slice(at, BLOCK)


def starts(vectors: DataFrame, count: int) -> np.ndarray:
    """The vectors of the ``count`` ids of smallest hash; of equal ids the smaller vector first, null ids last."""
    rank = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    rows = vectors.orderBy(rank.asc_nulls_last(), "vector").select("vector").limit(count).collect()
    return np.array([row.vector for row in rows], dtype=np.int64).reshape(-1, DIMENSION)


def with_apexes(vectors: DataFrame, simplex: Simplex) -> DataFrame:
    """``vec_id, vector, apex``: the distances to the pivots, measured once, as apex coordinates."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _steps(batches):
            apexes = simplex.apexes(simplex.distances(_matrix(rows.column("vector"), DIMENSION)))
            ends = pa.array(np.arange(len(apexes) + 1, dtype=np.int32) * apexes.shape[1])
            apex = pa.ListArray.from_arrays(ends, pa.array(apexes.ravel().astype(np.float32)))
            yield pa.RecordBatch.from_arrays([rows.column("vec_id"), rows.column("vector"), apex], ["vec_id", "vector", "apex"])

    return vectors.mapInArrow(project, "vec_id BIGINT, vector ARRAY<INT>, apex ARRAY<FLOAT>")


def assigned(held: DataFrame, simplex: Simplex, centroids: np.ndarray) -> DataFrame:
    """``vec_id, cluster, distance, compared`` of every vector; ``compared`` counts its block's exact comparisons, once per block."""
    own = simplex.apexes(simplex.distances(centroids))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _steps(batches):
            vectors = _matrix(rows.column("vector"), DIMENSION).astype(np.int64)
            cluster, distance, compared = nearest(vectors, _matrix(rows.column("apex"), own.shape[1]).astype(np.float64), centroids, own)
            once = np.zeros(len(vectors), dtype=np.int64)
            once[:1] = compared
            yield pa.RecordBatch.from_arrays([rows.column("vec_id"), *map(pa.array, (cluster, distance, once))], ["vec_id", "cluster", "distance", "compared"])

    return held.select("vec_id", "vector", "apex").mapInArrow(assign, "vec_id BIGINT, cluster INT, distance BIGINT, compared BIGINT")


def moved(held: DataFrame, simplex: Simplex, centroids: np.ndarray) -> np.ndarray:
    """The next centroids: floors of the means of their vectors; those without vectors stay.

    Each step of a task sends one partial sum per cluster, so a cluster with a third of all rows is folded where its
    rows lie. The driver gets one row per centroid.
    """
    own = simplex.apexes(simplex.distances(centroids))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(len(centroids), dtype=np.int64), np.zeros(centroids.shape, dtype=np.int64)
        for rows in _steps(batches):
            vectors = _matrix(rows.column("vector"), DIMENSION).astype(np.int64)
            cluster, _, _ = nearest(vectors, _matrix(rows.column("apex"), own.shape[1]).astype(np.float64), centroids, own)
            order = np.argsort(cluster, kind="stable")
            present, first, many = np.unique(cluster[order], return_index=True, return_counts=True)
            counts[present] += many
            sums[present] += np.add.reduceat(vectors[order], first, axis=0) if len(first) else 0
        some = np.flatnonzero(counts)
        columns = [pa.array(some.astype(np.int32)), pa.array(counts[some]), pa.array(sums[some].tolist(), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, ["cluster", "count", "sums"])

    partial = held.select("vector", "apex").mapInArrow(fold, "cluster INT, count BIGINT, sums ARRAY<BIGINT>")
    totals = [F.sum(F.col("sums")[at].cast("decimal(38,0)")).alias(f"sum_{at}") for at in range(DIMENSION)]
    following = centroids.copy()
    for row in partial.groupBy("cluster").agg(F.sum("count").alias("count"), *totals).collect():
        following[row["cluster"]] = [int(row[f"sum_{at}"]) // row["count"] for at in range(DIMENSION)]
    return following


def clusters(embeddings: DataFrame, count: int = CENTROIDS, rounds: int = ROUNDS, pivots: int = PIVOTS) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, compared`` of every vector that takes part.

    Vectors that are null, of another length, or hold null or non-finite components take no part. Repeated rows take
    part each, and so does a null ``vec_id``, which is a starting centroid only if ids are fewer than ``count``. With fewer vectors
    than ``count`` there are as many centroids as vectors; an empty table gives no rows. Other columns are ignored.
    """
    scratch = Scratch(embeddings.sparkSession, "clusters")
    spark = embeddings.sparkSession
    vectors = whole_vectors(embeddings)
    candidates = starts(vectors, max(count, CANDIDATES))
    centroids = candidates[:count]
    if not len(centroids):
        schema = "vec_id BIGINT, cluster INT, distance BIGINT, cluster_inertia BIGINT, inertia BIGINT, centroid_sha256 STRING, compared BIGINT"
        return spark.createDataFrame([], schema)
    simplex = Simplex.over(candidates, pivots)
    held = scratch.keep(with_apexes(vectors, simplex), "vectors")
    for _ in range(rounds):
        centroids = moved(held, simplex, centroids)
    found = scratch.keep(assigned(held, simplex, centroids), "assigned")
    scratch.drop("vectors")
    digests = [(number, hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()) for number, centroid in enumerate(centroids)]
    sums = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()
    inertia = dict(map(tuple, sums))
    about = [(number, inertia.get(number, 0), sum(inertia.values()), digest) for number, digest in digests]
    listed = spark.createDataFrame(about, "cluster INT, cluster_inertia BIGINT, inertia BIGINT, centroid_sha256 STRING")
    return found.join(F.broadcast(listed), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "compared")
