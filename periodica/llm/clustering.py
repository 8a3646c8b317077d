"""Exact integer k-means with centroids filtered by n-simplex projection.

A few pivots span a simplex. The distances of a vector to the pivots, worked out once
and kept with it, fix its place as the apex of a simplex over them: its coordinates in
the pivots' span and its altitude above it. Of two apexes the true distance is known
to lie between the Euclidean distance of the apexes and that of one and the other's
mirror image. In every round the centroids get apexes of their own; a centroid whose
lower bound exceeds another's upper bound cannot be the nearest, and only those left
are compared by exact integer distances. The bounds leave room for rounding, so the
result is that of comparing all.

Every component x of a vector becomes floor(scale * x). Vectors that are null, of
another length, or hold a null or non-finite component take no part. A component of
2^27 or more after scaling is an error, as distances would not fit a long. The first
centroids are the vectors with the smallest hashes of their ids; a null id counts as
the empty text, and rows that repeat an id are taken in the order of their vectors.
With fewer vectors than centroids, each vector is a centroid. An empty table gives an
empty frame. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from periodica.llm.common import staged, text_of

#: Scaled components must be smaller than this.
LIMIT = 1 << 27
#: Pivots flatter than this share of their distance above the others span too little to be of use.
FLAT = 0.05
#: Room for rounding in bounds, as a share of the squared distances they come from.
ROOM = 1e-5


def _lists(column: pa.Array, size: int) -> tuple[pa.Array, np.ndarray]:
    """Which lists have this many elements, and those as a matrix with NaN for null."""
    fits = pc.fill_null(pc.equal(pc.list_value_length(column), size), False)
    values = column.filter(fits).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return fits, values.reshape(-1, size)


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    """A column of lists of one length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), -1)


def _array(matrix: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.arange(len(matrix) + 1, dtype=np.int32) * matrix.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.reshape(-1), kind))


def integer_vectors(
    vectors: DataFrame, scale: int = 64, size: int = 64, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """(vec_id, point array<int>) of the vectors that take part."""
    source = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("embedding"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits, values = _lists(batch.column(1), size)
            finite = np.isfinite(values).all(axis=1)
            points = np.floor(values[finite] * scale)
            if (np.abs(points) >= LIMIT).any():
                raise ValueError(f"a component times {scale} is {LIMIT} or more")
            ids = batch.column(0).filter(fits).filter(pa.array(finite))
            yield pa.RecordBatch.from_arrays([ids, _array(points.astype(np.int32), pa.int32())], ["vec_id", "point"])

    return source.mapInArrow(run, f"vec_id {source.schema['vec_id'].dataType.simpleString()}, point array<int>")


def first_centroids(points: DataFrame, clusters: int, salt: str = "1:") -> np.ndarray:
    """The points whose ids have the smallest hashes, in that order."""
    key = F.sha2(F.concat(F.lit(salt), text_of(F.col("vec_id"))), 256)
    first = points.orderBy(key, "point").limit(clusters).select("point").collect()
    return np.array([row.point for row in first], np.int64)


class Simplex:
    """The base simplex of some pivots, and the apexes of vectors above it."""

    def __init__(self, candidates: np.ndarray, most: int):
        """Takes the first candidate and those that stand out of the span of the ones before."""
        self.pivots = candidates[:1]
        for candidate in candidates[1:]:
            if len(self.pivots) == most:
                break
            self._fix()
            apex = self.apexes(candidate[None])[0]
            if apex[-1] > FLAT * np.sqrt(np.square(apex).sum()) and apex[-1] >= 1:
                self.pivots = np.vstack([self.pivots, candidate])
        self._fix()

    def _fix(self) -> None:
        edges = (self.pivots[1:] - self.pivots[0]).astype(float)
        self.base = np.linalg.cholesky(edges @ edges.T) if len(edges) else np.zeros((0, 0))
        self.inverse = np.linalg.inv(self.base)

    def apexes(self, points: np.ndarray) -> np.ndarray:
        """Coordinates in the span of the pivots, then the altitude, from the distances to the pivots alone."""
        squares = np.stack([np.square(points.astype(np.int64) - p).sum(axis=1) for p in self.pivots], axis=1).astype(float)
        sides = np.square(self.base).sum(axis=1)
        inside = (squares[:, :1] + sides - squares[:, 1:]) / 2 @ self.inverse.T
        altitude = np.sqrt(np.maximum(squares[:, 0] - np.square(inside).sum(axis=1), 0))
        return np.column_stack([inside, altitude])


def possible(apexes: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Which centroids (columns) may be the nearest of each vector, by the bounds between apexes."""
    lower, upper = np.empty((2, len(apexes), len(centroids)))
    for j, centroid in enumerate(centroids):
        flat = np.square(apexes[:, :-1] - centroid[:-1]).sum(axis=1)
        lower[:, j] = flat + np.square(apexes[:, -1] - centroid[-1])
        upper[:, j] = flat + np.square(apexes[:, -1] + centroid[-1])
    room = ROOM * (1 + np.square(apexes).sum(axis=1) + np.square(centroids).sum(axis=1).max())
    return lower <= (upper.min(axis=1) + room)[:, None]


def nearest(points: np.ndarray, apexes: np.ndarray, simplex: Simplex, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of and squared distance to the nearest centroid; the smaller number wins a tie."""
    cluster, distance = np.full(len(points), -1), np.full(len(points), np.iinfo(np.int64).max)
    left = possible(apexes, simplex.apexes(centroids))
    for j, centroid in enumerate(centroids):
        rows = np.flatnonzero(left[:, j])
        exact = np.square(points[rows] - centroid).sum(axis=1)
        closer = exact < distance[rows]
        cluster[rows[closer]], distance[rows[closer]] = j, exact[closer]
    return cluster, distance


def cluster_vectors(
    vectors: DataFrame, clusters: int = 16, rounds: int = 3, scale: int = 64, size: int = 64, pivots: int = 8,
    vec_id: str = "vec_id", embedding: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every vector that takes part, and the final centroids.

    The vectors are stored once with their apexes; every round reads them and returns
    one row of sums per cluster and task. Only centroids and such sums, clusters times
    size numbers, reach the driver.
    """
    points = integer_vectors(vectors, scale, size, vec_id, embedding)
    kind = points.schema["vec_id"].dataType.simpleString()
    centroids = first_centroids(points, clusters)
    if not len(centroids):
        return points.selectExpr("vec_id", "0 AS cluster", "0L AS distance").where("false"), centroids
    simplex = Simplex(centroids, pivots)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apexes = simplex.apexes(_matrix(batch.column(1), np.int64)) if batch.num_rows else np.empty((0, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, _array(apexes, pa.float64())], ["vec_id", "point", "apex"])

    kept = staged(points.mapInArrow(project, f"vec_id {kind}, point array<int>, apex array<double>"), "apexes")

    def sums(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centroids), size + 1), np.int64)
        for batch in batches:
            if batch.num_rows:
                held = _matrix(batch.column(0), np.int64)
                cluster, _ = nearest(held, _matrix(batch.column(1), float), simplex, centroids)
                for j in np.unique(cluster):
                    total[j, 0] += (cluster == j).sum()
                    total[j, 1:] += held[cluster == j].sum(axis=0)
        used = np.flatnonzero(total[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), _array(total[used], pa.int64())], ["cluster", "sums"])

    for _ in range(rounds):
        parts = kept.select("point", "apex").mapInArrow(partial(sums, centroids=centroids), "cluster int, sums array<long>")
        totals = (
            parts.select("cluster", F.posexplode("sums").alias("place", "part"))
            .groupBy("cluster", "place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect()
        )
        found: dict[int, dict[int, int]] = {}
        for row in totals:
            found.setdefault(row.cluster, {})[row.place] = int(row.total)
        centroids = centroids.copy()
        for j, total in found.items():
            centroids[j] = [total[place] // total[0] for place in range(1, size + 1)]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cluster, distance = nearest(
                    _matrix(batch.column(1), np.int64), _matrix(batch.column(2), float), simplex, centroids)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())],
                    ["vec_id", "cluster", "distance"])

    return staged(kept.mapInArrow(assign, f"vec_id {kind}, cluster int, distance long"), "clusters"), centroids


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Assigned vectors with the inertia of their cluster and of all, and the digest of their centroid."""
    spark = assigned.sparkSession
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    named = spark.createDataFrame(list(enumerate(digests)), "cluster int, centroid_sha256 string")
    per = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("of_cluster"))
    whole = F.sum("of_cluster").over(Window.partitionBy())  # one row for each cluster
    facts = per.withColumn("of_all", whole).join(named, "cluster").select(
        "cluster", F.col("of_cluster").cast("long").alias("cluster_inertia"), F.col("of_all").cast("long").alias("inertia"),
        "centroid_sha256")
    return assigned.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
