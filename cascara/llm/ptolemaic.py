"""Centroid clustering of vectors of whole numbers, with lower bounds from pivot pairs by Ptolemy's inequality.

Among any four points of Euclidean space, d(x, c) d(p, q) >= |d(x, p) d(c, q) - d(x, q) d(c, p)|. Pivots are fixed at
the start: a few of the first centroids, each as far from those before as can be. Every vector's distances to them are
computed once and written with it; those of the centroids once a round. All pairs of pivots bound the distance of a
vector to each centroid from below. The centroid of the least bound is measured first, and of the others only those
whose bound, rounded down by more than the floating-point error, does not exceed the best distance so far; these are
measured exactly, in whole numbers, so that ties go to the smaller number.

A round reads the written vectors and adds up each task's rows per cluster; one row per cluster and component reaches the
driver. The centroids (a parameter's worth of numbers) go to all tasks.

Odd cases: vectors that are null, of another length, or hold null, NaN or infinite components are dropped; rows without
an id are clustered and come last among the candidates for a first centroid, equal ids in the order of their numbers;
fewer vectors than clusters make fewer clusters; equal rows count each; equal first centroids leave the later ones
empty; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cascara.llm.common import prepare, stage
from cascara.llm.int_vectors import Sums, cell_sums, fitting, floors, largest, longs, packed, squared, unpacked, whole

DIM = 64
SCALE = 64
CLUSTERS = 16
ROUNDS = 3
PIVOTS = 8
#: Relative slack of a product or quotient of rounded distances, several times its error.
SLACK = 2.0**-48


def cluster(rows: DataFrame, vec: str = "embedding", dim: int = DIM, scale: int = SCALE, clusters: int = CLUSTERS, rounds: int = ROUNDS,
            pivots: int = PIVOTS, seed: str = "1:") -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` per kept vector."""
    spark = rows.sparkSession
    prepare(spark)
    kept = rows.where(whole(vec) & (F.size(vec) == dim)).select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vec).alias("v"))
    drawn = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")).cast("binary"), 256)
    first = kept.select(drawn.alias("drawn"), F.col("v").cast("array<double>").alias("v")).orderBy(F.col("drawn").asc_nulls_last(), "v").limit(clusters).collect()
    if not first:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = [[int(x) for x in np.floor(scale * np.array(r["v"]))] for r in first]
    fixed = spread(centroids, pivots)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = floors(b.column("v"), dim, scale)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), packed(x), packed(distances(x, fixed))], names=["vec_id", "v", "d"])

    ready = stage(kept.mapInArrow(read, "vec_id long, v binary, d binary"), "clusters-vectors")
    for _ in range(rounds):
        for cell, (n, sums) in cell_sums(ready, _learner(centroids, fixed, dim)).items():
            centroids[cell] = [s // n for s in sums]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(centroids, fixed)
        for b in batches:
            nearest, distance, _ = search.nearest(unpacked(b.column("v"), dim), unpacked(b.column("d"), len(fixed)))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(nearest.astype(np.int32)), longs(distance)], names=["vec_id", "cluster", "distance"])

    placed = stage(ready.mapInArrow(write, "vec_id long, cluster int, distance long"), "clusters")
    inertia = {r["cluster"]: r["s"] for r in placed.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    of_cluster = spark.createDataFrame([(c, s, sum(inertia.values()), digest[c]) for c, s in inertia.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(of_cluster), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # a row per cluster


def spread(points: list[list[int]], n: int) -> list[list[int]]:
    """Up to ``n`` different points, each the farthest from those before it."""
    out = [points[0]]
    while len(out) < n:
        gaps = [min(sum((a - b) ** 2 for a, b in zip(p, o, strict=True)) for o in out) for p in points]
        if max(gaps) == 0:
            break
        out.append(points[gaps.index(max(gaps))])
    return out


def distances(x: np.ndarray, points: list[list[int]]) -> np.ndarray:
    """Distances of every row to every point, each off by a few units in the last place at most."""
    y = np.array(points, object)
    x, y = fitting(4.0 * max(largest(x), max(abs(v) for p in points for v in p)) ** 2 * x.shape[1], x, y)
    return np.stack([np.sqrt(squared(x, p).astype(np.float64)) for p in y], axis=1) if len(x) else np.zeros((0, len(points)))


def _learner(centroids: list[list[int]], fixed: list[list[int]], dim: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Sums:
        search = Search(centroids, fixed)
        sums = Sums(len(centroids), dim)
        for b in batches:
            x = unpacked(b.column("v"), dim)
            sums.add(search.nearest(x, unpacked(b.column("d"), len(fixed)))[0], x)
        return sums

    return work


class Search:
    """Nearest centroids by bounds from pivot pairs."""

    def __init__(self, centroids: list[list[int]], pivots: list[list[int]]):
        self.centroids = np.array(centroids, object)
        self.most = max(abs(v) for c in centroids for v in c) if centroids[0] else 0
        self.to_pivots = distances(self.centroids, pivots)
        between = distances(np.array(pivots, object), pivots)
        self.pairs = [(i, j, between[i, j] * (1 + SLACK)) for i in range(len(pivots)) for j in range(i)]

    def bounds(self, d: np.ndarray) -> np.ndarray:
        """A lower bound of the distance of each row (its distances to the pivots are ``d``) to each centroid."""
        low = np.zeros((len(d), len(self.centroids)))
        for i, j, gap in self.pairs:
            a, b = np.outer(d[:, i], self.to_pivots[:, j]), np.outer(d[:, j], self.to_pivots[:, i])
            np.maximum(low, (np.abs(a - b) - SLACK * (a + b)) / gap, out=low)
        return low * (1 - SLACK)

    def nearest(self, rows: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The nearest centroid of each row (of equally near ones the smallest number), its squared distance, and how many
        distances were computed in all."""
        x, c = fitting(4.0 * max(largest(rows), self.most) ** 2 * max(1, rows.shape[1]), rows, self.centroids)
        low = self.bounds(d)
        nearest = low.argmin(axis=1)
        best = squared(x, c[nearest])
        first, computed = nearest.copy(), len(x)
        for k in range(len(c)):
            at = np.flatnonzero((first != k) & (low[:, k] <= np.sqrt(best.astype(np.float64)) * (1 + SLACK)))
            distance = squared(x[at], c[k])
            better = (distance < best[at]) | ((distance == best[at]) & (k < nearest[at]))
            best[at[better]], nearest[at[better]] = distance[better], k
            computed += len(at)
        return nearest, best, computed
