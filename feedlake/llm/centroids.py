"""Centroid clustering with a vantage-point tree over the centroids.

Vectors are settled once in whole numbers. In each round a tree over the current centroids is built
at the driver and broadcast; every vector finds its nearest centroid by its own best-first descent,
and tasks send sums per cluster on, never vectors. All distances and means are exact, so neither
partitioning nor the order of rows changes a result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from feedlake.llm.vectors import fits_long, packed, scaled, squared_distances, unpacked
from feedlake.plans.shared import settle

SCALE = 1024
CLUSTERS = 8
ROUNDS = 10
SEED = 3
SIZE = 64  # components of a vector that takes part
LEAF = 2  # centroids of a leaf
CELLS = 1 << 20  # bounds that are held at once, over all vectors searched together
_TOO_LONG = 10**27  # sums of 10**11 components below it fit 38 digits


class VantageTree:
    """Centroids by their distances from vantage points.

    A node takes one centroid as its vantage point and cuts the others at the median distance; each
    child knows the least and greatest distance of its centroids from that point. Leaves hold the
    centroids themselves.
    """

    def __init__(self, centers: np.ndarray, leaf: int = LEAF):
        self.centers = centers
        self.vantage: list[int] = []  # a centroid, or -1 for a leaf
        self.members: list[np.ndarray] = []
        self.children: list[list[tuple[int, float, float]]] = []
        todo = [(np.arange(len(centers)), -1, 0.0, 0.0)]
        while todo:
            own, parent, low, high = todo.pop()
            node = len(self.vantage)
            if parent >= 0:
                self.children[parent].append((node, low, high))
            self.children.append([])
            if len(own) <= leaf:
                self.vantage.append(-1)
                self.members.append(own)
                continue
            point = self._vantage(own)
            rest = own[own != point]
            apart = roots(squared_distances(centers[rest], centers[point]))
            by_distance = np.argsort(apart, kind="stable")
            rest, apart, half = rest[by_distance], apart[by_distance], (len(rest) + 1) // 2
            self.vantage.append(int(point))
            self.members.append(own[:0])
            for a, b in ((0, half), (half, len(rest))):
                if a < b:
                    todo.append((rest[a:b], node, float(apart[a]), float(apart[b - 1])))

    def _vantage(self, own: np.ndarray) -> int:
        """The centroid that lies farthest from the first: distances from a corner spread most."""
        far = squared_distances(self.centers[own], self.centers[own[0]])
        return int(own[max(range(len(own)), key=lambda k: far[k])])

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number of the nearest centroid of each point, the squared distance, and the comparisons.

        The points step together, but each goes its own way: in every step a point takes the open
        node of its least bound, and it is done once that bound is above its best distance. A bound
        equal to the best distance is still followed (a centroid there may have a smaller number),
        and bounds give way a little, so rounding never cuts off a centroid.
        """
        nodes = len(self.vantage)
        numbers = np.full(len(points), len(self.centers), np.int64)
        wide = points.dtype == object or self.centers.dtype == object
        best = np.zeros(len(points), object if wide else np.int64)
        radius = np.full(len(points), np.inf)
        compared = 0
        step = max(1, CELLS // nodes)
        for first in range(0, len(points), step):
            rows = slice(first, first + step)
            compared += self._descend(points[rows], numbers[rows], best[rows], radius[rows])
        return numbers, best, compared

    def _descend(self, points, numbers, best, radius) -> int:
        open_bounds = np.full((len(points), len(self.vantage)), np.inf)
        open_bounds[:, 0] = 0.0
        searching, compared = np.arange(len(points)), 0
        while len(searching):
            taken = open_bounds[searching].argmin(1)
            bounds = open_bounds[searching, taken]
            going = bounds <= radius[searching]
            going &= np.isfinite(bounds)
            searching, taken, bounds = searching[going], taken[going], bounds[going]
            open_bounds[searching, taken] = np.inf
            for node in np.unique(taken):
                here = taken == node
                rows = searching[here]
                point = self.vantage[node]
                members = [point] if point >= 0 else self.members[node]
                for number in members:
                    apart = squared_distances(points[rows], self.centers[number])
                    self._improve(rows, int(number), apart, numbers, best, radius)
                    compared += len(rows)
                if point >= 0:
                    distance = roots(apart)
                    for child, low, high in self.children[node]:
                        least = np.maximum(low - distance, distance - high)
                        least -= 1e-9 * (1 + distance + high)
                        open_bounds[rows, child] = np.maximum(least, bounds[here])
        return compared

    @staticmethod
    def _improve(rows, number, apart, numbers, best, radius) -> None:
        unset = ~np.isfinite(radius[rows])
        closer = unset | (apart < best[rows]) | ((apart == best[rows]) & (number < numbers[rows]))
        closer = closer.astype(bool)
        better = rows[closer]
        numbers[better] = number
        best[better] = apart[closer]
        distance = roots(apart[closer])
        radius[better] = distance + 1e-9 * (1 + distance)


def roots(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


def whole_vectors(
    vectors: DataFrame, vec_id: str, vector: str, scale: int = SCALE, size: int = SIZE
) -> DataFrame:
    """The vectors that take part, in whole numbers: vec_id, long, points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, matrix in scaled(batch.column("vector"), scale):
                long = matrix.dtype == object
                if long:
                    keep = np.array([max(map(abs, row)) < _TOO_LONG for row in matrix], bool)
                    places, matrix = places[keep], matrix[keep]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(pa.array(places)),
                        pa.array(np.full(len(places), long)),
                        packed(matrix),
                    ],
                    ["vec_id", "long", "points"],
                )

    narrow = vectors.select(
        F.col(vec_id).cast("bigint").alias("vec_id"),
        F.col(vector).cast("array<double>").alias("vector"),
    ).where(F.size("vector") == size)
    return narrow.mapInArrow(run, "vec_id bigint, long boolean, points binary")


def _matrix(rows: list) -> np.ndarray:
    """Rows as (long, points) in one matrix."""
    if any(r["long"] for r in rows):
        out = [
            list(map(int, r["points"].split(b","))) if r["long"]
            else np.frombuffer(r["points"], "<i4").tolist()
            for r in rows
        ]
        return np.array(out, object)
    return np.stack([np.frombuffer(r["points"], "<i4") for r in rows]).astype(np.int64)


def first_centroids(whole: DataFrame, clusters: int, seed: int) -> np.ndarray | None:
    """The vectors of the smallest hashes of seed and id; equal ids go by their components."""
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = whole.orderBy(drawn.asc_nulls_last(), "long", "points").limit(clusters).collect()
    return _matrix(rows) if rows else None


def cluster_sums(whole: DataFrame, tree) -> DataFrame:
    """Per cluster and component the exact sum of its vectors, and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: dict[int, int] = {}
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            long = batch.column("long").to_numpy(zero_copy_only=False)
            for _, points in unpacked(batch.column("points"), long):
                numbers = tree.value.nearest(points)[0]
                for number in np.unique(numbers).tolist():
                    own = points[numbers == number]
                    count[number] = count.get(number, 0) + len(own)
                    part = own.sum(0).astype(object)
                    sums[number] = sums[number] + part if number in sums else part
        for number, total in sums.items():
            size = len(total)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number] * size, pa.int32()),
                    pa.array(range(size), pa.int32()),
                    pa.array([count[number]] * size, pa.int64()),
                    pa.array([int(x) for x in total], pa.decimal128(38, 0)),
                ],
                ["cluster", "place", "n", "total"],
            )

    parts = whole.mapInArrow(run, "cluster int, place int, n bigint, total decimal(38,0)")
    return parts.groupBy("cluster", "place").agg(
        F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total")
    )


def moved(centers: np.ndarray, sums: list) -> np.ndarray:
    """Centroids after a round: the floored mean of each cluster; an empty one stays."""
    out = centers.astype(object)
    for row in sums:
        out[row["cluster"], row["place"]] = int(row["total"]) // row["n"]
    return out.astype(np.int64) if max(map(abs, out.ravel().tolist())) < 1 << 24 else out


def _assign(whole: DataFrame, tree) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            long = batch.column("long").to_numpy(zero_copy_only=False)
            for places, points in unpacked(batch.column("points"), long):
                numbers, best, _ = tree.value.nearest(points)
                fits = fits_long(best)
                distance = np.where(fits, best, 0).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(pa.array(places)),
                        pa.array(numbers, pa.int32()),
                        pa.array(distance, pa.int64(), mask=~fits),
                    ],
                    ["vec_id", "cluster", "distance"],
                )

    return whole.mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


def _sum(column: str) -> Column:
    return F.sum(F.col(column).cast("decimal(38,0)"))


def cluster(
    vectors: DataFrame,
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: int = SEED,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    scale: int = SCALE,
    size: int = SIZE,
) -> DataFrame:
    """Cluster of each vector: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Only vectors of ``size`` finite components take part. Every other one (null, empty, another
    length, a null or non-finite component) gives no row; nor does one with a scaled component of
    10**27 or more in size, as no distance from it fits 64 bits. A squared distance, or a sum of
    them, beyond 64 bits is null; the cluster is right all the same. A null id keeps its row and is
    drawn last; a repeated row is a vector each time. With fewer vectors than ``clusters`` there are
    fewer centroids. Ties go to the smaller centroid number. An empty table gives no rows; columns
    other than the two named are not read.

    What reaches the driver is ``clusters`` vectors and, per round, one number per centroid and
    component; the same amount is broadcast. Rounds end early once no centroid moves, since further
    ones would change nothing.
    """
    spark = vectors.sparkSession
    whole = settle(whole_vectors(vectors, vec_id, vector, scale, size), "whole_vectors")
    centers = first_centroids(whole, clusters, seed)
    if centers is None:
        return spark.createDataFrame([], RESULT)
    for _ in range(rounds):
        tree = spark.sparkContext.broadcast(VantageTree(centers))
        after = moved(centers, cluster_sums(whole, tree).collect())
        tree.unpersist()
        still = bool((after == centers).all())
        centers = after
        if still:
            break
    tree = spark.sparkContext.broadcast(VantageTree(centers))
    told = settle(_assign(whole, tree), "assigned")
    digests = [
        (k, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest())
        for k, row in enumerate(centers.tolist())
    ]
    named = spark.createDataFrame(digests, "cluster int, centroid_sha256 string")
    # One row per cluster: small however many vectors there are.
    inertia = told.groupBy("cluster").agg(_sum("distance").alias("own"))
    whole_sum = F.sum("own").over(Window.partitionBy())
    totals = inertia.select(
        "cluster",
        F.expr("try_cast(own as bigint)").alias("cluster_inertia"),
        whole_sum.try_cast("bigint").alias("inertia"),
    ).join(F.broadcast(named), "cluster")
    return told.join(F.broadcast(totals), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


RESULT = (
    "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, "
    "centroid_sha256 string"
)
