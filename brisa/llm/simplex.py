"""Exact k-means on integer vectors, whose centroids are filtered by n-simplex projection.

Distances from a vector to n pivots, computed once and kept, place it as the apex over the simplex
of the pivots: n coordinates.  For any two points the Euclidean distance of their apexes is a lower
bound of their distance, and with the sign of one last coordinate turned an upper bound.  In every
round the centroids get their apexes, too.  A centroid whose lower bound is above the least upper
bound of a vector cannot be its nearest one; the others are compared by their exact integer distances.

Bounds are computed in floating point and widened by SLACK of the largest distance involved, far
beyond their rounding error, as pivots that add almost no new direction are left out.  A round
reads the stored vectors once; a task sends one sum for each centroid and component.

* A vector is kept if it has exactly DIMENSIONS components, none null or not finite.
* Component x becomes floor(64 x), taken as +-2^27 beyond that, so that distances fit a long.
* Fewer vectors than centroids: each is a centroid.  None: no rows.
* Rows that share a vec_id are vectors of their own.  A row without vec_id is assigned like any
  other, but is never one of the first centroids.
* Inertias that do not fit a long are null.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from brisa.llm.common import stored

DIMENSIONS, CENTROIDS, ROUNDS, GRID = 64, 16, 3, 64
PIVOTS = 8
MOST = 1 << 27
SLACK, FLAT = 1e-7, 1e-2  # see above; a pivot's height over the others, as a share of its distance
_BLOCK = 4096


def quantized(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, q): the kept vectors as integers."""
    rows = vectors.select(
        vectors[vec_id].cast("long").alias("vec_id"), vectors[embedding].cast("array<double>").alias("v")
    ).where(F.size("v") == DIMENSIONS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, DIMENSIONS)  # null: NaN
            good = np.isfinite(flat).all(axis=1)
            with np.errstate(over="ignore"):
                q = np.clip(np.floor(flat[good] * GRID), -MOST, MOST).astype(np.int64)
            ids = batch.column("vec_id").filter(pa.array(good))
            yield pa.RecordBatch.from_arrays([ids, _lists(q)], ["vec_id", "q"])

    return rows.mapInArrow(run, "vec_id long, q array<long>")


def _lists(rows: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32()), pa.array(rows.ravel()))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, width)


def first_centroids(rows: DataFrame, count: int = CENTROIDS) -> np.ndarray:
    """The `count` vectors with the smallest sha256 of `1:<vec_id>`, ties by their components."""
    draw = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    least = rows.where("vec_id is not null").select(draw.alias("draw"), "q").orderBy("draw", "q").limit(count)
    found = [r["q"] for r in least.collect()]
    return np.array(found, np.int64).reshape(-1, DIMENSIONS)


class Simplex:
    """A base of pivots; `apexes` places points over it by their distances to the pivots."""

    def __init__(self, points: np.ndarray, most: int = PIVOTS) -> None:
        chosen: list[int] = []
        base = np.zeros((0, 0))  # row k: pivot k's coordinates, lower triangular
        for k, point in enumerate(points):
            if len(chosen) == most:
                break
            if not chosen:
                chosen, base = [k], np.zeros((1, 1))
                continue
            squares = exact_squares(point[None, :], points[chosen]).astype(float)
            self.base, self.pivots = base, points[chosen]
            apex = self._place(squares)[0]
            if apex[-1] ** 2 <= FLAT * squares.max():  # almost inside what the others span
                continue
            grown = np.zeros((len(base) + 1, len(base) + 1))
            grown[:-1, : base.shape[1]] = base
            grown[-1, : len(apex)] = apex
            chosen, base = [*chosen, k], grown
        self.base, self.pivots = base, points[chosen]

    def _place(self, squares: np.ndarray) -> np.ndarray:
        """(n, pivots): coordinates along the base, then the height over it."""
        base, count = self.base, len(self.base)
        out = np.zeros((len(squares), count))
        for k in range(1, count):
            # |x - p_0|^2 - |x - p_k|^2 = 2 <x, p_k> - |p_k|^2, as p_0 is the origin
            pk = base[k, :k]
            right = (squares[:, 0] - squares[:, k] + (pk**2).sum()) / 2 - out[:, : k - 1] @ pk[: k - 1]
            out[:, k - 1] = right / pk[k - 1]
        out[:, count - 1] = np.sqrt(np.maximum(squares[:, 0] - (out[:, : count - 1] ** 2).sum(axis=1), 0))
        return out

    def apexes(self, points: np.ndarray) -> np.ndarray:
        return self._place(exact_squares(points, self.pivots).astype(float))


def exact_squares(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """(n, m) squared distances in integers."""
    out = np.empty((len(points), len(centers)), np.int64)
    for k, center in enumerate(centers):
        differs = points - center
        out[:, k] = np.einsum("ij,ij->i", differs, differs)
    return out


def nearest(points: np.ndarray, apex: np.ndarray, centers: np.ndarray, over: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of each point's nearest center (ties: the smaller) and its exact squared distance.

    `apex` and `over` are the apexes of the points and of the centers.
    """
    along = ((apex[:, None, :-1] - over[None, :, :-1]) ** 2).sum(axis=2)
    low = along + (apex[:, None, -1] - over[None, :, -1]) ** 2
    high = along + (apex[:, None, -1] + over[None, :, -1]) ** 2
    slack = SLACK * (1 + (apex**2).sum(axis=1).max(initial=0) + (over**2).sum(axis=1).max(initial=0))
    possible = low <= high.min(axis=1)[:, None] + 2 * slack
    best = np.full(len(points), np.iinfo(np.int64).max)
    label = np.zeros(len(points), np.int32)
    for k, center in enumerate(centers):
        rows = np.flatnonzero(possible[:, k])
        differs = points[rows] - center
        squares = np.einsum("ij,ij->i", differs, differs)
        closer = squares < best[rows]
        best[rows[closer]] = squares[closer]
        label[rows[closer]] = k
    return label, best


def projected(rows: DataFrame, simplex: Simplex) -> DataFrame:
    """(vec_id, q, apex): the distances to the pivots, computed once, as the apex they determine."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apex = simplex.apexes(_matrix(batch.column("q"), DIMENSIONS))
            yield pa.RecordBatch.from_arrays([*batch.columns, _lists(apex)], ["vec_id", "q", "apex"])

    return rows.mapInArrow(run, "vec_id long, q array<long>, apex array<double>")


def _assigned(batch: pa.RecordBatch, centers: np.ndarray, over: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    points = _matrix(batch.column("q"), DIMENSIONS)
    apex = _matrix(batch.column("apex"), over.shape[1])
    found = [
        nearest(points[k : k + _BLOCK], apex[k : k + _BLOCK], centers, over) for k in range(0, len(points), _BLOCK)
    ]
    label = np.concatenate([np.empty(0, np.int32), *(x for x, _ in found)])
    return points, label, np.concatenate([np.empty(0, np.int64), *(x for _, x in found)])


def moved(rows: DataFrame, simplex: Simplex, centers: np.ndarray) -> np.ndarray:
    """The centroids after one round: floor of the mean of their vectors, unchanged without any."""
    over = simplex.apexes(centers)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centers), DIMENSIONS + 1), np.int64)
        for batch in batches:
            points, label, _ = _assigned(batch, centers, over)
            order = np.argsort(label, kind="stable")
            found, starts, counts = np.unique(label[order], return_index=True, return_counts=True)
            if len(found):
                total[found, :DIMENSIONS] += np.add.reduceat(points[order], starts, axis=0)
                total[found, DIMENSIONS] += counts
        center, place = np.indices(total.shape).reshape(2, -1)
        columns = pa.array(center), pa.array(place), pa.array(total.ravel())
        yield pa.RecordBatch.from_arrays(list(columns), ["center", "place", "total"])

    sums = rows.mapInArrow(run, "center long, place long, total long").groupBy("center", "place")
    sums = sums.agg(F.sum(F.col("total").cast("decimal(28, 0)")).alias("total"))
    totals = [[0] * (DIMENSIONS + 1) for _ in centers]
    for r in sums.collect():  # 65 numbers for each centroid
        totals[r["center"]][r["place"]] = int(r["total"])
    after = [
        [s // t[-1] for s in t[:-1]] if t[-1] else list(map(int, center)) for t, center in zip(totals, centers, strict=True)
    ]
    return np.array(after, np.int64)


def clustered(vectors: DataFrame, count: int = CENTROIDS, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) for each kept vector."""
    spark = vectors.sparkSession
    rows = stored(quantized(vectors), "vectors")
    centers = first_centroids(rows, count)
    if not len(centers):
        rows = rows.where("false")
        centers = np.zeros((1, DIMENSIONS), np.int64)
    simplex = Simplex(centers)
    rows = stored(projected(rows, simplex), "apexes")
    for _ in range(rounds):
        centers = moved(rows, simplex, centers)
    over = simplex.apexes(centers)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, label, distance = _assigned(batch, centers, over)
            columns = [batch.column("vec_id"), pa.array(label), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    last = stored(rows.mapInArrow(run, "vec_id long, cluster int, distance long"), "clusters")
    sums = last.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38, 0)")).alias("total")).collect()
    fits = lambda n: n if n < 2**63 else None
    whole = fits(sum(int(r["total"]) for r in sums))
    told = [
        (r["cluster"], fits(int(r["total"])), whole, hashlib.sha256(",".join(map(str, centers[r["cluster"]])).encode()).hexdigest())
        for r in sums
    ]
    kinds = ("cluster", LongType()), ("cluster_inertia", LongType()), ("inertia", LongType()), ("centroid_sha256", StringType())
    # a row for each centroid
    about = spark.createDataFrame(told, StructType([StructField(n, k) for n, k in kinds]))
    about = about.withColumn("cluster", F.col("cluster").cast("int"))
    return last.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
