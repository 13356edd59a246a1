"""Centroid clustering whose nearest-centroid search is the threshold algorithm.

Per dimension the centroids are listed in the order of their values. For a vector every list is
walked outward from the vector's value, nearest first, one step in all lists at a time. A
centroid met for the first time gets its exact distance. What has not been met yet is at least as
far in every dimension as the walk has come, so once the sum of the squared frontier distances is
strictly above the best exact distance, no other centroid can be nearer or as near, and the walk
ends. All numbers are whole, so every distance and mean is exact and the order of sums is of no matter.

Each round is one pass over the settled vectors: tasks send sums per centroid, and as many numbers
as the centroids have come to the driver. Centroids are the only thing handed to all tasks: a
given number of rows.

Vectors that are NULL, of another length, or hold a NULL or non-finite component are left out.
Equal distances go to the smaller number; equal starting hashes (repeated ids) are ordered by the
vector. A NULL id counts as an empty text when the starts are drawn. Repeated rows each count;
repeated starts are centroids of their own, of which the later ones stay empty. Fewer vectors than
centroids: all are starts. An empty table gives no rows. Other columns are not looked at.
Components beyond 131,071 either way stop the query with an error.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from herald.llm.vectors import WORK_BYTES, finite, floors, matrix
from herald.scale import settle

#: Keeps a squared distance over a few hundred dimensions within 64 bits.
MOST = 1 << 27
_FAR = np.iinfo(np.int64).max >> 1


class SortedLists:
    """Centroids (k x d whole numbers), listed by value in every dimension."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.numbers = np.argsort(centroids, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(centroids.T, self.numbers, axis=1)
        k, d = centroids.shape
        self.rows = max(1, WORK_BYTES // (8 * d * min(k, d)))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Number and squared distance of the nearest centroid of each row, and how many exact
        distances that took."""
        parts = [self._nearest(x[i:i + self.rows]) for i in range(0, len(x), self.rows)]
        if not parts:
            return np.empty(0, np.int64), np.empty(0, np.int64), 0
        who, best, exact = zip(*parts)
        return np.concatenate(who), np.concatenate(best), sum(exact)

    def _nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        k, d = self.centroids.shape
        dim = np.arange(d)
        right = np.stack([np.searchsorted(self.values[j], x[:, j]) for j in range(d)], axis=1)
        left = right - 1
        who, best = np.full(len(x), k), np.full(len(x), _FAR)
        met = np.zeros((len(x), k), bool)
        rows, exact = np.arange(len(x)), 0
        while len(rows):
            at = x[rows]
            before = np.where(left >= 0, at - self.values[dim, np.maximum(left, 0)], _FAR)
            after = np.where(right < k, self.values[dim, np.minimum(right, k - 1)] - at, _FAR)
            back = before <= after
            frontier = np.where(back, before, after)
            place = np.where(back, left, right)
            left, right = left - back, right + ~back
            fresh = np.zeros((len(rows), k), bool)
            fresh[np.arange(len(rows))[:, None], self.numbers[dim, place]] = True
            fresh &= ~met[rows]
            met[rows] |= fresh
            i, c = np.nonzero(fresh)
            exact += len(i)
            found = np.full(fresh.shape, _FAR)
            found[i, c] = np.square(at[i] - self.centroids[c]).sum(1)
            number = found.argmin(1)
            value = found[np.arange(len(rows)), number]
            better = (value < best[rows]) | ((value == best[rows]) & (number < who[rows]))
            who[rows[better]], best[rows[better]] = number[better], value[better]
            on = (np.square(frontier).sum(1) <= best[rows]) & ~met[rows].all(1)
            rows, left, right = rows[on], left[on], right[on]
        return who, best, exact


def kept_vectors(df: DataFrame, dims: int, scale: int) -> DataFrame:
    vector = F.col("embedding")
    rows = df.select(F.col("vec_id").cast("bigint").alias("vec_id"), vector.alias("vector"))
    rows = rows.filter(finite(F.col("vector")) & (F.size("vector") == dims))
    return rows.select("vec_id", floors(F.col("vector"), scale, MOST).alias("x"))


def starts(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    ident = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = rows.orderBy(F.sha2(ident, 256), "x").limit(k).collect()
    return np.array([r.x for r in first], np.int64)


def _sums(rows: DataFrame, lists: SortedLists) -> DataFrame:
    k, d = lists.centroids.shape

    def add(batches):
        total, size = np.zeros((k, d), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            x = matrix(batch.column("x"), d, np.int64)
            who, _, _ = lists.nearest(x)
            size += np.bincount(who, minlength=k)
            np.add.at(total, who, x)
        have = np.flatnonzero(size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(have, pa.int32()), pa.array(size[have]),
             pa.array(total[have].tolist(), pa.list_(pa.int64()))], ["cluster", "size", "sums"])

    parts = rows.select("x").mapInArrow(add, "cluster int, size long, sums array<long>")
    each = parts.select("cluster", "size", F.posexplode("sums").alias("dim", "total"))
    return each.groupBy("cluster", "dim").agg(
        F.sum("size").alias("size"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))


def moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The next centroids: the mean of each one's vectors, rounded down; empty ones stay."""
    out = centroids.copy()
    for r in _sums(rows, SortedLists(centroids)).collect():  # a number per centroid and dimension
        out[r.cluster, r.dim] = int(r.total) // r["size"]
    return out


def assigned(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance): the nearest centroid of every vector."""
    lists = SortedLists(centroids)
    d = centroids.shape[1]

    def assign(batches):
        for batch in batches:
            who, best, _ = lists.nearest(matrix(batch.column("x"), d, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(who, pa.int32()), pa.array(best)],
                ["vec_id", "cluster", "distance"])

    return rows.mapInArrow(assign, "vec_id long, cluster int, distance long")


def fit(rows: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3) -> np.ndarray:
    """Final centroids of settled rows (vec_id, x)."""
    centroids = starts(rows, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(rows, centroids)
    return centroids


SCHEMA = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>"


def cluster(df: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024,
            seed: int = 3) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid) of every vector kept."""
    spark = df.sparkSession
    rows = settle(kept_vectors(df, dims, scale), "vectors")
    centroids = fit(rows, k, rounds, seed)
    if not len(centroids):
        return spark.createDataFrame([], SCHEMA)
    result = settle(assigned(rows, centroids), "clusters")
    sums = result.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum"))
    inertia = {r.cluster: int(r["sum"]) for r in sums.collect()}  # a row per centroid
    about = spark.createDataFrame(
        [(c, n, sum(inertia.values()), centroids[c].tolist()) for c, n in inertia.items()],
        "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return result.join(F.broadcast(about), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")


def digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()
