"""Centroid clustering of integer vectors by a bisector tournament.

For centroids i < j the nearer one is told by the sign of one linear function:
a vector v is nearer to j exactly when v . 2(c_j - c_i) > |c_j|^2 - |c_i|^2. The
integer normals and thresholds of all pairs are worked out once a round. A
vector's champion starts as centroid 0 and meets 1, 2, ... in turn; each of the
k - 1 tests eliminates one of the two, and a test of zero (a tie) keeps the
smaller number. Only the winner's distance is computed, exactly.

The vectors are written once as integers. A round is one scan: every task assigns
its vectors and keeps one count and one sum for each centroid, Spark adds them
up, and the driver gets k sums, however many vectors there are and however many
of them one centroid has.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import prepare, written
from tidemark.llm.vectors import matrix, scaled, vector_sums, whole

DIM, SCALE, CLUSTERS, ROUNDS, SEED = 64, 1024, 8, 10, 3


class Tournament:
    """Normals and thresholds of all centroid pairs, and the k - 1 tests that find the nearest centroid."""

    def __init__(self, centroids: np.ndarray):
        c = np.asarray(centroids, np.int64)
        self.centroids = c
        norms = (c * c).sum(1)
        self.normal = 2 * (c[None, :, :] - c[:, None, :])  # [i, j]: towards j
        self.threshold = norms[None, :] - norms[:, None]
        self.steepest = int(np.abs(self.normal).max(initial=0))

    def winners(self, v: np.ndarray) -> np.ndarray:
        """Number of the nearest centroid of each row."""
        # products are sums of integers: doubles give the same as long as every partial sum is below 2^53
        small = v.shape[1] * self.steepest * int(np.abs(v).max(initial=0)) < 1 << 53
        kind = np.float64 if small else np.int64
        rows, normal = v.astype(kind), self.normal.astype(kind)
        champion = np.zeros(len(v), np.int64)
        for j in range(1, len(self.centroids)):
            before = champion.copy()
            for i in np.unique(before):
                who = np.flatnonzero(before == i)
                champion[who[rows[who] @ normal[i, j] > self.threshold[i, j]]] = j
        return champion

    def distances(self, v: np.ndarray, number: np.ndarray) -> np.ndarray:
        gap = v - self.centroids[number]
        return (gap * gap).sum(1)


def integer_vectors(vectors: DataFrame, dim: int = DIM, scale: int = SCALE, id_col: str = "vec_id",
                    vec_col: str = "embedding") -> DataFrame:
    """``id`` (long), ``v`` (int array) of the vectors with exactly ``dim`` components, none null or non-finite."""
    v = F.col(vec_col)
    return vectors.where(whole(v) & (F.size(v) == dim)).select(F.col(id_col).cast("long").alias("id"), scaled(v, scale).alias("v"))


def first_centroids(kept: DataFrame, k: int = CLUSTERS, seed: int = SEED) -> np.ndarray:
    """The ``k`` vectors with the smallest lowercase-hex sha256 of ``seed:id``, in that order (ties by
    components). Vectors without an id start no cluster."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = kept.where(F.col("id").isNotNull()).orderBy(order, "v").limit(k).select("v").collect()
    return np.array([r["v"] for r in rows], np.int64)


def _sums(kept: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Count and componentwise sum of each centroid's vectors."""
    k, dim = centroids.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told, n, s = Tournament(centroids), np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for b in batches:
            v = matrix(b.column(0))
            if not len(v):
                continue
            number = told.winners(v)
            n += np.bincount(number, minlength=k)
            for i in np.unique(number):
                s[i] += v[number == i].sum(0)
        used = np.flatnonzero(n)
        yield pa.record_batch([pa.array(used, pa.int32()), pa.array(n[used]), pa.array(s[used].tolist(), pa.list_(pa.int64()))],
                              names=["cluster", "n", "s"])

    return vector_sums(kept.select("v").mapInArrow(work, "cluster int, n long, s array<long>"), ["cluster"], dim)


def fit(kept: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    """Centroids after ``rounds`` rounds over ``integer_vectors``: each non-empty one becomes the floor of
    the exact mean of its vectors, empty ones stay. Fewer vectors than ``k`` give fewer centroids."""
    prepare(kept.sparkSession)
    centroids = first_centroids(kept, k, seed)
    for _ in range(rounds if len(centroids) else 0):
        before = centroids
        centroids = before.copy()
        for r in _sums(kept, before).collect():  # k rows
            centroids[r["cluster"]] = np.array(r["s"], np.int64) // r["n"]
        if (centroids == before).all():
            break  # every further round would give the same
    return centroids


def assign(kept: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``id``, ``cluster`` (int), ``distance`` (long, squared) of every vector."""
    prepare(kept.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = Tournament(centroids)
        for b in batches:
            v = matrix(b.column(1))
            number = told.winners(v) if len(v) else np.zeros(0, np.int64)
            far = told.distances(v, number) if len(v) else number
            yield pa.record_batch([b.column(0), pa.array(number, pa.int32()), pa.array(far, pa.int64())], names=["id", "cluster", "distance"])

    return kept.select("id", "v").mapInArrow(work, "id long, cluster int, distance long")


def cluster(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: int = SEED,
            id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per kept vector: the id column, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``
    (distance summed over the cluster and over all) and ``centroid`` (array of long).

    Vectors that are null, have another length than ``dim`` or hold null or
    non-finite components are left out. A repeated row is clustered and
    counted each time; a vector with a null id is clustered, but starts no
    cluster. Ties go to the smaller number. No kept vector with an id: an empty
    result. Only the two named columns are read.
    """
    spark = vectors.sparkSession
    kept = written(integer_vectors(vectors, dim, scale, id_col, vec_col), "integers")
    centroids = fit(kept, k, rounds, seed)
    out = f"`{id_col}` long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>"
    if not len(centroids):
        return spark.createDataFrame([], out)
    found = written(assign(kept, centroids), "assigned")
    inertia = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    facts = spark.createDataFrame([(i, int(inertia[i]), int(sum(inertia.values())), centroids[i].tolist()) for i in inertia],
                                  "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return (found.join(F.broadcast(facts), "cluster")  # k rows
            .select(F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid"))


def centroid_digest(centroid: np.ndarray) -> str:
    """Lowercase hex sha256 of the components in decimal, joined by commas."""
    return hashlib.sha256(",".join(map(str, np.asarray(centroid).tolist())).encode()).hexdigest()
