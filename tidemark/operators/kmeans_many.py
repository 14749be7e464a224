"""k-means for many numbers of clusters at once.

Every model (each k, with restarts) is refined by the same scans: a scan assigns
each row to its nearest centre in all models that still move, every task keeps one
count, one sum and one cost for each centre, and Spark adds them up. A sweep over
k so costs as many scans as its slowest model has rounds, not the sum over all
models. Centres start by k-means++ on a bounded sample; only centres and
their sums are on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import ship_package

#: Rows that the first centres are chosen from, at most; rows that a task compares with all centres at once.
SAMPLE, _BLOCK = 10_000, 4096


@dataclass
class Model:
    centres: np.ndarray
    cost: float = float("inf")
    moving: bool = True


def _start(points: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means++: each further centre with a probability in proportion to its squared distance from those there.
    With no distance left, points come again."""
    chosen = [points[rng.integers(len(points))]]
    far = ((points - chosen[0]) ** 2).sum(1)
    for _ in range(k - 1):
        total = far.sum()
        i = rng.choice(len(points), p=far / total) if total > 0 else rng.integers(len(points))
        chosen.append(points[i])
        far = np.minimum(far, ((points - points[i]) ** 2).sum(1))
    return np.array(chosen)


def _points(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _scan(rows: DataFrame, models: list[np.ndarray]) -> dict[tuple[int, int], tuple[int, float, np.ndarray]]:
    """By (model, centre): count, summed squared distance and summed vectors of the rows nearest to it."""
    starts = np.cumsum([0] + [len(c) for c in models])
    centres = np.concatenate(models)
    dim = centres.shape[1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, cost, s = np.zeros(len(centres), np.int64), np.zeros(len(centres)), np.zeros((len(centres), dim))
        norms, twice = (centres ** 2).sum(1)[:, None], 2 * centres
        # a model at a time, its distances in one buffer that stays in the cache: rows x all centres would not
        room = np.empty(max(len(c) for c in models) * _BLOCK)
        for b in batches:
            for a in range(0, len(b), _BLOCK):
                x = np.ascontiguousarray(_points(b.column(0).slice(a, _BLOCK)).T)
                far, gap = np.empty(x.shape[1]), np.empty(x.shape[1])
                for m, own in enumerate(models):
                    of, k = slice(starts[m], starts[m + 1]), len(own)
                    near = room[:k * x.shape[1]].reshape(k, -1)
                    np.matmul(twice[of], x, out=near)
                    at = np.subtract(norms[of], near, out=near).argmin(0)  # the row's own norm is the same for all centres
                    n[of] += np.bincount(at, minlength=k)
                    far[:] = 0
                    for j in range(dim):
                        s[of, j] += np.bincount(at, x[j], k)
                        np.subtract(x[j], own[at, j], out=gap)
                        far += np.multiply(gap, gap, out=gap)
                    cost[of] += np.bincount(at, far, k)
        used = np.flatnonzero(n)
        yield pa.record_batch([pa.array(used.astype(np.int32)), pa.array(n[used]), pa.array(cost[used]),
                               pa.array(s[used].tolist(), pa.list_(pa.float64()))], names=["centre", "n", "cost", "s"])

    parts = rows.mapInArrow(work, "centre int, n long, cost double, s array<double>")
    sums = parts.groupBy("centre").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"),
                                       F.array(*[F.sum(F.col("s")[j]) for j in range(dim)]).alias("s"))
    out = {}
    for r in sums.collect():  # a row per centre
        m = int(np.searchsorted(starts, r["centre"], "right")) - 1
        out[m, r["centre"] - int(starts[m])] = (r["n"], r["cost"], np.array(r["s"]))
    return out


def kmeans_many(df: DataFrame, ks: Sequence[int], features: str = "features", restarts: int = 3, max_iter: int = 20,
                tol: float = 1e-4, seed: int = 42) -> dict[int, Model]:
    """For each k the cheapest of ``restarts`` models: its centres and its cost, the summed squared distance of
    all rows to their nearest centres. ``df`` should be written or persisted: it is read once for each
    round of all models together, and once more for the costs. A centre without rows stays. An empty
    table gives models without centres, of cost 0."""
    ship_package(df.sparkSession)
    rows = df.select(vector_to_array(features).alias("x"))
    n = rows.count()
    if not n:
        return {k: Model(np.zeros((0, 0)), 0.0, False) for k in ks}
    sample = rows.sample(min(1.0, 1.2 * SAMPLE / n), seed) if n > SAMPLE else rows
    points = np.array([r["x"] for r in sample.limit(SAMPLE).collect()])
    rng = np.random.default_rng(seed)
    models = [Model(_start(points, k, rng)) for k in ks for _ in range(restarts)]
    for _ in range(max_iter):
        moving = [m for m in models if m.moving]
        if not moving:
            break
        sums = _scan(rows, [m.centres for m in moving])
        moved = [m.centres.copy() for m in moving]
        for (i, j), (count, _, s) in sums.items():
            moved[i][j] = s / count
        for m, new in zip(moving, moved):
            m.moving = bool((((new - m.centres) ** 2).sum(1) > tol * tol).any())
            m.centres = new
    costs = _scan(rows, [m.centres for m in models])
    for i, m in enumerate(models):
        m.cost = sum(cost for (at, _), (_, cost, _) in costs.items() if at == i)
    return {k: min(models[i * restarts:(i + 1) * restarts], key=lambda m: m.cost) for i, k in enumerate(ks)}
