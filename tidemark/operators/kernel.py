"""Support vectors with a Gaussian kernel by random Fourier features.

MLlib's support vector classifier is linear. The kernel exp(-gamma |x - y|^2) is the mean of
cos(w.x + b) cos(w.y + b) * 2 over random directions w (normal, variance 2 gamma) and phases b, so
a linear classifier on ``size`` such cosines is one in the kernel's space, up to an error that
falls with the root of ``size``. The constants are fixed by a seed; tasks compute the cosines block by block with numpy.

``KernelSVC`` is MLlib's linear classifier over these cosines that never keeps them: MLlib's own fit keeps the standardised
vectors of all rows in memory and on disk, 2 KB a row for 256 features. Here each task computes the cosines of its rows
anew for each step, adds up loss and gradient, and only these sums leave it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import ship_package, written_table

#: Rows whose features are computed at once.
_ROWS = 1024


@dataclass(frozen=True)
class FourierMap:
    """Directions (size x dim) and phases of a kernel of width ``gamma``."""
    directions: tuple[tuple[float, ...], ...]
    phases: tuple[float, ...]

    def column(self, x: Column) -> Column:
        """The features of an array<double> column as an array: sqrt(2 / size) cos(w.x + b). A null array, or one that
        holds a null or is of another length, has null features."""
        return self._mapped()(x)

    def _mapped(self):
        w, b = np.array(self.directions), np.array(self.phases)
        scale = (2.0 / len(b)) ** 0.5

        @F.arrow_udf("array<double>")
        def mapped(x: pa.Array) -> pa.Array:
            out = []
            for at in range(0, len(x), _ROWS):
                part = x.slice(at, _ROWS)
                length, nulls = pc.list_value_length(part), pc.list_parent_indices(part).filter(pc.list_flatten(part).is_null())
                good = pc.fill_null(pc.equal(length, w.shape[1]), False).to_numpy(zero_copy_only=False).copy()
                good[nulls.to_numpy()] = False
                rows = part.filter(pa.array(good)).flatten().to_numpy(zero_copy_only=False).reshape(-1, w.shape[1])
                z = np.zeros((len(rows), len(b)))
                for j in range(w.shape[1]):  # component after component: sums do not depend on the block's size
                    z += rows[:, j:j + 1] * w[:, j]
                with np.errstate(invalid="ignore"):
                    z = np.cos(z + b) * scale
                values, known = np.zeros((len(part), len(b))), np.repeat(good, len(b))
                values[good] = z
                starts = np.arange(len(part) + 1, dtype=np.int32) * len(b)
                out.append(pa.ListArray.from_arrays(pa.array(starts), pa.array(values.ravel(), mask=~known)))
            return pa.concat_arrays(out) if out else pa.array([], pa.list_(pa.float64()))

        return mapped

    def transform(self, df: DataFrame, features: str = "features", out: str = "kernel_features") -> DataFrame:
        """``df`` with the vector column ``out``; ``features`` is a vector column."""
        return df.withColumn(out, array_to_vector(self.column(vector_to_array(F.col(features)))))


def fourier_map(dim: int, size: int = 128, gamma: float = 0.1, seed: int = 42) -> FourierMap:
    """Constants of ``size`` features for vectors of ``dim`` components."""
    rng = np.random.default_rng(seed)
    w = rng.standard_normal((size, dim)) * (2.0 * gamma) ** 0.5
    b = rng.uniform(0.0, 2.0 * np.pi, size)
    return FourierMap(tuple(map(tuple, w.round(12).tolist())), tuple(b.round(12).tolist()))


#: Terms of cos(r) = 1 - r^2 / 2! + r^4 / 4! - ..., last first: to 1e-15 up to a quarter turn.
_TERMS = [(-1.0) ** i / math.factorial(2 * i) for i in range(11)][::-1]


def cosines(y: np.ndarray) -> np.ndarray:
    """``np.cos`` in place, to 1e-14 at moderate angles: five times as fast, since each step runs over the whole block."""
    half = np.rint(y * (1 / np.pi))
    y -= half * np.pi
    half *= 0.5
    half -= np.floor(half)  # 0.5 where an odd number of half turns was taken off
    y *= y
    out = np.full_like(y, _TERMS[0])
    for t in _TERMS[1:]:
        out *= y
        out += t
    out *= 1 - 4 * half
    return out


#: Sums of up to so many tasks are added up by the driver, those of more by 16 tasks first.
_DIRECT = 256
#: Rows whose sums are made at once: their cosines stay in a core's cache.
_BLOCK = 128


def _sums(rows: DataFrame, length: int, add: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> np.ndarray:
    """``add(x, label)`` of all blocks of rows (x array<double>, label double), summed up."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for b in batches:
            for at in range(0, len(b), _BLOCK):
                part = b.slice(at, _BLOCK)
                x = part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(part), -1)
                total += add(x, part.column(1).to_numpy(zero_copy_only=False))
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["s"])

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for b in batches:
            for s in b.column(0):
                total += np.frombuffer(s.as_py())
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], names=["s"])

    found = rows.mapInArrow(work, "s binary")  # one sum for each task
    if rows.rdd.getNumPartitions() > _DIRECT:
        found = found.repartition(16).mapInArrow(together, "s binary")
    found = found.collect()
    return np.sum([np.frombuffer(r["s"]) for r in found], axis=0)


class _LineSearchFailed(Exception):
    pass


def _ahead(alpha: float, shrink: float) -> list[float]:
    """A step and those that may be asked for after it."""
    up = [alpha, alpha * 2.1, alpha * 2.1 * 2.1, alpha * 2.1 * 2.1 * 2.1]
    return [*up, *(a * shrink for a in up[:3]), alpha * shrink * shrink]


def _step_length(f: Callable[[float], tuple[float, float]], value: float, slope: float, start: float, shrink: float) -> float:
    """Backtracking to a step that lowers the value enough and flattens its slope (Breeze's rules, as MLlib's optimiser:
    it takes the first step as one that lowers nothing, so that it is shrunk unseen)."""
    alpha = start * shrink
    for _ in range(20):
        now, to = f(alpha)
        if now > value + alpha * slope * 1e-4:
            by = shrink
        elif to < 0.9 * slope:
            by = 2.1
        elif to > -0.9 * slope:
            by = shrink
        else:
            return alpha
        alpha *= by
        if not 1e-10 <= alpha <= 1e10:
            break
    raise _LineSearchFailed


def _descent(memory: list[tuple[np.ndarray, np.ndarray]], grad: np.ndarray) -> np.ndarray:
    """The direction of L-BFGS from the last steps and what they changed the gradient by, latest first."""
    out, along = grad.copy(), []
    for s, y in memory:
        along.append((s @ out) / (s @ y))
        out -= along[-1] * y
    if memory:
        s, y = memory[0]
        out *= (s @ y) / (y @ y)
    for (s, y), a in zip(reversed(memory), reversed(along)):
        out += (a - (y @ out) / (s @ y)) * s
    return np.where(out * grad > 0, -out, 0.0)


def minimise(f: Callable[[list[np.ndarray]], list[tuple[float, np.ndarray]]], x: np.ndarray, max_iter: int, tol: float = 1e-6, kept: int = 10) -> np.ndarray:
    """The orthant-wise L-BFGS that MLlib's support vectors take (without an L1 term): no component passes zero within a step.
    ``f`` gives value and gradient at several points in one go."""
    value, grad = f([x])[0]
    first, values, memory, failed, at = value, [value], [], False, 0
    while at < max_iter and np.linalg.norm(grad) > max(tol * abs(value), 1e-8) and (len(values) < 20 or abs(value - max(values)) > tol * abs(first)):
        way = _descent(memory, grad)
        side = np.where(x != 0, np.sign(x), np.sign(-grad))
        shrink, start = (0.5, 1.0) if at else (0.1, 0.5 / np.linalg.norm(grad))
        seen: dict[float, tuple[np.ndarray, float, np.ndarray]] = {}

        def along(alpha: float, x=x, way=way, side=side, seen=seen, shrink=shrink) -> tuple[float, float]:
            if alpha not in seen:
                steps = [a for a in _ahead(alpha, shrink) if a not in seen]
                to = [x + a * way for a in steps]
                to = [np.where(np.sign(t) == side, t, 0.0) for t in to]
                seen.update((a, (t, *found)) for a, t, found in zip(steps, to, f(to)))
            return seen[alpha][1], float(seen[alpha][2] @ way)

        try:
            to, value, new = seen[_step_length(along, value, float(grad @ way), start, shrink)]
        except _LineSearchFailed:
            if failed:
                break
            memory, failed = [], True
            continue
        memory = [(to - x, new - grad), *memory][:kept]
        x, grad, at, failed = to, new, at + 1, False
        values = [*values, value][-20:]
    return x


@dataclass(frozen=True)
class KernelSVC:
    """MLlib's ``LinearSVC`` (hinge loss, standardised features, an intercept, no penalty) over the cosines of ``kernel``."""
    kernel: FourierMap
    featuresCol: str = "features"
    labelCol: str = "label"
    maxIter: int = 100
    tol: float = 1e-6

    def fit(self, train: DataFrame) -> KernelSVCModel:
        """``train`` is read once for the deviations and about once for each step; it should be written."""
        spark = train.sparkSession
        ship_package(spark)
        rows = train.select(vector_to_array(F.col(self.featuresCol)).alias("x"), F.col(self.labelCol).cast("double").alias("label"))
        cores = spark.sparkContext.defaultParallelism
        if rows.rdd.getNumPartitions() < cores:  # small files: a task for each core
            rows = written_table(rows.repartition(cores), "kernel-rows")
        w, b = np.array(self.kernel.directions).T, np.array(self.kernel.phases)
        size, scale = len(b), (2.0 / len(b)) ** 0.5

        def moments(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            z = cosines(x @ w + b) * scale
            return np.r_[len(z), z.sum(0), (z * z).sum(0)]

        sums = _sums(rows, 1 + 2 * size, moments)
        n = sums[0]
        if not n:
            raise ValueError("no rows to fit")
        deviation = np.sqrt(np.maximum(sums[1 + size:] - sums[1:1 + size] ** 2 / n, 0) / max(n - 1, 1))
        inverse = np.where(deviation > 0, 1 / np.where(deviation > 0, deviation, 1), 0.0)
        middle = sums[1:1 + size] / n * inverse  # features are centred while fitted

        def loss(points: list[np.ndarray]) -> list[tuple[float, np.ndarray]]:
            weight = np.stack([beta[:-1] * inverse * scale for beta in points], 1)
            intercept = np.array([beta[-1] - middle @ beta[:-1] for beta in points])

            def add(x: np.ndarray, y: np.ndarray) -> np.ndarray:
                z, sign = cosines(x @ w + b), (2 * y - 1)[:, None]
                short = 1 - sign * (z @ weight + intercept)
                on = np.where(short > 0, -sign, 0.0)
                return np.concatenate([np.maximum(short, 0).sum(0)[:, None], on.T @ z, on.sum(0)[:, None]], 1).ravel()

            got = _sums(rows, len(points) * (size + 2), add).reshape(len(points), -1) / n
            return [(float(g[0]), np.r_[g[1:-1] * inverse * scale - middle * g[-1], g[-1]]) for g in got]

        beta = minimise(loss, np.zeros(size + 1), self.maxIter, self.tol)
        return KernelSVCModel(self.kernel, tuple((beta[:-1] * inverse).tolist()), float(beta[-1] - middle @ beta[:-1]), self.featuresCol)


@dataclass(frozen=True)
class KernelSVCModel:
    """Coefficients of the kernel's features, and an intercept."""
    kernel: FourierMap
    coefficients: tuple[float, ...]
    intercept: float
    featuresCol: str = "features"

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``margin`` and ``prediction`` (1 above 0); both null where the features are."""
        ship_package(df.sparkSession)
        w, b = np.array(self.kernel.directions).T, np.array(self.kernel.phases)
        weight, intercept = np.array(self.coefficients) * (2.0 / len(b)) ** 0.5, self.intercept

        @F.arrow_udf("double")
        def margin(x: pa.Array) -> pa.Array:
            known, out = x.is_valid().to_numpy(zero_copy_only=False), np.zeros(len(x))
            rows = x.drop_null().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(w))
            out[known] = np.concatenate([np.zeros(0), *(cosines(rows[a:a + _ROWS] @ w + b) @ weight + intercept for a in range(0, len(rows), _ROWS))])
            return pa.array(out, mask=~known)

        return (df.withColumn("margin", margin(vector_to_array(F.col(self.featuresCol))))
                .withColumn("prediction", (F.col("margin") > 0).cast("double")))
