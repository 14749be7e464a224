"""A classifier head on precomputed features: linear layers with ReLU and dropout, log-softmax out.

Mini-batch gradients with momentum and weight decay, data-parallel: rows are dealt to
batches by a hash of their key and written once, a folder for each batch. In a step the
weights are broadcast, every task adds up the gradient over its rows of the batch, partial
sums are added by up to ``FAN`` tasks where a batch has more files, and the driver moves the
weights. Small batches need no sums: a task takes the steps of at most ``CHAIN_ROWS`` rows, one after the other,
and hands the weights on, so that a step does not cost a job. What the driver holds is the model,
whatever the number of rows. Dropout masks are hashes of (key, step, unit), so a task that is run
again drops the same units.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import scratch_table_path, ship_package

#: Tasks that add up partial sums, and rows of a batch in one file.
FAN, FILE_ROWS = 16, 65_536
#: Rows of the batches that one task takes steps over, at most; larger batches are summed over tasks.
CHAIN_ROWS = 16_384

Layers = list[tuple[np.ndarray, np.ndarray]]


def start(sizes: Sequence[int], seed: int = 0) -> Layers:
    """Weights drawn for rectified units (variance 2 / inputs), biases zero."""
    rng = np.random.default_rng(seed)
    return [(rng.standard_normal((a, b)) * math.sqrt(2 / a), np.zeros(b)) for a, b in zip(sizes, sizes[1:])]


def keep_masks(key: np.ndarray, step: int, widths: Sequence[int], dropout: float) -> list[np.ndarray]:
    """For each hidden layer rows x units: 0 with probability ``dropout``, else 1 / (1 - dropout)."""
    out = []
    for layer, width in enumerate(widths):
        with np.errstate(over="ignore"):
            x = key.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.uint64((step * 64 + layer) * 1_000_003)
            x = x + np.arange(width, dtype=np.uint64)[None, :] * np.uint64(0xD1B54A32D192ED03)
            for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
            x = x ^ (x >> np.uint64(31))
        kept = (x >> np.uint64(11)).astype(float) / (1 << 53) >= dropout
        out.append(kept / (1 - dropout))
    return out


def log_probabilities(layers: Layers, x: np.ndarray) -> np.ndarray:
    """Rows x classes, without dropout."""
    for w, b in layers[:-1]:
        x = np.maximum(x @ w + b, 0)
    return _log_softmax(x @ layers[-1][0] + layers[-1][1])


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(1, keepdims=True)
    return z - np.log(np.exp(z).sum(1, keepdims=True))


def gradient(layers: Layers, x: np.ndarray, y: np.ndarray, masks: Sequence[np.ndarray]) -> tuple[float, Layers]:
    """Summed negative log likelihood of the labels and its gradient."""
    seen = [x]
    for (w, b), m in zip(layers, masks):
        seen.append(np.maximum(seen[-1] @ w + b, 0) * m)
    log, at = _log_softmax(seen[-1] @ layers[-1][0] + layers[-1][1]), np.arange(len(y))
    loss, back = -float(log[at, y].sum()), np.exp(log)
    back[at, y] -= 1
    out = []
    for i in range(len(layers) - 1, -1, -1):
        out.append((seen[i].T @ back, back.sum(0)))
        if i:
            back = back @ layers[i][0].T * masks[i - 1] * (seen[i] > 0)
    return loss, out[::-1]


def _flat(layers: Layers) -> np.ndarray:
    return np.concatenate([a.ravel() for layer in layers for a in layer])


def _layers(flat: np.ndarray, sizes: Sequence[int]) -> Layers:
    out, at = [], 0
    for a, b in zip(sizes, sizes[1:]):
        out.append((flat[at:at + a * b].reshape(a, b), flat[at + a * b:at + a * b + b]))
        at += a * b + b
    return out


_SUMS = "part int, n long, loss double, grad binary"


def _sums(part: int, n: int, loss: float, grad: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array([part], pa.int32()), pa.array([n], pa.int64()), pa.array([loss]), pa.array([grad.tobytes()], pa.binary())],
                           names=["part", "n", "loss", "grad"])


def _total(rows: DataFrame, size: int, files: int) -> tuple[int, float, np.ndarray]:
    """Rows, loss and gradient summed over the tasks of ``rows``; with many files in two levels."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, loss, grad = 0, 0.0, np.zeros(size)
        for b in batches:
            for r in b.to_pylist():
                n, loss = n + r["n"], loss + r["loss"]
                grad += np.frombuffer(r["grad"])
        if n:
            yield _sums(0, n, loss, grad)

    if files > FAN:
        rows = rows.repartition(FAN, F.col("part") % FAN).mapInArrow(add, _SUMS)
    n, loss, grad = 0, 0.0, np.zeros(size)
    for r in rows.toLocalIterator():  # a model's size each, one after the other
        n, loss = n + r["n"], loss + r["loss"]
        grad += np.frombuffer(r["grad"])
    return n, loss, grad


@dataclass
class Head:
    """Fitted layers; ``losses`` holds the mean loss of each epoch while it was learned."""
    sizes: list[int]
    layers: Layers
    losses: list[float]

    def scores(self, df: DataFrame, features: str) -> Column:
        """Log probabilities of the classes (array<double>); null where the features are null, hold a
        null or are of another length."""
        ship_package(df.sparkSession)
        shared, size = df.sparkSession.sparkContext.broadcast(self.layers), self.sizes[0]

        @F.pandas_udf("array<double>")
        def score(x: pd.Series) -> pd.Series:
            good = x.notna()
            out = pd.Series([None] * len(x), index=x.index, dtype=object)
            if good.any():
                log = log_probabilities(shared.value, np.stack(x[good].to_numpy()).astype(float))
                out[good] = pd.Series(list(log), index=x.index[good])
            return out

        x = F.col(features).cast("array<double>")
        return score(F.when(_usable(x, size), x))


def _usable(x: Column, size: int) -> Column:
    return (F.size(x) == size) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))


def fit_head(df: DataFrame, key: str, features: str, label: str, classes: int, hidden: Sequence[int] = (128, 128), epochs: int = 10,
             batch_rows: int = 256, rate: float = 0.1, momentum: float = 0.9, decay: float = 1e-4, dropout: float = 0.5, seed: int = 0) -> Head:
    """A head of ``hidden`` layers over the numbers in ``features`` (an array) for labels 0 to ``classes`` - 1.

    Batches hold about ``batch_rows`` rows and come in another order in each epoch; a step
    moves the weights by the batch's mean gradient. Rows whose features are null, of another length than most
    (the commonest length counts) or hold a null or non-finite number, and rows whose label is null or
    none of the classes, take no part. Rows of one key fall into one batch and drop the same units.
    Without rows there is nothing to fit: an error."""
    spark = df.sparkSession
    ship_package(spark)
    x = df.select(F.xxhash64(F.lit(seed), F.col(key).cast("string")).alias("key"), F.col(label).cast("int").alias("y"),
                  F.col(features).cast("array<double>").alias("x")).where(F.col("y").between(0, classes - 1))
    length = x.where("size(x) > 0").groupBy(F.size("x").alias("k")).count().orderBy(F.desc("count"), "k").first()
    if length is None:
        raise ValueError("no labelled row with features")
    x = x.where(_usable(F.col("x"), length["k"]))
    n = length["count"]
    batches, files = max(1, round(n / batch_rows)), math.ceil(batch_rows / FILE_ROWS)
    path = scratch_table_path(spark, f"head-{uuid.uuid4().hex}")
    dealt = x.withColumn("batch", F.pmod(F.col("key"), F.lit(batches)).cast("int"))
    tasks = min(batches * files, max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    (dealt.repartition(tasks, "batch", F.pmod(F.xxhash64("key"), F.lit(files)))
     .write.partitionBy("batch").option("maxRecordsPerFile", FILE_ROWS).parquet(path))
    every = spark.read.schema("key long, y int, x array<double>, batch int").parquet(path)  # files are listed once
    there = {r["batch"]: r["n"] for r in every.groupBy("batch").agg(F.count(F.lit(1)).alias("n")).collect()}  # names of folders
    sizes = [length["k"], *hidden, classes]
    weights = _flat(start(sizes, seed))
    moving, losses, number, rng = np.zeros_like(weights), [], 0, np.random.default_rng(seed)
    for _ in range(epochs):
        seen, lost = 0, 0.0
        for part in _runs(rng.permutation(sorted(there)).tolist(), there, files):
            if files == 1 and there[part[0]] <= CHAIN_ROWS:
                shared = spark.sparkContext.broadcast((weights, moving))
                moved = every.where(F.col("batch").isin(part)).coalesce(1).mapInArrow(
                    _chain(shared, part, sizes, number, dropout, rate, momentum, decay), _MOVED).first()
                weights, moving = np.frombuffer(moved["weights"]), np.frombuffer(moved["moving"])
                count, loss = moved["n"], moved["loss"]
            else:
                shared = spark.sparkContext.broadcast(weights)
                rows = spark.read.schema("key long, y int, x array<double>").parquet(f"{path}/batch={part[0]}")
                count, loss, grad = _total(rows.mapInArrow(_step(shared, sizes, number, dropout), _SUMS), len(weights), files)
                moving = momentum * moving + grad / max(count, 1) + decay * weights
                weights = weights - rate * moving
            shared.destroy()
            seen, lost, number = seen + count, lost + loss, number + len(part)
        losses.append(lost / seen)
    return Head(sizes, _layers(weights, sizes), losses)


def _runs(order: list[int], rows: dict[int, int], files: int) -> Iterator[list[int]]:
    """Batches in their order, in runs of at most ``CHAIN_ROWS`` rows; a batch of more rows, or of several files, for itself."""
    run, held = [], 0
    for batch in order:
        if run and (files > 1 or held + rows[batch] > CHAIN_ROWS):
            yield run
            run, held = [], 0
        run.append(batch)
        held += rows[batch]
    if run:
        yield run


_MOVED = "n long, loss double, weights binary, moving binary"


def _chain(shared, part: list[int], sizes: list[int], number: int, dropout: float, rate: float, momentum: float, decay: float):
    """The task of a run of steps over the batches ``part``, in this order: the weights it ends with."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, moving = shared.value
        keys, labels, xs, of = [], [], [], []
        for b in batches:
            if len(b):
                keys.append(b.column(0).to_numpy())
                labels.append(b.column(1).to_numpy())
                xs.append(b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(b), -1))
                of.append(b.column(3).to_numpy(zero_copy_only=False))
        key, y, x, of = (np.concatenate(c) for c in (keys, labels, xs, of))
        lost = 0.0
        for i, batch in enumerate(part):
            on = of == batch
            some, grads = gradient(_layers(weights, sizes), x[on], y[on], keep_masks(key[on], number + i, sizes[1:-1], dropout))
            moving = momentum * moving + _flat(grads) / int(on.sum()) + decay * weights
            weights, lost = weights - rate * moving, lost + some
        yield pa.record_batch([pa.array([len(of)], pa.int64()), pa.array([lost]), pa.array([weights.tobytes()], pa.binary()),
                               pa.array([moving.tobytes()], pa.binary())], names=["n", "loss", "weights", "moving"])

    return work


def _step(shared, sizes: list[int], number: int, dropout: float):
    """The task of a step: one row of sums over its rows of the batch."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layers = _layers(shared.value, sizes)
        n, loss, grad = 0, 0.0, np.zeros(len(shared.value))
        for b in batches:
            if not len(b):
                continue
            x = b.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(b), -1)
            some, parts = gradient(layers, x, b.column(1).to_numpy(), keep_masks(b.column(0).to_numpy(), number, sizes[1:-1], dropout))
            n, loss = n + len(b), loss + some
            grad += _flat(parts)
        if n:
            yield _sums(TaskContext.get().partitionId(), n, loss, grad)

    return work
