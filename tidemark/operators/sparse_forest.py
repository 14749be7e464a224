"""A random forest for classes that reads only the numbers of a row that are not zero.

MLlib's forest bins a row into an array as long as its vector and keeps all of them: texts over 2^18 terms take a
megabyte each. Here rows are kept in blocks that list, for each feature, the rows where it is not zero, so what is
held grows with the terms of the texts. The trees are MLlib's: bootstrapped rows (Poisson weights), the square root
of the features drawn anew for each node, cuts by a bounded sample of rows, Gini impurity, least rows of a child.

All trees grow together. In a pass every task sends its rows down the trees as they are and counts classes by (node,
drawn feature, bin) for as many open nodes as ``PASS_COUNTS`` allows; the zeros are what is missing from a node's
total. The counts are added up by slices of nodes, each slice finds its best cuts, and only these reach the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import ship_package

#: Rows of a block, counts that a task holds in a pass, entries looked at in one go, counts of a slice that are added up.
BLOCK_ROWS, PASS_COUNTS, ENTRIES, SLICE_COUNTS = 4096, 1 << 24, 1 << 20, 1 << 20
#: Rows whose values the cuts are chosen by, at least (MLlib's number).
CUT_ROWS = 10_000


def sparse(features: str) -> list[Column]:
    """Indices and values of a vector column; a dense vector lists all its numbers."""
    v = F.unwrap_udt(features)
    every = F.when(F.size(v["values"]) > 0, F.sequence(F.lit(0), F.size(v["values"]) - 1)).otherwise(F.expr("CAST(array() AS ARRAY<INT>)"))
    return [F.coalesce(v["indices"], every).alias("indices"), v["values"].alias("values")]


@dataclass
class Cuts:
    """Cuts of all features, one after the other: those of feature f are ``at[start[f]:start[f + 1]]``, rising."""
    start: np.ndarray
    at: np.ndarray

    @property
    def number(self) -> np.ndarray:
        return np.diff(self.start)

    def bins(self, feature: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many cuts of its feature lie below each value."""
        out, first, n = np.zeros(len(feature), np.uint8), self.start[feature], self.number[feature]
        left = np.flatnonzero(n)
        j = 0
        while len(left):
            below = self.at[first[left] + j] < value[left]
            out[left[below]] += 1
            j += 1
            left = left[below & (n[left] > j)]
        return out


def choose_cuts(values: np.ndarray, counts: np.ndarray, most: int) -> list[float]:
    """At most ``most`` cuts between distinct rising values, with about equal counts between them."""
    between = (values[:-1] + values[1:]) / 2
    if len(between) <= most:
        return between.tolist()
    step, out, aim = counts.sum() / (most + 1), [], counts.sum() / (most + 1)
    so_far = np.cumsum(counts)
    for i in range(1, len(values)):
        if abs(so_far[i - 1] - aim) < abs(so_far[i] - aim):
            out.append(float(between[i - 1]))
            aim += step
    return out


@dataclass
class Block:
    """Rows by feature: ``rows`` and ``bins`` of feature f at ``start[f]:start[f + 1]``, where f has cuts and is not zero."""
    key: int
    n: int
    start: np.ndarray
    rows: np.ndarray
    bins: np.ndarray
    labels: np.ndarray

    def entries(self, features: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For ``features`` (one may come again) the position in it and in the block of every entry, a run at a time."""
        first = self.start[features]
        n = self.start[features + 1] - first
        ends, at = np.cumsum(n), 0
        while at < len(features):
            before = int(ends[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(ends, before + ENTRIES, "right")))
            k = n[at:end]
            yield np.repeat(np.arange(at, end), k), np.arange(int(k.sum())) + np.repeat(first[at:end] - (ends[at:end] - k - before), k)
            at = end


def make_block(key: int, lengths: np.ndarray, indices: np.ndarray, values: np.ndarray, labels: np.ndarray, cuts: Cuts) -> Block:
    rows = np.repeat(np.arange(len(lengths), dtype=np.uint16), lengths)
    useful = (values != 0) & (cuts.number[indices] > 0)
    indices, values, rows = indices[useful], values[useful], rows[useful]
    order = np.argsort(indices, kind="stable")
    indices = indices[order]
    start = np.searchsorted(indices, np.arange(len(cuts.start)))
    return Block(key, len(lengths), start, rows[order], cuts.bins(indices, values[order]), labels)


@dataclass
class Trees:
    """Nodes of all trees, roots first; ``feature`` is -1 at a leaf, a row goes left up to bin ``cut``, the right
    child follows the left one. ``counts``: bootstrapped rows of each class."""
    tree: np.ndarray
    depth: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    counts: np.ndarray

    @staticmethod
    def roots(number: int, classes: int) -> Trees:
        return Trees(np.arange(number, dtype=np.int32), np.zeros(number, np.int32), np.full(number, -1, np.int32), np.zeros(number, np.int32),
                     np.zeros(number, np.int32), np.zeros((number, classes), np.int64))

    def grow(self, parents: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray, right: np.ndarray) -> Trees:
        """With two children for each of ``parents``."""
        n, k = len(self.tree), len(parents)
        f, c, at = self.feature.copy(), self.cut.copy(), self.left.copy()
        f[parents], c[parents], at[parents] = feature, cut, n + 2 * np.arange(k)
        new = np.repeat(self.tree[parents], 2), np.repeat(self.depth[parents] + 1, 2)
        return Trees(np.r_[self.tree, new[0]], np.r_[self.depth, new[1]], np.r_[f, np.full(2 * k, -1, np.int32)], np.r_[c, np.zeros(2 * k, np.int32)],
                     np.r_[at, np.zeros(2 * k, np.int32)], np.r_[self.counts, np.stack([left, right], 1).reshape(2 * k, self.counts.shape[1])])

    def reached(self, block: Block, zero: np.ndarray) -> np.ndarray:
        """Trees x rows: the node where each row ends. ``zero``: the bin of 0 for each feature."""
        number = int((self.depth == 0).sum())
        at = np.repeat(np.arange(number, dtype=np.int32)[:, None], block.n, 1)
        for d in range(int(self.depth.max()) + 1):
            nodes = np.flatnonzero((self.feature >= 0) & (self.depth == d))
            if not len(nodes):
                break
            moves = np.arange(len(self.tree), dtype=np.int32)
            moves[nodes] = self.left[nodes] + (zero[self.feature[nodes]] > self.cut[nodes])
            to = moves[at]
            for who, entry in block.entries(self.feature[nodes]):
                node, row = nodes[who], block.rows[entry]
                tree = self.tree[node]
                here = at[tree, row] == node
                node = node[here]
                to[tree[here], row[here]] = self.left[node] + (block.bins[entry][here] > self.cut[node])
            at = to
        return at


def weights(key: int, rows: int, trees: int, seed: int) -> np.ndarray:
    """Trees x rows: how often a row is drawn for a tree, Poisson of mean 1, from hashes."""
    with np.errstate(over="ignore"):
        x = np.uint64(key) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed & 0xFFFFFFFF) * np.uint64(0xD1B54A32D192ED03)
        x = x + np.arange(rows, dtype=np.uint64)[None, :] * np.uint64(0x9E6C63D0876A9A35) + np.arange(trees, dtype=np.uint64)[:, None] * np.uint64(0xA0761D6478BD642F)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        x = x ^ (x >> np.uint64(31))
    at_most = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(12)])
    return np.searchsorted(at_most, (x >> np.uint64(11)).astype(float) / (1 << 53), "right").astype(np.uint8)


@dataclass
class Layout:
    """Where a pass counts: drawn features of its nodes one after the other, each with a count for every bin."""
    owner: np.ndarray
    features: np.ndarray
    start: np.ndarray

    @staticmethod
    def of(nodes: np.ndarray, drawn: int, number: np.ndarray, seed: int) -> Layout:
        """Features are drawn by node, those without a cut count for nothing."""
        width = len(number)
        some = [np.sort(np.random.default_rng([seed & 0xFFFFFFFF, int(v)]).choice(width, drawn, replace=False, shuffle=False)) for v in nodes]
        features = np.concatenate(some) if some else np.zeros(0, np.int64)
        owner = np.repeat(np.arange(len(nodes)), drawn)
        useful = number[features] > 0
        features, owner = features[useful], owner[useful]
        return Layout(owner, features, np.r_[0, np.cumsum(number[features] + 1)])


@lru_cache(maxsize=2)
def _layout_of_pass(nodes: bytes, drawn: int, number: bytes, seed: int) -> Layout:
    """``Layout.of``, once a pass in each Python worker: its tasks share it."""
    return Layout.of(np.frombuffer(nodes, np.int64), drawn, np.frombuffer(number, np.int64), seed)


def best_cuts(layout: Layout, found: np.ndarray, totals: np.ndarray, zero: np.ndarray, least: int):
    """(node, feature, cut, classes on the left) of the cut that lowers Gini impurity most, for every node that has one.
    ``found``: (bin, class) counts without the zeros; ``totals``: (node, class)."""
    if not len(layout.features):
        return [np.zeros(0, np.int64)] * 3 + [np.zeros((0, totals.shape[1]), np.int64)]
    first, size = layout.start[:-1], np.diff(layout.start)
    full = found.astype(np.int64)
    full[first + zero[layout.features]] += totals[layout.owner] - np.add.reduceat(full, first, axis=0)
    run = np.cumsum(full, 0)
    seg = np.repeat(np.arange(len(first)), size)
    left = run - (run[first] - full[first])[seg]
    node = layout.owner[seg]
    right = totals[node] - left
    a, b, n = left.sum(1), right.sum(1), totals.sum(1)
    ok = (a >= max(1, least)) & (b >= max(1, least))
    ok[layout.start[1:] - 1] = False
    own = (totals.astype(float) ** 2).sum(1) / np.maximum(n, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = ((left.astype(float) ** 2).sum(1) / a + (right.astype(float) ** 2).sum(1) / b - own[node]) / n[node]
    gain = np.where(ok & (gain > 1e-12), gain, -np.inf)
    best = np.full(len(totals), -np.inf)
    np.maximum.at(best, node, gain)
    hits = np.flatnonzero((gain == best[node]) & (gain > 0))
    nodes, which = np.unique(node[hits], return_index=True)
    at = hits[which]
    return nodes, layout.features[seg[at]], at - first[seg[at]], left[at]


_BLOCK = "key long, start binary, used binary, rows binary, bins binary, labels binary"


def _packed(b: Block) -> pa.RecordBatch:
    used = np.flatnonzero(np.diff(b.start)).astype(np.int32)
    cols = [used, b.start[used + 1].astype(np.int64), b.rows, b.bins, b.labels]
    used, ends, rows, bins, labels = (pa.array([c.tobytes()], pa.binary()) for c in cols)
    return pa.record_batch([pa.array([b.key], pa.int64()), ends, used, rows, bins, labels], names=["key", "start", "used", "rows", "bins", "labels"])


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[Block]:
    for batch in batches:
        for i in range(len(batch)):
            key, ends, used, rows, bins, labels = (batch.column(c)[i].as_py() for c in range(6))
            size = np.zeros(width, np.int64)
            size[np.frombuffer(used, np.int32)] = np.diff(np.frombuffer(ends, np.int64), prepend=0)
            labels = np.frombuffer(labels, np.int16)
            yield Block(key, len(labels), np.r_[0, np.cumsum(size)], np.frombuffer(rows, np.uint16), np.frombuffer(bins, np.uint8), labels)


def _lists(col: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    return col.value_lengths().to_numpy(zero_copy_only=False), col.flatten().to_numpy(zero_copy_only=False)


def _sliced(cut):
    """Makes blocks of labelled rows; a block's key tells its task and place, so its rows are drawn alike if it is made again."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, len(batch), BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                lengths, indices = _lists(part.column(1))
                _, values = _lists(part.column(2))
                yield _packed(make_block(key, lengths, indices, values, part.column(0).to_numpy().astype(np.int16), cut.value))
                key += 1
    return work


def fit_cuts(rows: DataFrame, width: int, n: int, max_bins: int, seed: int) -> Cuts:
    """Cuts by the values of a sample of rows, zeros included (a feature that it lacks has none)."""
    share = min(1.0, max(max_bins ** 2, CUT_ROWS) / max(n, 1))
    some = rows.select("indices", "values")
    some = some.sample(share, seed=seed) if share < 1 else some
    some = some.persist()
    try:
        taken = some.count()

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(list(batches))  # this task's features of the bounded sample
            if not len(table):
                return
            f, v, c = (table.column(k).to_numpy() for k in ("f", "v", "n"))
            ends = np.r_[np.flatnonzero(np.diff(f)) + 1, len(f)]
            out, at = [], 0
            for end in ends:
                values, counts = v[at:end], c[at:end]
                if taken > counts.sum():
                    place = int(np.searchsorted(values, 0.0))
                    values, counts = np.insert(values, place, 0.0), np.insert(counts, place, taken - counts.sum())
                out.append(choose_cuts(values, counts, max_bins - 1))
                at = end
            yield pa.record_batch([pa.array(f[ends - 1], pa.int32()), pa.array(out, pa.list_(pa.float64()))], names=["f", "at"])

        values = (some.select(F.inline(F.arrays_zip("indices", "values"))).toDF("f", "v").where("v != 0").groupBy("f", "v").agg(F.count(F.lit(1)).alias("n"))
                  .repartition("f").sortWithinPartitions("f", "v"))
        found = values.mapInArrow(cut, "f int, at array<double>").toArrow()  # at most max_bins - 1 numbers a feature
    finally:
        some.unpersist()
    found = found.sort_by("f").combine_chunks()
    number = np.zeros(width, np.int64)
    if not len(found):
        return Cuts(np.r_[0, np.cumsum(number)], np.zeros(0))
    lengths, at = _lists(found.column("at").combine_chunks())
    number[found.column("f").to_numpy()] = lengths
    return Cuts(np.r_[0, np.cumsum(number)], np.asarray(at, float))


def _pass(trees, cut, nodes: np.ndarray, bounds: np.ndarray, drawn: int, number: int, seed: int):
    """The task of a pass: counts of ``nodes`` over its rows, a row for each slice of them."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, cuts = trees.value, cut.value
        zero = cuts.bins(np.arange(len(cuts.number)), np.zeros(len(cuts.number))).astype(np.int64)
        layout = _layout_of_pass(nodes.astype(np.int64).tobytes(), drawn, cuts.number.astype(np.int64).tobytes(), seed)
        classes = t.counts.shape[1]
        found, totals = np.zeros((int(layout.start[-1]), classes), np.int32), np.zeros((len(nodes), classes), np.int64)
        place = np.full(len(t.tree), -1, np.int64)
        place[nodes] = np.arange(len(nodes))
        flat, seen = found.reshape(-1), False
        for block in _blocks(batches, len(cuts.number)):
            seen = True
            at, w = place[t.reached(block, zero)], weights(block.key, block.n, number, seed)
            on = (at >= 0) & (w > 0)
            y = np.broadcast_to(block.labels, at.shape)[on].astype(np.int64)
            totals += np.bincount(at[on] * classes + y, w[on], len(nodes) * classes).astype(np.int64).reshape(totals.shape)
            tree = t.tree[nodes][layout.owner]
            for who, entry in block.entries(layout.features):
                row = block.rows[entry]
                here = at[tree[who], row] == layout.owner[who]
                who, row, entry = who[here], row[here], entry[here]
                np.add.at(flat, (layout.start[who] + block.bins[entry]) * classes + block.labels[row], w[tree[who], row].astype(np.int32))
        if seen:
            edge = layout.start[np.searchsorted(layout.owner, bounds)]
            for p in range(len(bounds) - 1):
                yield pa.record_batch([pa.array([p], pa.int32()), pa.array([found[edge[p]:edge[p + 1]].tobytes()], pa.binary()),
                                       pa.array([totals[bounds[p]:bounds[p + 1]].tobytes()], pa.binary())], names=["p", "found", "totals"])
    return work


def _choose(cut, nodes: np.ndarray, bounds: np.ndarray, drawn: int, classes: int, least: int, seed: int):
    """Adds up a slice's counts and chooses its cuts: a row for each node with its classes, and its cut if there is one."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for i in range(len(batch)):
                p, found, totals = (batch.column(c)[i].as_py() for c in range(3))
                found, totals = np.frombuffer(found, np.int32).reshape(-1, classes), np.frombuffer(totals, np.int64).reshape(-1, classes)
                if p in sums:
                    sums[p][0] += found
                    sums[p][1] += totals
                else:
                    sums[p] = [found.astype(np.int64), totals.copy()]
        cuts = cut.value
        zero = cuts.bins(np.arange(len(cuts.number)), np.zeros(len(cuts.number))).astype(np.int64)
        for p, (found, totals) in sums.items():
            mine = nodes[bounds[p]:bounds[p + 1]]
            which, feature, at, left = best_cuts(Layout.of(mine, drawn, cuts.number, seed), found, totals, zero, least)
            f, c, on_left = np.full(len(mine), -1), np.zeros(len(mine), np.int64), np.zeros_like(totals)
            f[which], c[which], on_left[which] = feature, at, left
            yield pa.record_batch([pa.array(mine, pa.int64()), pa.array(f, pa.int64()), pa.array(c, pa.int64()),
                                   pa.array(list(on_left), pa.list_(pa.int64())), pa.array(list(totals), pa.list_(pa.int64()))],
                                  names=["node", "feature", "cut", "on_left", "totals"])
    return work


def fit_trees(rows: DataFrame, width: int, classes: int, cuts: Cuts, number: int, depth: int, least: int, seed: int) -> Trees:
    """``number`` trees over (label, indices, values)."""
    spark = rows.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(cuts)
    blocks = rows.select(F.col("label").cast("double"), "indices", "values").mapInArrow(_sliced(shared), _BLOCK).persist()
    drawn = min(width, math.ceil(math.sqrt(width)))
    expected = max(1.0, drawn * float((cuts.number + (cuts.number > 0)).mean()) * classes)
    at_once = max(1, int(PASS_COUNTS / expected))
    trees = Trees.roots(number, classes)
    open_nodes = np.arange(number)
    try:
        while len(open_nodes):
            nodes, open_nodes = open_nodes[:at_once], open_nodes[at_once:]
            slices = min(len(nodes), math.ceil(len(nodes) * expected / SLICE_COUNTS))
            bounds = np.unique(np.linspace(0, len(nodes), slices + 1).astype(int))
            sent = spark.sparkContext.broadcast(trees)
            sums = blocks.mapInArrow(_pass(sent, shared, nodes, bounds, drawn, number, seed), "p int, found binary, totals binary")
            got = (sums.repartition(len(bounds) - 1, "p")
                   .mapInArrow(_choose(shared, nodes, bounds, drawn, classes, least, seed),
                               "node long, feature long, cut long, on_left array<long>, totals array<long>").toArrow().sort_by("node"))  # a row for each node
            sent.destroy()
            node, feature, cut = (got.column(c).to_numpy() for c in ("node", "feature", "cut"))
            left, totals = (np.array(got.column(c).to_pylist(), np.int64).reshape(-1, classes) for c in ("on_left", "totals"))
            trees.counts[node] = totals
            ok = feature >= 0
            first, k = len(trees.tree), int(ok.sum())
            trees = trees.grow(node[ok], feature[ok], cut[ok], left[ok], totals[ok] - left[ok])
            new = np.arange(first, first + 2 * k)
            mixed = (trees.counts[new] > 0).sum(1) > 1
            open_nodes = np.r_[open_nodes, new[(trees.depth[new] < depth) & mixed & (trees.counts[new].sum(1) >= 2 * max(1, least))]]
    finally:
        blocks.unpersist()
        shared.destroy()
    return trees


class _ForestColumns(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasSeed):
    pass


class SparseForest(Estimator, _ForestColumns, DefaultParamsReadable, DefaultParamsWritable):
    """MLlib's random forest classifier by name of params and in what it learns (its draws are others), on rows
    as sparse as they come. Labels are 0 to classes - 1; rows without a label or features take no part."""

    numTrees = Param(Params._dummy(), "numTrees", "trees", typeConverter=TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of a tree, at most", typeConverter=TypeConverters.toInt)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "drawn rows of a child, at least", typeConverter=TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature, at most (256 at most)", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, labelCol=None, featuresCol=None, predictionCol=None, probabilityCol=None, seed=42, numTrees=20, maxDepth=5,
                 minInstancesPerNode=1, maxBins=32):
        super().__init__()
        self._setDefault(seed=42, numTrees=20, maxDepth=5, minInstancesPerNode=1, maxBins=32)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _values(self) -> dict:
        return {p.name: self.getOrDefault(p) for p in self.params if self.isDefined(p)}

    def prepare(self, dataset: DataFrame) -> tuple[DataFrame, int, int, Cuts]:
        """Rows, width, classes and cuts: the same for all numbers of trees, depths and least rows of a child."""
        value = self._values()
        rows = dataset.select(F.col(value["labelCol"]).cast("double").alias("label"), *sparse(value["featuresCol"]),
                              F.unwrap_udt(value["featuresCol"])["size"].alias("size")).where("label IS NOT NULL AND values IS NOT NULL")
        facts = rows.agg(F.count(F.lit(1)).alias("n"), F.max("label").alias("top"),
                         F.max(F.coalesce("size", F.size("values"))).alias("width")).first()
        if not facts["n"]:
            raise ValueError("no labelled row with features")
        width, classes = max(1, facts["width"]), int(facts["top"]) + 1
        return rows, width, classes, fit_cuts(rows, width, facts["n"], value["maxBins"], value["seed"])

    def fit_prepared(self, prepared: tuple[DataFrame, int, int, Cuts]) -> SparseForestModel:
        rows, width, classes, cuts = prepared
        value = self._values()
        trees = fit_trees(rows, width, classes, cuts, value["numTrees"], value["maxDepth"], value["minInstancesPerNode"], value["seed"])
        return self._copyValues(SparseForestModel(trees, cuts))

    def _fit(self, dataset: DataFrame) -> SparseForestModel:
        return self.fit_prepared(self.prepare(dataset))


class SparseForestModel(Model, _ForestColumns):
    """Fitted trees; a row's probabilities are the mean of the shares of the classes in its leaves."""

    def __init__(self, trees: Trees, cuts: Cuts):
        super().__init__()
        self.trees, self.cuts = trees, cuts

    def _transform(self, dataset: DataFrame) -> DataFrame:
        spark = dataset.sparkSession
        ship_package(spark)
        shared = spark.sparkContext.broadcast((self.trees, self.cuts))

        @F.pandas_udf("array<double>")
        def score(x: pd.DataFrame) -> pd.Series:
            trees, cuts = shared.value
            zero = cuts.bins(np.arange(len(cuts.number)), np.zeros(len(cuts.number))).astype(np.int64)
            share = trees.counts / np.maximum(trees.counts.sum(1, keepdims=True), 1)
            out = [np.zeros((0, share.shape[1]))]
            for at in range(0, len(x), BLOCK_ROWS):
                part = x.iloc[at:at + BLOCK_ROWS]
                lengths = part["indices"].map(len).to_numpy()
                block = make_block(0, lengths, np.concatenate(part["indices"].to_list()).astype(np.int64),
                                   np.concatenate(part["values"].to_list()).astype(float), np.zeros(len(part), np.int16), cuts)
                ends = trees.reached(block, zero)
                out.append(sum(share[e] for e in ends) / len(ends))
            return pd.Series(list(np.concatenate(out)), index=x.index)

        out = dataset.withColumn(self.getProbabilityCol(), score(F.struct(*sparse(self.getFeaturesCol()))))
        p = F.col(self.getProbabilityCol())
        out = out.withColumn(self.getPredictionCol(), (F.array_position(p, F.array_max(p)) - 1).cast("double"))
        return out.withColumn(self.getProbabilityCol(), array_to_vector(p))
