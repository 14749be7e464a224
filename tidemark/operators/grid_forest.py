"""All points of a forest's grid from one set of trees.

Points that differ in the number of trees, in depth, in the rows needed to split a node or in the least decrease of
impurity take the same cuts as long as they go on: a point's tree is the largest point's, cut off where the point stops.
So trees are grown once for each fold and least number of rows of a leaf, and every point is scored on them, whole.
The trees are MLlib's: Poisson weights, the root of the number of features drawn for each node, cuts by quantiles, Gini
impurity. What MLlib has no params for (rows to split a node, impurity decrease weighted by the node) is scikit-learn's.

Nodes of more than ``GROUP_ROWS`` rows are cut by counts that all tasks add up. The rows of each smaller node are sent to
one task, which grows what is below and scores the held-out rows that end there; votes are added up by row. No tree and
no row passes the driver but for the nodes above.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.sparse_forest import Cuts, fit_cuts, sparse
from tidemark.session import ship_package, written_table

#: Rows of a node that one task grows on, about; rows whose votes are added up together; bins of a feature.
GROUP_ROWS, SLICE_ROWS, BINS = 1 << 17, 1 << 12, 32
#: Numbers that a point may differ in, in the order of a point.
NAMES = ("numTrees", "maxDepth", "minSamplesSplit", "minInstancesPerNode", "minImpurityDecrease")


def _hash(x: np.ndarray, *salt) -> np.ndarray:
    """64-bit hashes of numbers and salts."""
    with np.errstate(over="ignore"):
        x = np.asarray(x).astype(np.uint64)
        for s in salt:
            x = x + (np.asarray(s).astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            x = x ^ (x >> np.uint64(31))
    return x


_POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(12)])


def draws(key: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is drawn for a tree, Poisson of mean 1."""
    return np.searchsorted(_POISSON, (_hash(key, tree, seed) >> np.uint64(11)).astype(float) / (1 << 53), "right").astype(np.uint8)


@dataclass
class Spec:
    """What all points share: the widest values of the grid, and the features' numbers of cuts."""
    trees: int
    depth: int
    split: int
    decrease: float
    number: np.ndarray
    classes: int
    seed: int

    def drawn(self, node: np.ndarray) -> np.ndarray:
        """Features of each node (given by key), the root of their number."""
        width = len(self.number)
        k = min(width, math.ceil(math.sqrt(width)))
        return np.sort(np.argsort(_hash(node[:, None], np.arange(width)[None, :]), axis=1, kind="stable")[:, :k], axis=1)


@dataclass
class Nodes:
    """A tree from its root; ``feature`` is -1 at a leaf, a row goes left up to bin ``cut``, the right child follows the left one."""
    key: np.ndarray
    depth: np.ndarray
    counts: np.ndarray
    feature: np.ndarray = field(default=None)
    cut: np.ndarray = field(default=None)
    left: np.ndarray = field(default=None)
    lowers: np.ndarray = field(default=None)

    def __post_init__(self):
        if self.feature is None:
            n = len(self.key)
            self.feature, self.cut, self.left, self.lowers = np.full(n, -1), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n)

    @staticmethod
    def root(tree: int, spec: Spec) -> Nodes:
        return Nodes(_hash(np.array([tree]), spec.seed, 7), np.zeros(1, np.int64), np.zeros((1, spec.classes), np.int64))

    def grow(self, at: np.ndarray, feature, cut, left, right, lowers) -> np.ndarray:
        """Two children for each node ``at``; their numbers."""
        n, k = len(self.key), len(at)
        self.feature[at], self.cut[at], self.left[at], self.lowers[at] = feature, cut, n + 2 * np.arange(k), lowers
        key = np.stack([_hash(self.key[at], 1), _hash(self.key[at], 2)], 1).ravel()
        more = Nodes(key, np.repeat(self.depth[at] + 1, 2), np.stack([left, right], 1).reshape(2 * k, self.counts.shape[1]))
        for f in ("key", "depth", "counts", "feature", "cut", "left", "lowers"):
            setattr(self, f, np.concatenate([getattr(self, f), getattr(more, f)]))
        return n + np.arange(2 * k)

    def reached(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row of bins."""
        at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        while len(rows):
            rows = rows[self.feature[at[rows]] >= 0]
            now = at[rows]
            at[rows] = self.left[now] + (x[rows, self.feature[now]] > self.cut[now])
        return at

    def shares(self, points: Sequence[tuple[int, int, float]]) -> np.ndarray:
        """For each node and point (depth, rows to split, decrease) the share of classes where the point stops on the way to it."""
        n = self.counts.sum(1)
        own = (self.counts / np.maximum(n, 1)[:, None]).astype(np.float32)
        out = np.repeat(own[:, None, :], len(points), 1)
        stops = np.stack([(self.depth >= d) | (n < s) | (self.lowers < low) for d, s, low in points], 1)
        for d in np.unique(self.depth):
            at = np.flatnonzero((self.depth == d) & (self.feature >= 0))
            for side in (0, 1):
                child = self.left[at] + side
                stopped = stops[at]
                out[child] = np.where(stopped[:, :, None], out[at], out[child])
                stops[child] |= stopped
        return out


def counted(x: np.ndarray, y: np.ndarray, w: np.ndarray, at: np.ndarray, features: np.ndarray, classes: int) -> np.ndarray:
    """Weights by node, drawn feature, bin and class of rows at the nodes ``at``."""
    m, k = features.shape
    out = np.empty((m, k, BINS, classes), np.int64)
    for j in range(k):
        b = x[np.arange(len(x)), features[at, j]]
        out[:, j] = np.bincount((at * BINS + b) * classes + y, w, m * BINS * classes).astype(np.int64).reshape(m, BINS, classes)
    return out


def best(found: np.ndarray, features: np.ndarray, number: np.ndarray, least: int):
    """For each node: whether there is a cut, its feature, bin, classes on the left and right, and how much impurity it takes from a row."""
    left = np.cumsum(found, 2)
    total = left[:, :, -1:, :]
    a, n = left.sum(3), total.sum(3)
    b = n - a
    ok = (a >= max(1, least)) & (b >= max(1, least)) & (np.arange(BINS)[None, None, :] < number[features][:, :, None])
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = ((left.astype(float) ** 2).sum(3) / a + ((total - left).astype(float) ** 2).sum(3) / b - (total.astype(float) ** 2).sum(3) / n) / n
    gain = np.where(ok & (gain > 1e-12), gain, -np.inf).reshape(len(found), -1)
    which = gain.argmax(1)
    i = np.arange(len(found))
    j, c = which // BINS, which % BINS
    return gain[i, which] > 0, features[i, j], c, left[i, j, c], total[i, j, 0] - left[i, j, c], gain[i, which]


def grown(nodes: Nodes, x: np.ndarray, y: np.ndarray, w: np.ndarray, least: int, rows_of_tree: int, spec: Spec) -> Nodes:
    """The tree below the root of ``nodes`` by the rows that reach it."""
    nodes.counts[0] = np.bincount(y, w, spec.classes)
    open_nodes, at, rows = np.zeros(1, np.int64), np.zeros(len(x), np.int64), np.arange(len(x))
    while len(open_nodes):
        n = nodes.counts[open_nodes].sum(1)
        able = (n >= max(spec.split, 2 * least)) & (nodes.depth[open_nodes] < spec.depth) & ((nodes.counts[open_nodes] > 0).sum(1) > 1)
        place = np.full(len(nodes.key), -1)
        open_nodes, n = open_nodes[able], n[able]
        place[open_nodes] = np.arange(len(open_nodes))
        rows = rows[place[at[rows]] >= 0]
        if not len(open_nodes):
            break
        features = spec.drawn(nodes.key[open_nodes])
        found = counted(x[rows], y[rows], w[rows], place[at[rows]], features, spec.classes)
        there, f, c, left, right, gain = best(found, features, spec.number, least)
        lowers = gain * n / rows_of_tree
        there &= lowers >= spec.decrease
        new = nodes.grow(open_nodes[there], f[there], c[there], left[there], right[there], lowers[there])
        now = at[rows]
        rows, now = rows[nodes.feature[now] >= 0], now[nodes.feature[now] >= 0]
        at[rows] = nodes.left[now] + (x[rows, nodes.feature[now]] > nodes.cut[now])
        open_nodes = new
    return nodes


# --- rows in tasks -------------------------------------------------------------------------------

_BINNED = "row long, label int, held boolean, bins binary"
_SENT = "g long, tree int, node int, held boolean, row binary, label binary, w binary, bins binary"
_VOTES = "slice long, least int, tree int, row binary, label binary, votes binary"


def _binned(rows: DataFrame, cuts: Cuts) -> DataFrame:
    """Rows with a byte for each feature."""
    shared = rows.sparkSession.sparkContext.broadcast(cuts)
    width = len(cuts.number)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        zero = c.bins(np.arange(width), np.zeros(width))
        for b in batches:
            x = np.tile(zero, (len(b), 1))
            size = b.column(3).value_lengths().to_numpy(zero_copy_only=False)
            index = b.column(3).flatten().to_numpy(zero_copy_only=False)
            x[np.repeat(np.arange(len(b)), size), index] = c.bins(index, b.column(4).flatten().to_numpy(zero_copy_only=False))
            yield pa.record_batch([b.column(0), b.column(1), b.column(2), pa.array([r.tobytes() for r in x], pa.binary())], names=["row", "label", "held", "bins"])

    return rows.select("row", F.col("label").cast("int").alias("label"), "held", "indices", "values").mapInArrow(work, _BINNED)


def _arrays(b: pa.RecordBatch, width: int):
    x = np.frombuffer(b"".join(b.column(3).to_pylist()), np.uint8).reshape(-1, width)
    return (*(b.column(i).to_numpy(zero_copy_only=False) for i in range(3)), x)


def _top(binned: DataFrame, leasts: Sequence[int], spec: Spec) -> dict[int, Nodes]:
    """The nodes above of each tree: those of more than ``GROUP_ROWS`` rows whose cut all points take."""
    trees = {t: Nodes.root(t, spec) for t in range(spec.trees)}
    width, least = len(spec.number), max(leasts)
    if binned.where("NOT held").count() <= GROUP_ROWS:  # twice as many draws for no tree
        return trees
    open_nodes = {t: np.zeros(1, np.int64) for t in trees}
    sc = binned.sparkSession.sparkContext
    while open_nodes:
        shared = sc.broadcast((trees, open_nodes))

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tops, asked = shared.value
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                row, label, held, x = _arrays(batch, width)
                row, label, x = row[~held], label[~held].astype(np.int64), x[~held]
                for t, nodes in asked.items():
                    place = np.full(len(tops[t].key), -1)
                    place[nodes] = np.arange(len(nodes))
                    w, at = draws(row, t, spec.seed), place[tops[t].reached(x)]
                    on = (w > 0) & (at >= 0)
                    found = counted(x[on], label[on], w[on], at[on], spec.drawn(tops[t].key[nodes]), spec.classes)
                    sums[t] = sums[t] + found if t in sums else found
            for t, found in sums.items():
                yield pa.record_batch([pa.array([t], pa.int32()), pa.array([found.tobytes()], pa.binary())], names=["tree", "found"])

        def choose(parts: pa.Table) -> pa.Table:
            tops, asked = shared.value
            t = parts["tree"][0].as_py()
            nodes = asked[t]
            features = spec.drawn(tops[t].key[nodes])
            found = sum(np.frombuffer(p, np.int64) for p in parts["found"].to_pylist()).reshape(len(nodes), features.shape[1], BINS, spec.classes)
            there, f, c, left, right, gain = best(found, features, spec.number, 1)
            there &= (left.sum(1) >= least) & (right.sum(1) >= least)
            return pa.table([pa.array(np.full(len(nodes), t), pa.int32()), pa.array(nodes, pa.int64()), pa.array(there), pa.array(f, pa.int64()),
                             pa.array(c, pa.int64()), pa.array(list(left), pa.list_(pa.int64())), pa.array(list(right), pa.list_(pa.int64())), pa.array(gain)],
                            names=["tree", "node", "there", "feature", "cut", "left", "right", "gain"])

        got = (binned.mapInArrow(count, "tree int, found binary").groupBy("tree")
               .applyInArrow(choose, "tree int, node long, there boolean, feature long, cut long, left array<long>, right array<long>, gain double").toArrow())
        following = {}
        for t, nodes in trees.items():
            mine = got.filter(pa.compute.equal(got["tree"], t)).sort_by("node")
            if not len(mine):
                continue
            node, there, f, c, gain = (mine[k].to_numpy() for k in ("node", "there", "feature", "cut", "gain"))
            left, right = (np.array(mine[k].to_pylist(), np.int64) for k in ("left", "right"))
            n = (left + right).sum(1)
            nodes.counts[node] = left + right
            lowers = gain * n / nodes.counts[0].sum()
            go = there & (n > GROUP_ROWS) & (lowers >= spec.decrease) & (nodes.depth[node] < spec.depth)
            new = nodes.grow(node[go], f[go], c[go], left[go], right[go], lowers[go])
            new = new[nodes.counts[new].sum(1) > GROUP_ROWS]
            if len(new):
                following[t] = new
        shared.destroy()
        open_nodes = following
    return trees


def _sent(binned: DataFrame, tops, spec: Spec) -> DataFrame:
    """Rows by tree and lowest node above, many to a row: drawn ones, and the held-out ones once for each tree."""
    width = len(spec.number)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, label, held, x = _arrays(b, width)
            label = label.astype(np.int16)
            for t, nodes in tops.value.items():
                w, leaf = draws(row, t, spec.seed), nodes.reached(x)
                for h in (False, True):
                    some = np.flatnonzero(held if h else ~held & (w > 0))
                    some = some[np.argsort(leaf[some], kind="stable")]
                    ends, first = np.unique(leaf[some], return_index=True)
                    for node, at in zip(ends.tolist(), np.split(some, first[1:])):
                        cells = [row[at], label[at], w[at], x[at]]
                        yield pa.record_batch([pa.array([(t << 32) + node], pa.int64()), pa.array([t], pa.int32()), pa.array([node], pa.int32()), pa.array([h]),
                                               *(pa.array([c.tobytes()], pa.binary()) for c in cells)], names=[f.split()[0] for f in _SENT.split(", ")])

    return binned.mapInArrow(work, _SENT)


def _gathered(part: pa.Table, width: int):
    row, label, w, x = (np.frombuffer(b"".join(part[n].to_pylist()), k) for n, k in (("row", np.int64), ("label", np.int16), ("w", np.uint8), ("bins", np.uint8)))
    order = np.argsort(row, kind="stable")
    return row[order], label[order].astype(np.int64), w[order], x.reshape(-1, width)[order]


def _below(part: pa.Table, tops: Mapping[int, Nodes], least: int, spec: Spec) -> Nodes:
    """The tree below a node above, by the drawn rows of ``part``."""
    t, node = part["tree"][0].as_py(), part["node"][0].as_py()
    top = tops[t]
    _, y, w, x = _gathered(part.filter(pa.compute.invert(part["held"])), len(spec.number))
    root = Nodes(top.key[[node]], top.depth[[node]], np.zeros((1, spec.classes), np.int64))
    return grown(root, x, y, w.astype(np.int64), least, int(top.counts[0].sum()) or int(w.sum()), spec)


def _votes(sent: DataFrame, groups: int, tops, leasts: Sequence[int], stops, spec: Spec) -> DataFrame:
    """Shares of the classes for held-out rows, of each group's tree, by least rows of a leaf and point."""
    def work(part: pa.Table) -> pa.Table:
        out, held = [], part.filter(part["held"])
        if len(held):
            row, label, _, x = _gathered(held, len(spec.number))
            part_of = row // SLICE_ROWS
            cuts = np.flatnonzero(np.diff(part_of, prepend=part_of[0] - 1))
            for least in leasts:
                nodes = _below(part, tops.value, least, spec)
                votes = nodes.shares(stops)[nodes.reached(x)]
                for at in np.split(np.arange(len(row)), cuts[1:]):
                    cells = [row[at], label[at].astype(np.int16), votes[at]]
                    out.append(pa.record_batch([pa.array([part_of[at[0]]], pa.int64()), pa.array([least], pa.int32()), part["tree"].combine_chunks()[:1],
                                                *(pa.array([c.tobytes()], pa.binary()) for c in cells)], names=[f.split()[0] for f in _VOTES.split(", ")]))
        return pa.Table.from_batches(out) if out else pa.table({f.split()[0]: pa.array([], k) for f, k in zip(_VOTES.split(", "), _VOTE_KINDS)})

    return sent.repartition(groups, "g").groupBy("g").applyInArrow(work, _VOTES)


_VOTE_KINDS = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())


def _predicted(votes: DataFrame, points: Sequence[tuple], stops: Sequence[tuple], classes: int) -> DataFrame:
    """Held-out rows with their label and each point's prediction ``p0``, ``p1``..., by the mean share of its trees."""
    sizes = sorted({p[0] for p in points})

    def work(part: pa.Table) -> pa.Table:
        rows = np.unique(np.concatenate([np.frombuffer(r, np.int64) for r in part["row"].to_pylist()]))
        label = np.zeros(len(rows), np.int64)
        sums: dict[tuple[int, int], np.ndarray] = {}
        order = np.lexsort((part["tree"].to_numpy(), part["least"].to_numpy()))  # sums do not depend on who came first
        for i in order.tolist():
            at = np.searchsorted(rows, np.frombuffer(part["row"][i].as_py(), np.int64))
            label[at] = np.frombuffer(part["label"][i].as_py(), np.int16)
            got = np.frombuffer(part["votes"][i].as_py(), np.float32).reshape(len(at), len(stops), classes)
            for n in sizes:
                if part["tree"][i].as_py() < n:
                    key = part["least"][i].as_py(), n
                    if key not in sums:
                        sums[key] = np.zeros((len(rows), len(stops), classes))
                    sums[key][at] += got
        out = [sums[p[3], p[0]][:, stops.index((p[1], p[2], p[4]))].argmax(1).astype(float) for p in points]
        return pa.table([pa.array(label.astype(float)), *map(pa.array, out)], names=["label", *(f"p{i}" for i in range(len(points)))])

    return votes.groupBy("slice").applyInArrow(work, "label double, " + ", ".join(f"p{i} double" for i in range(len(points))))


# --- search ---------------------------------------------------------------------------------------


class _Numbers(Params):
    numTrees = Param(Params._dummy(), "numTrees", "trees", typeConverter=TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of a tree, at most", typeConverter=TypeConverters.toInt)
    minSamplesSplit = Param(Params._dummy(), "minSamplesSplit", "drawn rows of a node that is split, at least", typeConverter=TypeConverters.toInt)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "drawn rows of a leaf, at least", typeConverter=TypeConverters.toInt)
    minImpurityDecrease = Param(Params._dummy(), "minImpurityDecrease", "decrease of impurity by a cut, times the node's share of rows, at least",
                                typeConverter=TypeConverters.toFloat)

    def __init__(self):
        super().__init__()
        self._setDefault(numTrees=20, maxDepth=5, minSamplesSplit=2, minInstancesPerNode=1, minImpurityDecrease=0.0)


class GridForestModel(_Numbers):
    """The best point's trees as a table: ``tree``, the node ``above`` that a run of nodes hangs on (numbers within the run), and nodes."""

    def __init__(self, trees: DataFrame, tops: Mapping[int, Nodes], cuts: Cuts):
        super().__init__()
        self.trees, self.tops, self.cuts = trees, tops, cuts


@dataclass
class GridSearch:
    """``points`` as params by name with their mean metric over the folds, and the best one fitted on all rows."""
    points: list[dict]
    avgMetrics: list[float]
    bestModel: GridForestModel


_TREES = ("tree int, above int, depth array<long>, feature array<long>, cut array<long>, left array<long>, counts array<long>")


class GridForest(_Numbers):
    """A random forest whose grid is searched as a whole; labels are 0 to classes - 1."""

    def __init__(self, labelCol: str = "label", featuresCol: str = "features", seed: int = 42):
        super().__init__()
        self.label, self.features, self.seed = labelCol, featuresCol, seed

    def search(self, train: DataFrame, grid: Mapping[str, Sequence], evaluator, folds: int = 3, parallelism: int = 4) -> GridSearch:
        """Every point of ``grid``, scored on each of ``folds`` held-out parts by ``evaluator`` over label and prediction."""
        spark = train.sparkSession
        ship_package(spark)
        values = [grid.get(n, [self.getOrDefault(n)]) for n in NAMES]
        points = list(product(*values))
        rows = train.select(F.monotonically_increasing_id().alias("row"), (F.rand(self.seed) * folds).cast("int").alias("fold"),
                            F.col(self.label).alias("label"), *sparse(self.features)).where("label IS NOT NULL AND values IS NOT NULL")
        rows = written_table(rows, "forest-rows")
        facts = rows.agg(F.max("label").alias("top"), F.max(F.size("values")).alias("size"), F.max(F.array_max("indices")).alias("last")).first()
        if facts["top"] is None:
            raise ValueError("no labelled row with features")
        width, classes = max(facts["size"], facts["last"] + 1), int(facts["top"]) + 1
        metrics = np.zeros((folds, len(points)))
        for fold in range(folds):
            scored = self._scored(rows.withColumn("held", F.col("fold") == fold), width, classes, points)

            def score(i: int, scored=scored) -> float:
                return evaluator.copy({evaluator.predictionCol: f"p{i}", evaluator.labelCol: "label"}).evaluate(scored)

            with ThreadPoolExecutor(parallelism) as pool:
                metrics[fold] = list(pool.map(inheritable_thread_target(spark)(score), range(len(points))))
        mean = metrics.mean(0)
        chosen = points[int(mean.argmax() if evaluator.isLargerBetter() else mean.argmin())]
        return GridSearch([dict(zip(NAMES, p)) for p in points], mean.tolist(), self._fitted(rows, width, classes, chosen))

    def _spec(self, training: DataFrame, width: int, classes: int, points: Sequence[tuple]) -> tuple[Spec, Cuts]:
        cuts = fit_cuts(training, width, training.count(), BINS, self.seed)
        return Spec(max(p[0] for p in points), max(p[1] for p in points), min(p[2] for p in points), min(p[4] for p in points), cuts.number,
                    classes, self.seed), cuts

    def _scored(self, rows: DataFrame, width: int, classes: int, points: Sequence[tuple]) -> DataFrame:
        spec, cuts = self._spec(rows.where("NOT held"), width, classes, points)
        leasts, stops = sorted({p[3] for p in points}), sorted({(p[1], p[2], p[4]) for p in points})
        binned = written_table(_binned(rows, cuts), "forest-bins")
        # the nodes above must be cut by all points: their decrease is at least the largest asked for
        above = Spec(**{**spec.__dict__, "depth": min(p[1] for p in points), "split": max(p[2] for p in points), "decrease": max(p[4] for p in points)})
        tops = _top(binned, leasts, above)
        groups = sum(int((t.feature < 0).sum()) for t in tops.values())
        shared = rows.sparkSession.sparkContext.broadcast(tops)
        votes = _votes(_sent(binned, shared, spec), groups, shared, leasts, stops, spec)
        return written_table(_predicted(votes, points, stops, classes), "forest-scores")

    def _fitted(self, rows: DataFrame, width: int, classes: int, point: tuple) -> GridForestModel:
        spec, cuts = self._spec(rows, width, classes, [point])
        binned = written_table(_binned(rows.withColumn("held", F.lit(False)), cuts), "forest-bins")
        tops = _top(binned, [point[3]], spec)
        shared = rows.sparkSession.sparkContext.broadcast(tops)

        def work(part: pa.Table) -> pa.Table:
            n = _below(part, shared.value, point[3], spec)
            cells = [part["tree"][0].as_py(), part["node"][0].as_py(), n.depth, n.feature, n.cut, n.left, n.counts.ravel()]
            kinds = [pa.int32(), pa.int32(), *[pa.list_(pa.int64())] * 5]
            return pa.table([pa.array([c], k) for c, k in zip(cells, kinds)], names=[f.split()[0] for f in _TREES.split(", ")])

        groups = sum(int((t.feature < 0).sum()) for t in tops.values())
        trees = written_table(_sent(binned, shared, spec).repartition(groups, "g").groupBy("g").applyInArrow(work, _TREES), "forest-trees")
        model = GridForestModel(trees, tops, cuts)
        return model._set(**dict(zip(NAMES, point)))
