"""Approximate nearest neighbours by stable projections and a kd-tree.

Vectors are reduced to a space in which the largest inner product is the smallest
distance (one further component completes each vector to the largest norm), and
projected by a few Gaussian (2-stable) directions. A kd-tree over the projections
holds the index: its upper levels, fitted on a sample of a few projections for each
cell, deal all vectors to cells, each a task's work; within a cell the levels go on down to leaves. A
query takes projected neighbours incrementally, leaf by leaf, and verifies them on
the original vectors. It stops when a chi-square test holds: a vector nearer than
the k-th one found would, with probability ``CONFIDENCE``, have shown a projected
distance below the next leaf's.

A query searches its own cell first; what it has found there decides by the same
test which other cells it still visits. Equal vectors are indexed once with their
smallest ids, as many as an answer can hold, so one very common vector is one row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import if_small, prepare, written

#: Directions; confidence of the stopping test; vectors of a leaf; rows of a cell; rows (their projections) that the
#: upper levels are fitted on, for each cell and at least.
DIRECTIONS, CONFIDENCE, LEAF, CELL, SAMPLE, LEAST = 8, 0.9, 256, 16_384, 16, 20_000
#: Query rows that a task takes at once.
BLOCK = 512


def chi_square(x: np.ndarray, m: int = DIRECTIONS) -> np.ndarray:
    """Distribution function for an even number ``m`` of degrees of freedom."""
    h = np.asarray(x) / 2
    term = total = np.ones_like(h)
    for i in range(1, m // 2):
        term = term * h / i
        total = total + term
    return 1 - np.exp(-h) * total


def stop_ratio(confidence: float, m: int = DIRECTIONS) -> float:
    """The x at which the distribution function reaches ``confidence``."""
    low, high = 0.0, 200.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, m) < confidence else (low, mid)
    return high


def directions(dim: int, m: int = DIRECTIONS, seed: int = 7) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dim + 1, m))


def split(points: np.ndarray, size: int) -> list[np.ndarray]:
    """Row numbers of the leaves of a kd-tree: halves at the median of the widest direction, down to ``size`` rows."""
    todo, leaves = [np.arange(len(points))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= size:
            leaves.append(rows)
            continue
        p = points[rows]
        axis = int(np.argmax(p.max(0) - p.min(0)))
        order = rows[np.argpartition(p[:, axis], len(rows) // 2)]
        todo += [order[:len(rows) // 2], order[len(rows) // 2:]]
    return [x for x in leaves if len(x)]


def _box_distance(q: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances from each point to each box."""
    out = np.zeros((len(q), len(low)))
    for j in range(q.shape[1]):
        x = q[:, j:j + 1]
        out += np.maximum(0, np.maximum(low[:, j] - x, x - high[:, j])) ** 2
    return out


class Tree:
    """kd-tree over the projections of a cell's vectors."""

    def __init__(self, vectors: np.ndarray, projected: np.ndarray, keys: np.ndarray):
        leaves = split(projected, LEAF)
        order = np.concatenate(leaves) if leaves else np.zeros(0, int)
        self.vectors, self.keys = vectors[order], keys[order]
        self.bounds = np.cumsum([0] + [len(x) for x in leaves])
        self.low = np.array([projected[x].min(0) for x in leaves]).reshape(len(leaves), -1)
        self.high = np.array([projected[x].max(0) for x in leaves]).reshape(len(leaves), -1)

    def search(self, q: np.ndarray, projected: np.ndarray, far: float, k: int, known: np.ndarray, ratio: float
               ) -> tuple[np.ndarray, np.ndarray]:
        """Best ``k`` keys and inner products of each query row, in no order (key -1: none).

        ``far``: squared norm that vectors are completed to; ``known``: inner
        product of the k-th one that the query has from other cells.
        """
        scores, keys = np.full((len(q), k), -np.inf), np.full((len(q), k), -1, np.int64)
        kth = known.copy()  # best bound so far: the k-th found here or elsewhere
        near = _box_distance(projected, self.low, self.high)
        turn = np.argsort(near, axis=1, kind="stable")
        own = (q * q).sum(1) + far
        live = np.arange(len(q))
        for step in range(turn.shape[1]):
            leaf = turn[live, step]
            # squared distance of the k-th found, in the space where inner products are distances
            on = ~(near[live, leaf] > ratio * np.maximum(own[live] - 2 * kth[live], 0))
            live, leaf = live[on], leaf[on]
            if not len(live):
                break
            by = np.argsort(leaf, kind="stable")
            for rows in np.split(by, np.flatnonzero(np.diff(leaf[by])) + 1):
                a, b = self.bounds[leaf[rows[0]]], self.bounds[leaf[rows[0]] + 1]
                who = live[rows]
                s = q[who] @ self.vectors[a:b].T
                better = s.max(axis=1) > kth[who]
                if not better.any():
                    continue
                who, s = who[better], np.concatenate([scores[who[better]], s[better]], axis=1)
                i = np.concatenate([keys[who], np.broadcast_to(self.keys[a:b], (len(who), b - a))], axis=1)
                top = np.argpartition(-s, k - 1, axis=1)[:, :k]
                scores[who], keys[who] = np.take_along_axis(s, top, 1), np.take_along_axis(i, top, 1)
                kth[who] = np.maximum(kth[who], scores[who].min(axis=1))
        return keys, scores


def _clean(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v): ids and vectors that take part."""
    v = F.col(vec_col).cast("array<double>")
    whole = F.forall(vec_col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    return (vectors.where(F.col(vec_col).isNotNull() & F.col(id_col).isNotNull()).where(whole)
            .where(F.exists(vec_col, lambda x: x != 0)).select(F.col(id_col).cast("long").alias("id"), v.alias("v")))


def index(rows: DataFrame, keep: int) -> DataFrame:
    """(key, v, ids): distinct vectors, keyed by their smallest id, with their ``keep`` smallest ids.

    Ids are cut to the smallest per task before they meet, so a vector that fills
    a third of all rows costs no task more than ``keep`` rows of each other task.
    """
    w = Window.partitionBy("v").orderBy("id")
    return (rows.distinct().withColumn("n", F.row_number().over(w)).where(F.col("n") <= keep)
            .groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
            .select(F.col("ids")[0].alias("key"), "v", "ids"))


def _grown(sample: np.ndarray, cells: int) -> list[tuple]:
    """Upper levels of the tree on a sample: nested (axis, cut, left, right), or a cell's number."""
    count = iter(range(1 << 30))

    def grow(points: np.ndarray, want: int):
        if want <= 1 or len(points) < 2:
            return next(count)
        axis = int(np.argmax(points.max(0) - points.min(0)))
        cut = float(np.median(points[:, axis]))
        low = points[:, axis] < cut
        if not low.any():
            return next(count)
        return (axis, cut, grow(points[low], want // 2), grow(points[~low], want - want // 2))

    return grow(sample, cells)


def _cells(tree, points: np.ndarray) -> np.ndarray:
    out, todo = np.zeros(len(points), np.int64), [(tree, np.arange(len(points)))]
    while todo:
        node, rows = todo.pop()
        if isinstance(node, int):
            out[rows] = node
            continue
        axis, cut, low, high = node
        left = points[rows, axis] < cut
        todo += [(low, rows[left]), (high, rows[~left])]
    return out


def _boxes(tree, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the cells, by cell number."""
    found, todo = {}, [(tree, np.full(m, -np.inf), np.full(m, np.inf))]
    while todo:
        node, low, high = todo.pop()
        if isinstance(node, int):
            found[node] = (low, high)
            continue
        axis, cut, a, b = node
        below, above = high.copy(), low.copy()
        below[axis] = above[axis] = cut
        todo += [(a, low, below), (b, above, high)]
    return np.array([found[i][0] for i in range(len(found))]), np.array([found[i][1] for i in range(len(found))])


def search(vectors: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
           confidence: float = CONFIDENCE, cell_rows: int = CELL) -> DataFrame:
    """The ``k`` nearest of ``vectors`` found for every row of ``queries`` (same columns), by
    largest inner product in double precision, its own id left out: ``query_id``, ``rank``
    (from 1), ``vec_id``, ``score``; ties go to the smaller id.

    Null, zero and empty vectors and those with null or non-finite components,
    and null ids, take no part; fewer candidates than ``k`` give shorter answers.
    The length is that of the vector with the smallest id; vectors and queries of
    another length take no part. A repeated row counts once; a repeated id with
    different vectors counts with each. Further columns are not read; an empty
    table gives an empty answer. Every vector is indexed; recall is below 1 only
    by the stopping test (measured in the tests).
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows = _clean(vectors, id_col, vec_col)
    table = written(index(rows, k + 1), "vectors")
    asked = written(_clean(queries, id_col, vec_col).distinct(), "queries")
    dim = table.agg(F.min_by(F.size("v"), "key").alias("dim")).first()["dim"]
    answer = "query_id long, rank int, vec_id long, score double"
    if dim is None:
        return spark.createDataFrame([], answer)
    table, asked = table.where(F.size("v") == dim), asked.where(F.size("v") == dim)
    facts = table.agg(F.count("*").alias("n"), F.lit(dim).alias("dim"),
                      F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("far")).first()
    far, axes, ratio = float(facts["far"]), directions(facts["dim"]), stop_ratio(confidence)

    def project(v: np.ndarray, complete: bool) -> np.ndarray:
        rest = np.sqrt(np.maximum(0, far - (v * v).sum(1))) if complete else np.zeros(len(v))
        return np.column_stack([v, rest]) @ axes

    n_cells = max(1, -(-facts["n"] // cell_rows))
    if n_cells > 1:
        axes_of = [f"p{j}" for j in range(DIRECTIONS)]

        def projections(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                if len(b):
                    yield pd.DataFrame(project(np.stack(b["v"].to_numpy()), True), columns=axes_of)

        wanted = max(LEAST, SAMPLE * n_cells)
        sample = table.select("v").sample(min(1.0, 1.1 * wanted / facts["n"]), seed=11).mapInPandas(
            projections, ", ".join(f"{c} double" for c in axes_of)).limit(wanted).toPandas()
        tree = _grown(sample.to_numpy(), n_cells)
    else:
        tree = 0
    low, high = _boxes(tree, DIRECTIONS)

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                yield pd.DataFrame({"cell": _cells(tree, project(np.stack(b["v"].to_numpy()), True)), "key": b["key"], "v": b["v"]})

    cells = written(table.select("key", "v").mapInPandas(deal, "cell long, key long, v array<double>"), "cells")
    # one search for each distinct query vector; its answers serve all its rows
    same = asked.withColumnRenamed("id", "query_id")
    distinct = written(same.groupBy("v").agg(F.min("query_id").alias("q")), "distinct")

    def home(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                p = project(np.stack(b["v"].to_numpy()), False)
                yield pd.DataFrame({"cell": np.argmin(_box_distance(p, low, high), axis=1), "q": b["q"], "v": b["v"],
                                    "known": np.full(len(b), -np.inf)})

    def visit(key: tuple, data: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        if not len(data) or not len(ask):
            return pd.DataFrame({"q": [], "key": [], "score": []}).astype({"q": "int64", "key": "int64", "score": "float64"})
        v = np.stack(data["v"].to_numpy())
        index_ = Tree(v, project(v, True), data["key"].to_numpy())
        out = []
        for a in range(0, len(ask), BLOCK):
            part = ask.iloc[a:a + BLOCK]
            q = np.stack(part["v"].to_numpy())
            keys, scores = index_.search(q, project(q, False), far, k + 1, part["known"].to_numpy().copy(), ratio)
            found = keys >= 0
            out.append(pd.DataFrame({"q": np.repeat(part["q"].to_numpy(), found.sum(1)), "key": keys[found], "score": scores[found]}))
        return pd.concat(out)

    asks = "cell long, q long, v array<double>, known double"

    def visits(ask: DataFrame) -> DataFrame:
        # the queries of a cell go in as many blocks as there are, each meeting a copy of that cell's rows;
        # cells that no query visits take no part
        ask = written(ask, "asks")
        visited = if_small(written(ask.groupBy(F.col("cell").alias("cell_")).agg(
            F.ceil(F.count("*") / (8 * BLOCK)).cast("int").alias("blocks")), "visited"), 64)
        data = (cells.join(visited, F.col("cell") == F.col("cell_"))
                .select("cell", "key", "v", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("part")))
        ask = (ask.join(visited, F.col("cell") == F.col("cell_"))
               .select("cell", "q", "v", "known", F.pmod(F.xxhash64("q"), F.col("blocks")).cast("int").alias("part")))
        return (data.groupBy("cell", "part").cogroup(ask.groupBy("cell", "part"))
                .applyInPandas(visit, "q long, key long, score double"))

    first = distinct.mapInPandas(home, asks)
    found = written(visits(first), "found")
    if n_cells > 1:
        kth = found.groupBy("q").agg(F.sort_array(F.collect_list("score"), asc=False).alias("s")).select(
            "q", F.when(F.size("s") > k, F.col("s")[k]).otherwise(float("-inf")).alias("known"))
        second = first.drop("known").join(kth, "q", "left").fillna(float("-inf"), ["known"])

        def others(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                if not len(b):
                    continue
                q = np.stack(b["v"].to_numpy())
                radius = np.maximum(0, (q * q).sum(1) + far - 2 * b["known"].to_numpy())
                go = _box_distance(project(q, False), low, high) <= ratio * radius[:, None]
                go[np.arange(len(b)), b["cell"].to_numpy()] = False
                i, cell = np.nonzero(go)
                yield pd.DataFrame({"cell": cell, "q": b["q"].to_numpy()[i], "v": b["v"].to_numpy()[i], "known": b["known"].to_numpy()[i]})

        more = visits(second.select("cell", "q", "v", "known").mapInPandas(others, asks))
        found = found.unionByName(written(more, "more"))
    best = Window.partitionBy("q").orderBy(F.desc("score"), "key")
    near = (found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1)
            .join(table.select("key", "ids", F.col("v").alias("w")), "key")
            .select("q", "ids", "w"))
    # the measure itself, on the original vectors and in one order of addition, decides the ranks
    exact = (near.join(distinct, "q").select("q", F.explode("ids").alias("vec_id"), F.aggregate(
        F.zip_with("v", "w", lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x).alias("score")))
    top = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    lists = (exact.withColumn("n", F.row_number().over(top)).where(F.col("n") <= k + 1)
             .groupBy("q").agg(F.array_sort(F.collect_list(F.struct("n", "vec_id", "score"))).alias("list")))
    pairs = same.join(distinct, "v").select("query_id", "q").join(lists, "q")
    answers = pairs.select("query_id", F.posexplode(F.slice(F.filter(
        "list", lambda x: x["vec_id"] != F.col("query_id")), 1, k)).alias("rank", "x"))
    return answers.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"),
                          F.col("x.score").alias("score"))
