"""The forest that is searched as a whole: points cut off from shared trees are the trees they would have grown alone."""
from itertools import product

import numpy as np
from pyspark.ml.linalg import Vectors

from tidemark.operators import grid_forest as G
from tidemark.operators import model as ML


def made(n, seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 9, (n, 6))
    y = ((x[:, 0] + x[:, 1] > 8) != (rng.random(n) < 0.15)).astype(np.int64)
    return x, y


def test_a_point_of_the_shared_trees_is_the_tree_grown_for_it_alone():
    (x, y), (held, _) = made(600, 1), made(300, 2)
    x, held = x.astype(np.uint8), held.astype(np.uint8)
    stops = list(product([3, 9], [2, 6, 30], [0.0, 1e-3]))
    for tree, least in product(range(4), [1, 3]):
        w = G.draws(np.arange(600), tree, 5).astype(np.int64)
        on = w > 0

        def grown(depth, split, decrease):
            spec = G.Spec(4, depth, split, decrease, np.full(6, 8), 2, 5)
            return G.grown(G.Nodes.root(tree, spec), x[on], y[on], w[on], least, int(w.sum()), spec)

        shared = grown(9, 2, 0.0)
        votes = shared.shares(stops)[shared.reached(held)]
        assert len(shared.key) > 30
        for i, stop in enumerate(stops):
            alone = grown(*stop)
            n = alone.counts.sum(1)
            assert n[alone.feature < 0].min() >= least and alone.depth.max() <= stop[0] and n[alone.feature >= 0].min() >= stop[1]
            own = alone.counts[alone.reached(held)].astype(float)
            assert np.allclose(votes[:, i], own / own.sum(1, keepdims=True), atol=1e-6)


def test_search_is_the_same_whatever_a_task_grows_and_level_with_mllib(spark, monkeypatch):
    x, y = made(900, 3)
    df = spark.createDataFrame([(Vectors.dense(a.tolist()), float(b)) for a, b in zip(x, y)], ["features", "label"]).repartition(3).persist()
    grid = {"numTrees": [7, 8], "maxDepth": [4, 12], "minSamplesSplit": [5, 7], "minInstancesPerNode": [2, 3], "minImpurityDecrease": [0.0, 1e-7]}
    ev = ML.f_beta_evaluator("label", 0.5)
    whole = ML.grid_search(ML.make_classifier("grid_rf"), grid, ev, folds=2, train=df)
    assert len(whole.points) == 32 and len(set(whole.avgMetrics)) > 4
    best = whole.points[int(np.argmax(whole.avgMetrics))]
    assert {n: whole.bestModel.getOrDefault(whole.bestModel.getParam(n)) for n in grid} == best
    assert {r.tree for r in whole.bestModel.trees.collect()} == set(range(best["numTrees"]))
    mllib = ML.grid_search(ML.make_classifier("rf"), {"numTrees": [8], "maxDepth": [4]}, ev, folds=2, train=df).avgMetrics[0]
    assert max(whole.avgMetrics) > mllib - 0.05
    monkeypatch.setattr(G, "GROUP_ROWS", 100)
    cut = ML.grid_search(ML.make_classifier("grid_rf"), grid, ev, folds=2, train=df)
    assert np.allclose(cut.avgMetrics, whole.avgMetrics) and cut.bestModel.trees.count() > whole.bestModel.trees.count()


def test_census_search_has_the_references_points():
    from tidemark.plans import q_models
    assert len(list(product(*q_models.CENSUS_FOREST.values()))) == 72 and "CENSUS_FOREST" in q_models.q_census_tuned_forest.__code__.co_names
    assert min(q_models.CENSUS_FOREST["numTrees"]) == 99 and min(q_models.CENSUS_FOREST["maxDepth"]) == 28
