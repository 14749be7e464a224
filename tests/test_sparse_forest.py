"""The forest on sparse rows: cuts by brute force, level with MLlib's forest, held by its terms and not by its width."""
import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.linalg import SparseVector, Vectors
from pyspark.sql import functions as F

from tidemark.operators import sparse_forest as S


def rows(spark, n, width, seed, noise=0.05):
    """Class 1 if two of three words come, the rest is noise; some words weigh less than zero."""
    rng, out = np.random.default_rng(seed), []
    for i in range(n):
        x = {int(j): float(rng.normal()) for j in rng.choice(np.arange(3, width), 8, replace=False)}
        on = rng.random(3) < 0.5
        x |= {j: float(0.5 + rng.random()) for j in range(3) if on[j]}
        out.append((i, SparseVector(width, sorted(x.items())), float((on.sum() >= 2) != (rng.random() < noise))))
    return spark.createDataFrame(out, ["id", "features", "label"])


def test_the_first_cut_is_the_best_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_ROWS", 16)
    monkeypatch.setattr(S, "ENTRIES", 7)
    df = rows(spark, 90, 12, 1).repartition(3).persist()
    m = S.SparseForest(numTrees=4, maxDepth=1, minInstancesPerNode=3, seed=5).fit(df)
    r = df.select("label", *S.sparse("features")).mapInArrow(S._sliced(spark.sparkContext.broadcast(m.cuts)), S._BLOCK).collect()
    binned, w, y = [], [], []
    import pyarrow as pa
    for b in S._blocks(iter([pa.RecordBatch.from_pylist([x.asDict() for x in r])]), 12):
        dense = np.tile(m.cuts.bins(np.arange(12), np.zeros(12)).astype(int), (b.n, 1))
        for f in range(12):
            dense[b.rows[b.start[f]:b.start[f + 1]], f] = b.bins[b.start[f]:b.start[f + 1]]
        binned.append(dense), w.append(S.weights(b.key, b.n, 4, 5)), y.append(b.labels)
    x, w, y = np.concatenate(binned), np.concatenate(w, 1), np.concatenate(y)
    for t in range(4):
        assert m.trees.counts[t].tolist() == [w[t][y == c].sum() for c in (0, 1)]

        def impurity(on):
            a = np.array([w[t][on & (y == c)].sum() for c in (0, 1)], float)
            return a.sum() - (a ** 2).sum() / max(a.sum(), 1), a.sum()

        drawn = S.Layout.of(np.array([t]), 4, m.cuts.number, 5).features
        able = [(sum(impurity(on)[0] for on in (x[:, f] <= c, x[:, f] > c)), f, c) for f in drawn for c in range(m.cuts.number[f])
                if min(impurity(x[:, f] <= c)[1], impurity(x[:, f] > c)[1]) >= 3]
        f, c = m.trees.feature[t], m.trees.cut[t]
        assert sum(impurity(on)[0] for on in (x[:, f] <= c, x[:, f] > c)) == pytest.approx(min(able)[0])
        assert m.trees.counts[m.trees.left[t]].tolist() == [w[t][(x[:, f] <= c) & (y == k)].sum() for k in (0, 1)]


def test_level_with_mllib_and_the_same_in_small_passes(spark, monkeypatch):
    train, test = rows(spark, 600, 12, 2).persist(), rows(spark, 400, 12, 3).persist()
    ev = MulticlassClassificationEvaluator(metricName="accuracy")
    options = {"numTrees": 20, "maxDepth": 5, "seed": 1}
    ours = S.SparseForest(**options).fit(train)
    a, b = ev.evaluate(ours.transform(test)), ev.evaluate(RandomForestClassifier(**options).fit(train).transform(test))
    assert a > 0.85 and a >= b - 0.04
    p = ours.transform(test).select("probability", "prediction").collect()
    assert all(abs(sum(r.probability) - 1) < 1e-9 and r.prediction == float(r.probability[1] > r.probability[0]) for r in p)
    dense = test.select("id", F.udf(lambda v: Vectors.dense(v.toArray()), test.schema["features"].dataType)("features").alias("features"))
    assert ours.transform(dense).orderBy("id").select("prediction").collect() == ours.transform(test).orderBy("id").select("prediction").collect()
    monkeypatch.setattr(S, "PASS_COUNTS", 20_000)
    again = S.SparseForest(**options).fit(train)
    assert sorted(again.trees.counts.sum(1).tolist())[-20:] == sorted(ours.trees.counts.sum(1).tolist())[-20:]
    assert abs(ev.evaluate(again.transform(test)) - a) < 0.05


def test_rows_are_held_by_their_terms(spark):
    """2^18 terms: a row of MLlib's forest is an array of a megabyte."""
    df = rows(spark, 300, 1 << 18, 4)
    cuts = S.fit_cuts(df.select(*S.sparse("features")), 1 << 18, 300, 32, 1)
    blocks = df.select("label", *S.sparse("features")).mapInArrow(S._sliced(spark.sparkContext.broadcast(cuts)), S._BLOCK)
    size = sum(len(v) for r in blocks.collect() for v in r if not isinstance(v, int))
    assert size < 300 * 11 * 20
    m = S.SparseForest(numTrees=5, maxDepth=3).fit(df)
    assert m.transform(df).where("prediction IS NULL").count() == 0


def test_search_over_texts_uses_it(spark):
    from tidemark.plans import q_models
    assert "SparseForest" in q_models.q_message_forest_search.__code__.co_names


def test_one_class_or_equal_rows_give_leaves(spark):
    one = spark.createDataFrame([(SparseVector(5, [1], [1.0]), 1.0)] * 4, ["features", "label"])
    m = S.SparseForest(numTrees=3).fit(one)
    assert len(m.trees.tree) == 3 and {r.prediction for r in m.transform(one).collect()} <= {0.0, 1.0}
    two = spark.createDataFrame([(SparseVector(5, [1], [1.0]), float(i % 2)) for i in range(6)], ["features", "label"])
    assert len(S.SparseForest(numTrees=3).fit(two).trees.tree) == 3


def test_points_of_a_search_share_their_cuts(spark, monkeypatch):
    """Four points on the same texts: cuts chosen once, and each model is the one fitted alone."""
    from tidemark.operators import text_model as T
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(" ".join(f"w{j}" for j in rng.integers(0, 40, 12)), float(i % 2)) for i in range(120)], ["message", "label"]).coalesce(2).persist()
    chosen, choose = [], S.fit_cuts
    monkeypatch.setattr(S, "fit_cuts", lambda *a: chosen.append(1) or choose(*a))
    pipe = T.text_pipeline(S.SparseForest(labelCol="label", maxDepth=4))
    grid = T.text_grid(pipe, {"ngramMax": [1]}, {"numTrees": [3, 5], "minInstancesPerNode": [1, 2]})
    fits = pipe.fitMultiple(df, grid)
    models = dict(next(fits) for _ in grid)
    assert len(models) == 4 and len(chosen) == 1
    for i, point in enumerate(grid):
        alone = pipe.fit(df, point)
        a, b = models[i].stages[-1], alone.stages[-1]
        assert a.trees.feature.tolist() == b.trees.feature.tolist() and a.trees.counts.tolist() == b.trees.counts.tolist()


def test_tasks_of_a_worker_draw_features_once_a_pass(monkeypatch):
    drawn, draw = [], S.Layout.of
    monkeypatch.setattr(S.Layout, "of", staticmethod(lambda *a: drawn.append(1) or draw(*a)))
    S._layout_of_pass.cache_clear()
    number, nodes = np.full(50, 3), np.arange(4)
    two = [S._layout_of_pass(nodes.tobytes(), 8, number.tobytes(), 1) for _ in range(2)]
    assert len(drawn) == 1 and two[0].features.tolist() == draw(nodes, 8, number, 1).features.tolist()
