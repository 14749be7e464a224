"""Many numbers of clusters at once against MLlib's single fits and plain numpy rounds."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.linalg import Vectors

from tidemark.operators.kmeans_many import _scan, _start, kmeans_many


@pytest.fixture(scope="module")
def points():
    r = np.random.default_rng(5)
    centres = r.standard_normal((7, 3)) * 6
    return np.concatenate([centres[i % 7] + r.standard_normal(3) * 0.7 for i in range(1500)]).reshape(-1, 3)


@pytest.fixture(scope="module")
def frame(spark, points):
    return spark.createDataFrame([(Vectors.dense(p),) for p in points], ["features"]).repartition(4).persist()


def test_costs_are_at_most_one_percent_above_mllib(spark, frame):
    got = kmeans_many(frame, [2, 3, 5, 7, 10])
    for k, m in got.items():
        assert m.centres.shape == (k, 3)
        assert m.cost <= 1.01 * KMeans(k=k, seed=42, maxIter=20).fit(frame).summary.trainingCost


def test_rounds_and_costs_equal_numpy(spark, frame, points):
    got = kmeans_many(frame, [4], restarts=1, max_iter=3, tol=0.0)[4]
    centres = _start(np.array([r.features.toArray() for r in frame.limit(10_000).collect()]), 4, np.random.default_rng(42))
    for _ in range(3):
        at = ((points[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        centres = np.array([points[at == j].mean(0) if (at == j).any() else centres[j] for j in range(4)])
    assert np.allclose(got.centres, centres)
    assert np.isclose(got.cost, ((points[:, None] - centres[None]) ** 2).sum(2).min(1).sum())


def test_scans_do_not_grow_with_the_number_of_models(spark, frame, monkeypatch):
    from tidemark.operators import kmeans_many as km
    calls = []
    monkeypatch.setattr(km, "_scan", lambda rows, models: calls.append(len(models)) or _scan(rows, models))
    kmeans_many(frame, [2, 4, 6, 8], max_iter=5)
    assert len(calls) <= 6 and calls[0] == calls[-1] == 12


def test_edges(spark):
    same = spark.createDataFrame([(Vectors.dense([1.0, 2.0]),)] * 30, ["features"])
    got = kmeans_many(same, [1, 3])
    assert got[1].cost == got[3].cost == 0 and (got[3].centres == [1.0, 2.0]).all()
    assert kmeans_many(same.limit(0), [2])[2].cost == 0


def test_rows_are_dealt_out_to_tasks_of_bounded_size(spark):
    """A table in one file is one split: tasks must grow with its rows."""
    from tidemark.operators import model as ML
    rows = spark.range(0, 1000, 1, 1)
    assert ML.dealt_out(rows, 100).rdd.getNumPartitions() == 10
    assert ML.dealt_out(rows, 1000).rdd.getNumPartitions() == 1
    assert ML.dealt_out(rows, 300).distinct().count() == 1000
