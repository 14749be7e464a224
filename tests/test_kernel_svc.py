"""Support vectors over cosines that are never kept: MLlib's answer, and no table or cached rows of them."""
import numpy as np
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tidemark.operators import model as ML
from tidemark.operators.kernel import cosines, fourier_map


def rows(spark, n=900):
    r = np.random.default_rng(2)
    x = r.standard_normal((n, 3)) * 1.5
    y = ((x ** 2).sum(1) < 5) != (r.random(n) < 0.1)
    return spark.createDataFrame([(i, float(b), Vectors.dense(a)) for i, (a, b) in enumerate(zip(x, y))], ["id", "label", "features"]).repartition(3).persist()


def test_the_fit_is_mllibs(spark):
    df, kernel = rows(spark), fourier_map(3, 24, 0.5)
    wide = kernel.transform(df)
    for steps in (1, 3, 12):
        a = ML.make_classifier("svc", features="kernel_features", maxIter=steps).fit(wide)
        b = ML.make_classifier("kernel_svc", kernel=kernel, maxIter=steps).fit(df)
        assert np.allclose(b.coefficients, a.coefficients.toArray(), rtol=1e-5, atol=1e-6) and abs(a.intercept - b.intercept) < 1e-5
    got = a.transform(wide).select("id", F.col("prediction").alias("a")).join(b.transform(df).select("id", "prediction"), "id")
    assert got.where("a <> prediction").count() == 0


def test_no_cosines_are_written_or_persisted(spark):
    """256 features took 2 KB a row in a table and as much again among the executors' blocks."""
    jsc, df = spark.sparkContext._jsc, rows(spark, 200)
    df.count()
    before = set(jsc.getPersistentRDDs())
    seen, kernel = set(), fourier_map(3, 16, 0.5)

    class Watched:
        def __getattr__(self, name):
            seen.update(set(jsc.getPersistentRDDs()) - before)
            return getattr(df, name)

    ML.make_classifier("kernel_svc", kernel=kernel, maxIter=2).fit(Watched())
    assert not seen | (set(jsc.getPersistentRDDs()) - before)


def test_query_reads_no_table_of_cosines(spark):
    from tidemark.plans import q_models
    assert not {"written_table", "census-kernel"} & {*q_models.q_census_kernel_svc.__code__.co_names, *map(str, q_models.q_census_kernel_svc.__code__.co_consts)}


def test_cosines():
    y = np.concatenate([np.random.default_rng(1).normal(0, 20, 10_000), [0.0, np.pi / 2, -np.pi, 1e4]])
    assert np.abs(cosines(y.copy()) - np.cos(y)).max() < 1e-11
    assert np.isnan(cosines(np.array([np.nan, np.inf]))).all()
