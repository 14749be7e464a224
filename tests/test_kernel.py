"""Random Fourier features, distinct counts in two levels, label ranks."""

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tidemark.operators import model as ML
from tidemark.operators.kernel import fourier_map
from tests.test_plans import plan


def test_products_of_features_are_kernel_values(spark):
    r = np.random.default_rng(1)
    x = r.standard_normal((40, 5))
    df = spark.createDataFrame([(i, Vectors.dense(v)) for i, v in enumerate(x)], ["id", "features"])
    size, gamma = 2048, 0.3
    out = fourier_map(5, size, gamma).transform(df).select("id", vector_to_array("kernel_features").alias("z")).orderBy("id").collect()
    z = np.array([o.z for o in out])
    exact = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(2))
    assert np.abs(z @ z.T - exact).max() < 5 / np.sqrt(size)  # 5 standard errors


def test_gaussian_kernel_separates_what_a_line_cannot(spark):
    r = np.random.default_rng(2)
    x = r.standard_normal((1200, 2)) * 1.5
    y = ((x ** 2).sum(1) < 2.5).astype(float)
    df = spark.createDataFrame([(float(b), Vectors.dense(a), i % 4 == 0) for i, (a, b) in enumerate(zip(x, y))], ["label", "features", "held"])
    df = fourier_map(2, 200, 0.7).transform(df).persist()

    def accuracy(col):
        m = ML.make_classifier("svc", features=col, maxIter=50).fit(df.where("not held"))
        return m.transform(df.where("held")).select(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]

    assert accuracy("kernel_features") > 0.93 > accuracy("features")


def test_distinct_counts_do_not_expand_rows(spark):
    from tidemark.operators.profile import column_profile
    rows = [(1, 0.0, "a", [1], None), (1, -0.0, "b" * 100, [1], None), (2, float("nan"), "b" * 100, [2, 3], None), (None, float("nan"), None, None, None)]
    df = spark.createDataFrame(rows, "i int, d double, s string, a array<int>, n string")
    got = {r.column_name: (r.n_unique, r.n_total) for r in column_profile(df, None).collect()}
    assert got == {"i": (2, 3), "d": (2, 4), "s": (2, 3), "a": (2, 3), "n": (0, 0)}
    wide = spark.range(50).select(*[(F.col("id") % (i + 1)).alias(f"c{i}") for i in range(85)])
    out = column_profile(wide, None)
    assert "Expand" not in plan(out) and {r.column_name: r.n_unique for r in out.collect()} == {f"c{i}": min(50, i + 1) for i in range(85)}


def test_labels_of_one_frequency_are_ranked_in_ranges(spark):
    from tidemark.operators import encode as E
    df = spark.range(5000).select(F.concat(F.lit("label"), F.col("id")).alias("c")).unionByName(spark.createDataFrame([("top",)] * 3, "c string"))
    got = {r.c: r.i for r in E.frequency_index(df, "c", "i").collect()}
    want = ["top", *sorted(f"label{i}" for i in range(5000))]
    assert got == {c: float(i) for i, c in enumerate(want)}
    text = {r.c: r.i for r in E.frequency_index(df, "c", "i", "alphabetAsc").collect()}
    assert text == {c: float(i) for i, c in enumerate(sorted(want))}
