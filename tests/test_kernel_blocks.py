"""Random Fourier features block by block."""
import math

from pyspark.sql import functions as F

from tidemark.operators.kernel import fourier_map
from tests.test_plans import plan


def exact(m, x):
    if x is None or len(x) != len(m.directions[0]) or None in x:
        return [None] * len(m.phases)
    return [math.cos(sum(a * c for a, c in zip(w, x)) + b) * (2.0 / len(m.phases)) ** 0.5 for w, b in zip(m.directions, m.phases)]


def test_odd_rows_and_many_blocks(spark):
    m = fourier_map(3, 5, 0.4)
    odd = [None, [], [1.0], [1.0, None, 2.0], [1.0, 2.0, 3.0, 4.0], [0.0, -0.0, 1e6], [0.5, -2.0, 7.25], [None, None, None]]
    rows = [(i, odd[i % len(odd)]) for i in range(5000)]
    df = spark.createDataFrame(rows, "id int, x array<double>").coalesce(1)
    got = {r.id: r.z for r in df.select("id", m.column(F.col("x")).alias("z")).collect()}
    for i, x in rows:
        want = exact(m, x)
        assert all(a is b is None or abs(a - b) < 1e-12 for a, b in zip(got[i], want, strict=True))


def test_features_are_no_lambda_over_rows(spark):
    """Lambdas over arrays are interpreted value by value: 256 features of 16 components took minutes."""
    df = spark.createDataFrame([([1.0, 2.0],)], "x array<double>")
    p = plan(df.select(fourier_map(2, 8).column(F.col("x"))))
    assert "ArrowEvalPython" in p and "lambdafunction" not in p
