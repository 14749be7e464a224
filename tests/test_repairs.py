"""Faults that earlier fixtures did not reach: each test fails on the code before its repair."""
import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tidemark.operators import encode as E
from tidemark.operators import metrics as M
from tidemark.operators import profile as P
from tidemark.operators.quantiles import exact_quantiles


def value(rows, col, p, group=None):
    return next(r.value for r in rows if r.column_name == col and r.prob == p and (group is None or r.g == group))


def test_quantiles_of_geometric_values(spark):
    df = spark.range(400_000).select((F.lit(2.0) ** (-(F.col("id") % 1000))).alias("x"))
    rows = exact_quantiles(df, ["x"], [0.0, 0.25, 0.5, 0.75, 1.0]).collect()
    xs = sorted(2.0 ** -(i % 1000) for i in range(400_000))
    for p in (0.0, 0.25, 0.5, 0.75, 1.0):
        at = (len(xs) - 1) * p
        a, b = xs[math.floor(at)], xs[math.ceil(at)]
        assert value(rows, "x", p) == pytest.approx(a + (b - a) * (at - math.floor(at)), rel=1e-12)


def test_quantiles_with_infinity_nan_and_a_hot_value(spark):
    x = (F.when(F.col("id") == 0, float("inf")).when(F.col("id") == 1, float("-inf")).when(F.col("id") % 10 == 3, float("nan"))
         .when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id").cast("double")))
    df = spark.range(200_000).select(x.alias("x"))
    got = exact_quantiles(df, ["x"], [0.0, 0.25, 0.5, 1.0]).collect()
    xs = sorted(float("inf") if i == 0 else float("-inf") if i == 1 else 7.0 if i % 3 == 0 else float(i)
                for i in range(200_000) if i < 2 or i % 10 != 3)
    assert value(got, "x", 0.0) == float("-inf") and value(got, "x", 1.0) == float("inf")
    for p in (0.25, 0.5):
        at = (len(xs) - 1) * p
        a, b = xs[math.floor(at)], xs[math.ceil(at)]
        assert value(got, "x", p) == pytest.approx(a + (b - a) * (at - math.floor(at)))


def test_quantiles_of_many_groups(spark):
    df = spark.range(60_000).select((F.col("id") % 10_000).alias("g"), F.col("id").cast("double").alias("x"),
                                    F.lit(None).cast("double").alias("none"))
    rows = exact_quantiles(df, ["x", "none"], [0.5], group=["g"]).collect()
    assert len(rows) == 10_000
    assert all(r.value == r.g + 25_000 for r in rows)


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "a"), (float("nan"), "a"), (None, "a")], "x double, k string")
    d = P.describe(df, ["x"]).first()
    assert (d["count"], d["mean"], d["max"], d["p50"]) == (2, 1.5, 2.0, 1.5)
    g = P.describe_by(df, "k", ["x"]).first()
    assert (g["count"], g["mean"], g["max"], g["median"]) == (2, 1.5, 2.0, 1.5)
    h = P.histogram(df, "x", 2).orderBy("bin").collect()
    assert [(r.bin, r.lower, r.upper, r.n) for r in h] == [(0, 1.0, 1.5, 1), (1, 1.5, 2.0, 1)]
    assert P.classify_categoricals(df, ["x"]).first().n_levels == 3
    assert E.fit_min_max(df, ["x"]) == {"x": (1.0, 2.0)}


def test_one_hot_keeps_every_level(spark):
    df = spark.createDataFrame([("a-b",), ("a b",), ("中",), ("文",), (None,)], "c string")
    out = E.one_hot(df, ["c"])
    assert sorted(out.columns) == sorted(["c_a-b", "c_a b", "c_中", "c_文"])
    assert all(sum(r) == 1 for r in out.collect()[:4]) and sum(out.collect()[4]) == 0
    with pytest.raises(ValueError):
        E.one_hot(spark.createDataFrame([("b_c", "c")], "a string, a_b string"), ["a", "a_b"])
    with pytest.raises(ValueError):
        E.fit_levels(df, ["c"], max_levels=3)
    assert len(E.fit_levels(df, ["c"], max_levels=4)["c"]) == 4
    v = E.one_hot_vector(df, "c", "v").collect()
    assert sorted(float(r.v.toArray().sum()) for r in v) == [0.0, 1.0, 1.0, 1.0, 1.0]


def test_best_by_any_type(spark):
    rows = [("g", 3, "b", dt.date(2020, 1, 2), 1.0), ("g", 3, "a", dt.date(2020, 1, 2), 2.0), ("g", 3, "a", dt.date(2020, 1, 1), 3.0),
            ("g", 2, "a", dt.date(2019, 1, 1), 4.0), ("g", None, "0", dt.date(2018, 1, 1), 5.0), ("h", None, None, None, 6.0)]
    df = spark.createDataFrame(rows, "k string, n int, t string, d date, x double")
    pick = lambda *order: {r.k: r.x for r in P.best_by(df, ["k"], list(order)).collect()}
    assert pick(("n", "max"), ("t", "min"), ("d", "min")) == {"g": 3.0, "h": 6.0}
    assert pick(("t", "min"), ("n", "max")) == {"g": 5.0, "h": 6.0}
    assert pick(("d", "max"), ("t", "max")) == {"g": 1.0, "h": 6.0}
    assert pick(("n", "min")) == {"g": 4.0, "h": 6.0}
    assert P.best_by(df, [], [("n", "max"), ("t", "min"), ("d", "min")]).first().x == 3.0


def test_area_under_pr_equals_the_unbinned_library_value(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    df = spark.range(3000).select(((F.col("id") * 7919) % 1501).cast("double").alias("score"),
                                  ((F.col("id") * 31) % 7 < 3).cast("int").alias("y"))
    want = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="y", metricName="areaUnderPR", numBins=0).evaluate(df)
    assert M.area_under_pr(df, "y", "score").first().auc_pr == pytest.approx(want, abs=1e-9)


def test_frequency_index_has_no_whole_vocabulary_window(spark):
    df = spark.createDataFrame([("b",), ("b",), ("a",), ("c",), (None,)], "c string")
    got = {r.c: r.i for r in E.frequency_index(df, "c", "i").collect()}
    assert got == {"b": 0.0, "a": 1.0, "c": 2.0, None: None}
    got = {r.c: r.i for r in E.frequency_index(df, "c", "i", order="alphabetAsc").collect()}
    assert got == {"a": 0.0, "b": 1.0, "c": 2.0, None: None}
