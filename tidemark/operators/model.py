"""Models, tuning and unsupervised steps on MLlib.

Everything trains with MLlib estimators on DataFrames: no data is pulled to
the driver. Driver-side values are only the small fitted parameters
(coefficients, components, centres) turned back into DataFrames for reports.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import SparkContext, inheritable_thread_target
from pyspark.ml.classification import (GBTClassifier, LinearSVC, LogisticRegression,
                                       MultilayerPerceptronClassifier, RandomForestClassifier)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import PCA, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.grid_forest import GridForest
from tidemark.operators.kernel import KernelSVC
from tidemark.operators.kmeans_many import kmeans_many


#: Rows that a task of a search works on, at least.
TASK_ROWS = 25_000


def vectorise(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """columns -> one vector column (nulls are an error, as in MLlib)."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="error").transform(df)


# The reference's search grids per algorithm.
GRIDS = {
    "lr": {"regParam": [0.0, 0.1, 0.3], "elasticNetParam": [0.0, 0.1, 0.3], "maxIter": [10]},
    "rf": {"maxDepth": [2, 4, 6], "maxBins": [12, 24, 32], "numTrees": [10]},
    "gbt": {"maxDepth": [3, 5, 8], "maxBins": [4, 12, 24], "maxIter": [10]},
}


def _without_summary(java_model):
    """A fitted model without its training summary. The summary of a binary classifier holds the session, and a
    session that has had an ``Observation`` cannot be sent to tasks: the model would fail in every later transform."""
    return java_model.setSummary(SparkContext._active_spark_context._jvm.scala.Option.empty())


class _LogisticRegression(LogisticRegression):
    def _create_model(self, java_model):
        return super()._create_model(_without_summary(java_model))


class _RandomForestClassifier(RandomForestClassifier):
    def _create_model(self, java_model):
        return super()._create_model(_without_summary(java_model))


class _LinearSVC(LinearSVC):
    def _create_model(self, java_model):
        return super()._create_model(_without_summary(java_model))


def make_classifier(kind: str, label: str = "label", features: str = "features", seed: int = 42, **kw):
    """L01, L02, L03, L06, L15 estimators by name; their models carry no training summary."""
    if kind == "lr":
        return _LogisticRegression(labelCol=label, featuresCol=features, **kw)
    if kind == "rf":
        return _RandomForestClassifier(labelCol=label, featuresCol=features, seed=seed, **kw)
    if kind == "grid_rf":
        return GridForest(labelCol=label, featuresCol=features, seed=seed)
    if kind == "gbt":
        return GBTClassifier(labelCol=label, featuresCol=features, seed=seed, **kw)
    if kind == "svc":
        return _LinearSVC(labelCol=label, featuresCol=features, **kw)
    if kind == "kernel_svc":
        return KernelSVC(labelCol=label, featuresCol=features, **kw)
    if kind == "mlp":
        return MultilayerPerceptronClassifier(labelCol=label, featuresCol=features, seed=seed, **kw)
    raise ValueError(kind)


def param_grid(est, grid: Mapping[str, Sequence]) -> list:
    b = ParamGridBuilder()
    for name, values in grid.items():
        b = b.addGrid(est.getParam(name), list(values))
    return b.build()


def grid_search(est, grid: Mapping[str, Sequence], evaluator, folds: int = 2, parallelism: int = 4,
                seed: int = 42, train: DataFrame | None = None):
    """K-fold cross-validated grid search, ``parallelism`` fits at once. ``train`` should be written or persisted.
    A ``GridForest`` searches its whole grid on the same trees."""
    if isinstance(est, GridForest):
        return est.search(train, grid, evaluator, folds, parallelism)
    cv = CrossValidator(estimator=est, estimatorParamMaps=param_grid(est, grid), evaluator=evaluator,
                        numFolds=folds, parallelism=parallelism, seed=seed)
    return cv.fit(in_tasks(train)) if train is not None else cv


def in_tasks(train: DataFrame, rows: int = TASK_ROWS) -> DataFrame:
    """``train`` in no more partitions than it has ``rows`` rows each: a search of trees runs thousands of small jobs,
    whose tasks then grow with the rows and not with the cores."""
    return train.coalesce(max(1, -(-train.count() // rows)))


def dealt_out(df: DataFrame, rows: int = TASK_ROWS) -> DataFrame:
    """``df`` in as many partitions as it has ``rows`` rows each (as it is, when one is enough): scans of compressed
    tables are split by bytes, which are few for a model's many rounds over them."""
    tasks = -(-df.count() // rows)
    return df.repartition(tasks) if tasks > 1 else df


def best_params(spark: SparkSession, model, names: Sequence[str]) -> DataFrame:
    """Chosen parameter values of a fitted model, as (param, value)."""
    rows = [(n, str(model.getOrDefault(model.getParam(n)))) for n in names if model.hasParam(n)]
    return spark.createDataFrame(rows, "param string, value string")


def linear_report(spark: SparkSession, model, names: Sequence[str]) -> DataFrame:
    """Intercept and one coefficient per feature of a fitted linear
    model (binary logistic regression or linear SVM), as (term, value)."""
    rows = [("intercept", float(model.intercept))]
    rows += [(n, float(v)) for n, v in zip(names, model.coefficients.toArray().tolist())]
    return spark.createDataFrame(rows, "term string, value double")


def auc(pred: DataFrame, label: str = "label", metric: str = "areaUnderROC") -> float:
    """MLlib's area under ROC / PR over all distinct scores (no binning)."""
    ev = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction", metricName=metric, numBins=0)
    return ev.evaluate(pred)


def f_beta_evaluator(label: str = "label", beta: float = 0.5, positive: float = 1.0):
    """The F-beta scorer of the positive class, passed to the search (Q10)."""
    return MulticlassClassificationEvaluator(labelCol=label, metricName="fMeasureByLabel",
                                             metricLabel=positive, beta=beta)


def fit_timed(est, df: DataFrame):
    t0 = time.time()
    m = est.fit(df)
    return m, time.time() - t0


def importances(spark: SparkSession, model, names: Sequence[str]) -> DataFrame:
    """Feature importances as a long table (feature, importance)."""
    imp = model.featureImportances.toArray().tolist()
    return spark.createDataFrame([(n, float(v)) for n, v in zip(names, imp)], "feature string, importance double")


def slice_features(df: DataFrame, indices: Sequence[int], out: str = "features_top",
                   features: str = "features") -> DataFrame:
    """Keep a subset of the vector (VectorSlicer)."""
    return VectorSlicer(inputCol=features, outputCol=out, indices=list(indices)).transform(df)


def multi_output(train: DataFrame, labels: Sequence[str], make: Callable[[str], object], parallelism: int = 4) -> dict:
    """One model per label column over the same (persisted) features, ``parallelism`` fits at once
    (driver threads: each only submits its jobs)."""
    train = train.persist()
    try:
        with ThreadPoolExecutor(max(1, parallelism)) as pool:
            return dict(zip(labels, pool.map(inheritable_thread_target(train.sparkSession)(lambda lb: make(lb).fit(train)), labels)))
    finally:
        train.unpersist()


# ------------------------------------------------------------ unsupervised

def pca_fit(df: DataFrame, k: int, features: str = "features", out: str = "pca"):
    """PCA on already centred / standardised features (MLlib does not
    centre its output, so standardise first - F05)."""
    return PCA(k=k, inputCol=features, outputCol=out).fit(df)


def total_variance(df: DataFrame, features: str = "features") -> tuple[int, float]:
    """Rows and summed sample variance (n - 1) of the components of a vector column, from the data."""
    from pyspark.ml.stat import Summarizer
    r = df.select(Summarizer.metrics("count", "variance").summary(F.col(features)).alias("s")).first()["s"]
    return int(r["count"]), float(r["variance"].toArray().sum())


def scree_table(spark: SparkSession, pca_model, n_rows: int, total_variance: float) -> DataFrame:
    """F10 + F11 + W04: per component the variance ratio, running total and
    singular value sqrt(lambda * (n - 1)); lambda = ratio * total variance,
    the total being the sample variance (``total_variance``) of the fitted features."""
    ev = pca_model.explainedVariance.toArray().tolist()
    rows, cum = [], 0.0
    for i, r in enumerate(ev):
        cum += r
        lam = r * total_variance
        rows.append((i + 1, float(r), float(cum), float((lam * (n_rows - 1)) ** 0.5)))
    return spark.createDataFrame(rows, "component int, variance_ratio double, cumulative double, singular_value double")


def loadings(spark: SparkSession, pca_model, names: Sequence[str]) -> DataFrame:
    """component x feature weight, long form."""
    pc = pca_model.pc.toArray()
    rows = [(j + 1, n, float(pc[i, j])) for j in range(pc.shape[1]) for i, n in enumerate(names)]
    return spark.createDataFrame(rows, "component int, feature string, weight double")


def kmeans_sweep(df: DataFrame, ks: Sequence[int], features: str = "features", seed: int = 42,
                 max_iter: int = 20) -> list[tuple[int, float]]:
    """L09 + E06: within-cluster cost per k (score = -cost), all k refined by the same scans."""
    found = kmeans_many(df, list(ks), features, seed=seed, max_iter=max_iter)
    return [(k, float(found[k].cost)) for k in ks]


def to_array(col: str):
    return vector_to_array(F.col(col))
