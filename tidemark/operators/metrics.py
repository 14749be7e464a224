"""Evaluation as aggregations.

Every metric is a groupBy over (label, prediction) or over distinct scores;
curves use the two-level distributed prefix sum, never a global window over
raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import f_beta, safe_ratio
from tidemark.operators.rank import prefix_sum


def confusion_matrix(df: DataFrame, label: str, pred: str, classes: Sequence) -> DataFrame:
    """One row per true class, one column per predicted class."""
    return (df.groupBy(label).pivot(pred, list(classes)).agg(F.count(F.lit(1)))
            .fillna(0, subset=[str(c) for c in classes]))


def binary_metrics(df: DataFrame, label: str, pred: str, beta: float = 0.5) -> DataFrame:
    """E01 + X20: accuracy, precision, recall, F1 and F-beta in one pass."""
    y, p = F.col(label).cast("int"), F.col(pred).cast("int")
    c = df.agg(F.sum(((y == 1) & (p == 1)).cast("long")).alias("tp"),
               F.sum(((y == 0) & (p == 1)).cast("long")).alias("fp"),
               F.sum(((y == 1) & (p == 0)).cast("long")).alias("fn"),
               F.sum(((y == 0) & (p == 0)).cast("long")).alias("tn"))
    c = c.withColumns({"precision": F.coalesce(safe_ratio("tp", F.col("tp") + F.col("fp")), F.lit(0.0)),
                       "recall": F.coalesce(safe_ratio("tp", F.col("tp") + F.col("fn")), F.lit(0.0)),
                       "accuracy": safe_ratio(F.col("tp") + F.col("tn"),
                                              F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn"))})
    return c.withColumns({"f1": f_beta("precision", "recall", 1.0),
                          f"f_beta": f_beta("precision", "recall", beta)})


def naive_predictor(df: DataFrame, label: str, beta: float = 0.5) -> DataFrame:
    """Metrics of always predicting the positive class."""
    return binary_metrics(df.withColumn("__p", F.lit(1)), label, "__p", beta)


def score_counts(df: DataFrame, label: str, score: str) -> DataFrame:
    """Positives and negatives per distinct score (pre-aggregation)."""
    y = F.col(label).cast("int")
    return df.groupBy(score).agg(F.sum(y).cast("long").alias("pos"), F.sum(1 - y).cast("long").alias("neg"))


def roc_points(df: DataFrame, label: str, score: str, n_buckets: int | None = None) -> DataFrame:
    """Per distinct threshold (descending), cumulative TP/FP, TPR, FPR and
    precision. Ties share one point."""
    sc = score_counts(df, label, score)
    cum = prefix_sum(sc, score, ["pos", "neg"], n_buckets, desc=True, totals=True)
    return cum.select(score, F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
                      safe_ratio("cum_pos", "total_pos").alias("tpr"), safe_ratio("cum_neg", "total_neg").alias("fpr"),
                      safe_ratio("cum_pos", F.col("cum_pos") + F.col("cum_neg")).alias("precision"))


def area_under_roc(df: DataFrame, label: str, score: str, n_buckets: int | None = None) -> DataFrame:
    """E02 (exact): P(score+ > score-) + 0.5 P(tie), from per-score counts and
    the distributed prefix of negatives below each score."""
    sc = score_counts(df, label, score)
    cum = prefix_sum(sc, score, ["neg"], n_buckets)  # negatives with score <= s
    part = cum.select((F.col("pos") * (F.col("cum_neg") - F.col("neg") + 0.5 * F.col("neg"))).alias("w"),
                      "pos", "neg")
    a = part.agg(F.sum("w").alias("w"), F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    return a.select(safe_ratio("w", F.col("P") * F.col("N")).alias("auc"))


def area_under_pr(df: DataFrame, label: str, score: str, n_buckets: int | None = None) -> DataFrame:
    """E02 (exact): area under the precision-recall curve by the trapezoid rule over
    all distinct scores, the curve starting at recall 0 with the first point's
    precision (MLlib's rule, without its bins)."""
    sc = score_counts(df, label, score)
    cum = prefix_sum(sc, score, ["pos", "neg"], n_buckets, desc=True, totals=True)
    # a point's predecessor has its counts less the score's own, so no row looks at another
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    p0, n0 = F.col("cum_pos") - F.col("pos"), F.col("cum_neg") - F.col("neg")
    before = F.when(p0 + n0 > 0, F.try_divide(p0, p0 + n0)).otherwise(precision)
    part = cum.select(((precision + before) / 2 * F.col("pos")).alias("w"), "total_pos")
    a = part.agg(F.sum("w").alias("w"), F.max("total_pos").alias("P"))
    return a.select(safe_ratio("w", "P").alias("auc_pr"))


def per_class_report(df: DataFrame, pairs: Sequence[tuple[str, str]], classes: Sequence[int] = (0, 1)) -> DataFrame:
    """Precision, recall, F1 and support per (label column, class).

    Label/prediction column pairs are stacked long, then ONE groupBy gives the
    counts of (category, y, yhat), from which every class's numbers are sums."""
    parts = ", ".join(f"'{y}', CAST(`{y}` AS INT), CAST(`{p}` AS INT)" for y, p in pairs)
    long = df.selectExpr(f"stack({len(pairs)}, {parts}) AS (category, y, yhat)")
    counts = long.groupBy("category", "y", "yhat").agg(F.count(F.lit(1)).alias("n"))
    c = F.col("class")
    out = (counts.withColumn("class", F.explode(F.array(*[F.lit(k) for k in classes]))).groupBy("category", "class").agg(
        F.sum(F.when((F.col("y") == c) & (F.col("yhat") == c), F.col("n")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("yhat") == c, F.col("n")).otherwise(0)).alias("predicted"),
        F.sum(F.when(F.col("y") == c, F.col("n")).otherwise(0)).alias("support")))
    out = out.withColumns({"precision": F.coalesce(safe_ratio("tp", "predicted"), F.lit(0.0)),
                           "recall": F.coalesce(safe_ratio("tp", "support"), F.lit(0.0))})
    return out.withColumn("f1", f_beta("precision", "recall", 1.0))
