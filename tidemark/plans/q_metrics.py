"""Evaluation queries (E01-E05, L11, X20) on rule-based predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import metrics as M
from tidemark.plans.registry import register
from tidemark.sources import testdata as td


def _r(c, d=6):
    return F.round(F.col(c), d).alias(c)


def _census_scored(spark, sf_dir):
    c = td.census(spark, sf_dir)
    return c.select("o_orderkey", (F.col("income") == ">50K").cast("int").alias("y"),
                    F.col("o_totalprice").alias("score"),
                    (F.col("o_totalprice") > 250000).cast("int").alias("pred"))


_SCORED_SQL = f"""
{td.CENSUS_SQL},
s AS (SELECT o_orderkey, CAST(income = '>50K' AS INTEGER) AS y, o_totalprice AS score,
             CAST(o_totalprice > 250000 AS INTEGER) AS pred FROM census)
"""

_METRIC_SQL = """
SELECT tp, fp, fn, tn, round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision,
       round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
       round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy,
       round(coalesce(2 * (tp / nullif(tp + fp, 0)) * (tp / nullif(tp + fn, 0))
             / nullif((tp / nullif(tp + fp, 0)) + (tp / nullif(tp + fn, 0)), 0), 0), 6) AS f1,
       round(coalesce(1.25 * (tp / nullif(tp + fp, 0)) * (tp / nullif(tp + fn, 0))
             / nullif(0.25 * (tp / nullif(tp + fp, 0)) + (tp / nullif(tp + fn, 0)), 0), 0), 6) AS f_beta
FROM c
"""

_MCOLS = ["precision", "recall", "accuracy", "f1", "f_beta"]


@register("binary_metrics", f"""
WITH {_SCORED_SQL},
c AS (SELECT CAST(sum(CAST(y = 1 AND pred = 1 AS INTEGER)) AS BIGINT) AS tp,
             CAST(sum(CAST(y = 0 AND pred = 1 AS INTEGER)) AS BIGINT) AS fp,
             CAST(sum(CAST(y = 1 AND pred = 0 AS INTEGER)) AS BIGINT) AS fn,
             CAST(sum(CAST(y = 0 AND pred = 0 AS INTEGER)) AS BIGINT) AS tn FROM s)
{_METRIC_SQL}
""")
def q_binary_metrics(spark, sf_dir):
    """E01 + X20: accuracy, precision, recall, F1, F0.5 of a threshold rule."""
    m = M.binary_metrics(_census_scored(spark, sf_dir), "y", "pred", 0.5)
    return m.select("tp", "fp", "fn", "tn", *[_r(c) for c in _MCOLS])


@register("naive_predictor", f"""
WITH {_SCORED_SQL},
c AS (SELECT CAST(sum(y) AS BIGINT) AS tp, CAST(sum(1 - y) AS BIGINT) AS fp,
             CAST(0 AS BIGINT) AS fn, CAST(0 AS BIGINT) AS tn FROM s)
{_METRIC_SQL}
""")
def q_naive_predictor(spark, sf_dir):
    """Always-positive baseline, accuracy and F0.5."""
    m = M.naive_predictor(_census_scored(spark, sf_dir), "y", 0.5)
    return m.select("tp", "fp", "fn", "tn", *[_r(c) for c in _MCOLS])


@register("confusion_matrix", f"""
WITH {_SCORED_SQL}
SELECT y, count(*) FILTER (WHERE pred = 0) AS "0", count(*) FILTER (WHERE pred = 1) AS "1" FROM s GROUP BY y
""")
def q_confusion_matrix(spark, sf_dir):
    """True class x predicted class counts (pivot with explicit classes)."""
    return M.confusion_matrix(_census_scored(spark, sf_dir), "y", "pred", [0, 1])


@register("roc_points", f"""
WITH {_SCORED_SQL},
g AS (SELECT score, CAST(sum(y) AS BIGINT) AS pos, CAST(sum(1 - y) AS BIGINT) AS neg FROM s GROUP BY score),
c AS (SELECT score, CAST(sum(pos) OVER (ORDER BY score DESC) AS BIGINT) AS tp,
             CAST(sum(neg) OVER (ORDER BY score DESC) AS BIGINT) AS fp,
             sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM g)
SELECT score, tp, fp, round(tp / P, 6) AS tpr, round(fp / N, 6) AS fpr, round(tp / (tp + fp), 6) AS precision FROM c
""")
def q_roc_points(spark, sf_dir):
    """ROC / PR curve points per distinct score (two-level prefix sums)."""
    r = M.roc_points(_census_scored(spark, sf_dir), "y", "score")
    return r.select("score", "tp", "fp", _r("tpr"), _r("fpr"), _r("precision"))


@register("area_under_roc", f"""
WITH {_SCORED_SQL},
g AS (SELECT score, sum(y) AS pos, sum(1 - y) AS neg FROM s GROUP BY score),
c AS (SELECT *, sum(neg) OVER (ORDER BY score) - neg AS below FROM g)
SELECT round(sum(pos * (below + 0.5 * neg)) / (sum(pos) * sum(neg)), 6) AS auc FROM c
""")
def q_area_under_roc(spark, sf_dir):
    """E02 (exact form): area under ROC of the raw score."""
    return M.area_under_roc(_census_scored(spark, sf_dir), "y", "score").select(_r("auc"))


@register("area_under_pr", f"""
WITH {_SCORED_SQL},
g AS (SELECT score, sum(y) AS pos, sum(1 - y) AS neg FROM s GROUP BY score),
c AS (SELECT score, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp, sum(pos) OVER () AS P FROM g),
p AS (SELECT score, tp / P AS recall, tp / (tp + fp) AS precision FROM c),
l AS (SELECT recall, precision, lag(recall, 1, 0) OVER (ORDER BY score DESC) AS r0,
             coalesce(lag(precision) OVER (ORDER BY score DESC), precision) AS p0 FROM p)
SELECT round(sum((recall - r0) * (precision + p0) / 2), 6) AS auc_pr FROM l
""")
def q_area_under_pr(spark, sf_dir):
    """E02 (exact form): area under the precision-recall curve of the raw score."""
    return M.area_under_pr(_census_scored(spark, sf_dir), "y", "score").select(_r("auc_pr"))


@register("per_class_report", """
WITH p AS (SELECT l.quality, l.toxic, CAST(d.n_chars > 300 AS INTEGER) AS pred_quality,
                  CAST(d.n_chars % 7 = 0 AS INTEGER) AS pred_toxic
           FROM labels l JOIN documents d USING (doc_id)),
long AS (SELECT 'quality' AS category, quality AS y, pred_quality AS yhat FROM p
         UNION ALL SELECT 'toxic', toxic, pred_toxic FROM p),
k AS (SELECT category, c.class,
             CAST(sum(CAST(y = c.class AND yhat = c.class AS INTEGER)) AS BIGINT) AS tp,
             CAST(sum(CAST(yhat = c.class AS INTEGER)) AS BIGINT) AS predicted,
             CAST(sum(CAST(y = c.class AS INTEGER)) AS BIGINT) AS support
      FROM long, (VALUES (0), (1)) c(class) GROUP BY ALL)
SELECT category, CAST(class AS INTEGER) AS class, tp, predicted, support,
       round(coalesce(tp / nullif(predicted, 0), 0), 6) AS precision,
       round(coalesce(tp / nullif(support, 0), 0), 6) AS recall,
       round(coalesce(2 * coalesce(tp / nullif(predicted, 0), 0) * coalesce(tp / nullif(support, 0), 0)
             / nullif(coalesce(tp / nullif(predicted, 0), 0) + coalesce(tp / nullif(support, 0), 0), 0), 0), 6) AS f1
FROM k
""")
def q_per_class_report(spark, sf_dir):
    """Precision / recall / F1 / support per label column and class."""
    lab = td.table(spark, sf_dir, "labels")
    doc = td.table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    p = lab.join(doc, "doc_id").select(
        "quality", "toxic", (F.col("n_chars") > 300).cast("int").alias("pred_quality"),
        (F.col("n_chars") % 7 == 0).cast("int").alias("pred_toxic"))
    r = M.per_class_report(p, [("quality", "pred_quality"), ("toxic", "pred_toxic")])
    return r.select("category", F.col("class").cast("int").alias("class"), "tp", "predicted", "support",
                    _r("precision"), _r("recall"), _r("f1"))
