"""Sorts, limits and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def order_by(df: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Total order (range-partitioned sort)."""
    return df.orderBy(*keys)


def head(df: DataFrame, n: int, keys: Sequence[str | Column]) -> DataFrame:
    """First n rows of a stated order (top-k: each task keeps n rows,
    so only k rows per task reach the final merge)."""
    return df.orderBy(*keys).limit(n)


def tail(df: DataFrame, n: int, keys: Sequence[str]) -> DataFrame:
    """Last n rows = first n of the reversed order."""
    return df.orderBy(*[F.desc(k) for k in keys]).limit(n)


def top_n_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int,
                    rank_col: str = "rank") -> DataFrame:
    """N best rows per group (``row_number`` over the group)."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def topk_classes(scores: str | Column, k: int, full_softmax: bool = False) -> Column:
    """The k best (class, score) of a score array, best first, with a
    softmax over the k kept scores only (the reference's rule) or over all.

    Pure array expressions per row: sort the (score, class) structs
    descending (ties: higher class first), slice k, normalise exp(score)."""
    s = F.col(scores) if isinstance(scores, str) else scores
    pairs = F.transform(s, lambda x, i: F.struct(x.cast("double").alias("score"), i.alias("cls")))
    top = F.slice(F.sort_array(pairs, asc=False), 1, k)
    base = top if not full_softmax else pairs
    denom = F.aggregate(base, F.lit(0.0), lambda acc, p: acc + F.exp(p["score"]))
    return F.transform(top, lambda p: F.struct(p["cls"].alias("cls"), p["score"].alias("score"),
                                                (F.exp(p["score"]) / denom).alias("prob")))


def running_total(df: DataFrame, order: Sequence[str], value: str, out: str,
                  partition: Sequence[str] = ()) -> DataFrame:
    """Cumulative sum in a stated order (rows up to the current one).

    Without a partition the window runs in ONE task - use it only on small
    tables (a scree table, a per-bucket summary); ``prefix_sum`` below is the
    distributed form."""
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.sum(value).over(w))


def prefix_sum(df: DataFrame, order: str, values: Sequence[str], n_buckets: int | None = None,
               desc: bool = False, totals: bool = False) -> DataFrame:
    """Distributed running totals over a global order (two-level scan).

    Rows are cut into ~``n_buckets`` ranges of ``order`` (as many as the session
    has shuffle partitions, if not given) holding about the same number of rows (boundaries from one ``percentile_approx`` pass, at
    most ``n_buckets`` values on the driver), so a skewed value distribution
    does not pile rows into one task. Per-range totals (tiny) get their
    prefix in one small window; each range then runs its own window,
    partitioned by range, plus the carry-in of all earlier ranges. Ties in
    ``order`` land in the same range and are summed together (range frame),
    so the running total at a value includes every row with that value.
    ``totals`` adds ``total_<v>`` (grand totals, from the per-range table)."""
    from pyspark.ml.feature import Bucketizer
    if n_buckets is None:
        n_buckets = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    o = F.col(order).cast("double")
    probs = [i / n_buckets for i in range(1, n_buckets)]
    qs = df.agg(F.percentile_approx(o, probs, max(10_000, 20 * n_buckets)).alias("q")).first()["q"] or []
    splits = [float("-inf")] + sorted({float(v) for v in qs}) + [float("inf")]
    x = df.withColumn("__o", o)
    if len(splits) > 2:
        x = Bucketizer(splits=splits, inputCol="__o", outputCol="__bd", handleInvalid="keep").transform(x)
    else:
        x = x.withColumn("__bd", F.lit(0.0))
    key = (-F.col("__bd")).cast("int") if desc else F.col("__bd").cast("int")
    x = x.withColumn("__b", key).drop("__o", "__bd")
    per = x.groupBy("__b").agg(*[F.sum(v).alias(f"__t_{v}") for v in values])
    wb = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    wall = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    carry = per.select("__b", *[F.coalesce(F.sum(f"__t_{v}").over(wb), F.lit(0)).alias(f"__c_{v}")
                               for v in values],
                       *[F.sum(f"__t_{v}").over(wall).alias(f"total_{v}") for v in values])
    ord_col = F.desc(order) if desc else F.asc(order)
    wi = Window.partitionBy("__b").orderBy(ord_col).rangeBetween(Window.unboundedPreceding, 0)
    y = x.join(F.broadcast(carry), "__b")
    return y.select(*df.columns, *[(F.sum(v).over(wi) + F.col(f"__c_{v}")).alias(f"cum_{v}")
                                   for v in values],
                    *([F.col(f"total_{v}") for v in values] if totals else []))
