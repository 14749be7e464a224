"""Encoders and scalers with an explicit fit / transform split.

``fit`` runs ONE aggregation and returns small driver-side parameters
(levels, min/max, mean/std); ``transform`` is a static projection, so the
same columns come out for new data (no train/serve drift, no hidden jobs).
Library defaults that differ from the reference's meaning are avoided:
population std, constant column -> 0, no level dropped.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import written_table

def dummy_name(col: str, level) -> str:
    """Column name of a level: ``col_level``, the level's text unchanged (two levels never share a name)."""
    return f"{col}_{level}"


def fit_levels(df: DataFrame, cols: Sequence[str], max_levels: int | None = None) -> dict[str, list]:
    """Sorted distinct non-null levels per column.

    A column per level is meant for categoricals; ``max_levels``, if given,
    is checked against the exact number of levels of each column and exceeding
    it raises. Wide columns: ``string_index`` and MLlib's sparse
    ``OneHotEncoder(dropLast=False)`` (``one_hot_vector``)."""
    out = {}
    for c in cols:
        rows = df.select(c).where(F.col(c).isNotNull()).distinct().orderBy(c)
        if max_levels is not None:
            rows = rows.limit(max_levels + 1)
        out[c] = [r[0] for r in rows.collect()]
        if max_levels is not None and len(out[c]) > max_levels:
            raise ValueError(f"{c}: more than {max_levels} levels")
    return out


def one_hot_vector(df: DataFrame, col: str, out: str) -> DataFrame:
    """F03 for columns with many levels: a sparse 0/1 vector, no level dropped; null -> all 0."""
    from pyspark.ml.feature import OneHotEncoder
    indexed, _ = string_index(df, col, "__index")
    hot = OneHotEncoder(inputCol="__index", outputCol=out, dropLast=True).fit(indexed)  # the kept last index is null
    return hot.transform(indexed).drop("__index")


def one_hot(df: DataFrame, cols: Sequence[str], levels: Mapping[str, Sequence] | None = None,
            drop: bool = True) -> DataFrame:
    """one 0/1 column per level (sorted), named ``col_level``; null -> all
    0; no level dropped."""
    levels = levels or fit_levels(df, cols)
    new = {}
    for c in cols:
        for lv in levels[c]:
            if dummy_name(c, lv) in new:  # e.g. level "b_c" of column "a" and level "c" of column "a_b"
                raise ValueError(f"two levels give the column name {dummy_name(c, lv)}")
            new[dummy_name(c, lv)] = F.coalesce(F.col(c) == F.lit(lv), F.lit(False)).cast("int")
    out = df.withColumns(new)
    return out.drop(*cols) if drop else out


def fit_min_max(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        x = F.when(~F.isnan(x), x)
        aggs += [F.min(x).alias(f"a{i}"), F.max(x).alias(f"b{i}")]
    r = df.agg(*aggs).first()
    return {c: (r[f"a{i}"], r[f"b{i}"]) for i, c in enumerate(cols)}


def min_max(df: DataFrame, cols: Sequence[str], stats: Mapping[str, tuple[float, float]] | None = None) -> DataFrame:
    """scale to [0, 1]; a constant column maps to 0 (scikit-learn)."""
    stats = stats or fit_min_max(df, cols)
    new = {}
    for c in cols:
        lo, hi = stats[c]
        rng = (hi - lo) if hi is not None and lo is not None else None
        x = F.col(c).cast("double")
        new[c] = (x - F.lit(lo)) / F.lit(rng) if rng else (x - F.lit(lo)) * 0.0
    return df.withColumns(new)


def fit_mean_std(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        x = F.when(~F.isnan(x), x)
        aggs += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
    r = df.agg(*aggs).first()
    return {c: (r[f"m{i}"], r[f"s{i}"]) for i, c in enumerate(cols)}


def standardise(df: DataFrame, cols: Sequence[str], stats: Mapping[str, tuple[float, float]] | None = None) -> DataFrame:
    """mean 0 and POPULATION std 1 (MLlib's StandardScaler uses the
    sample std and does not centre by default); std 0 -> scale 1."""
    stats = stats or fit_mean_std(df, cols)
    return df.withColumns({c: (F.col(c).cast("double") - F.lit(stats[c][0])) / F.lit(stats[c][1] or 1.0)
                           for c in cols})


def fit_means(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    return {c: m for c, (m, _) in fit_mean_std(df, cols).items()}


def impute_mean(df: DataFrame, cols: Sequence[str], means: Mapping[str, float] | None = None) -> DataFrame:
    """null / NaN -> column mean (fitted on one frame, reusable on another)."""
    means = means or fit_means(df, cols)
    new = {}
    for c in cols:
        x = F.col(c).cast("double")
        new[c] = F.when(x.isNull() | F.isnan(x), F.lit(means[c])).otherwise(x)
    return df.withColumns(new)


def frequency_index(df: DataFrame, col: str, out: str, order: str = "frequencyDesc") -> DataFrame:
    """label -> index by frequency (ties by value), or alphabetical.

    The label vocabulary is aggregated and cut into ranges of about equal size in
    the order of the index; each range is numbered by itself and offset by the
    sizes of the ranges before it. So no task sorts more than a range, however many
    labels share a frequency. The join back is the planner's choice."""
    from tidemark.operators.lookup import lookup_join
    from pyspark.sql import Window
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("__n")).filter(F.col(col).isNotNull())
    keys = [F.desc("__n"), F.asc(col)] if order == "frequencyDesc" else [F.asc(F.col(col).cast("string"))]
    # written, so that a range is the same set of labels wherever it is read
    ranges = written_table(counts.repartitionByRange(*keys).withColumn("__p", F.spark_partition_id()), "labels")
    sizes = ranges.groupBy("__p").agg(F.count(F.lit(1)).alias("__s"))
    before = Window.orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    sizes = sizes.select("__p", F.coalesce(F.sum("__s").over(before), F.lit(0)).alias("__o"))
    own = Window.partitionBy("__p").orderBy(*keys)
    vocab = (ranges.withColumn("__r", F.row_number().over(own)).join(F.broadcast(sizes), "__p")
             .select(col, (F.col("__r") + F.col("__o") - 1).cast("double").alias(out)))
    return lookup_join(df, vocab, col, "left")


def string_index(df: DataFrame, col: str, out: str, order: str = "alphabetAsc"):
    """F08 / S12 with MLlib: fit a ``StringIndexer`` (``alphabetAsc`` gives
    the class index = sorted label order, ``frequencyDesc`` the frequency
    order) and return (indexed frame, fitted model) so new data reuses it."""
    from pyspark.ml.feature import StringIndexer
    model = StringIndexer(inputCol=col, outputCol=out, stringOrderType=order, handleInvalid="keep").fit(df)
    return model.transform(df), model
