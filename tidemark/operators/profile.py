"""Aggregations and profiles.

Whole-table profiles are one ``agg`` over all columns (one scan, partial
aggregation on the map side, a single-row result), turned into a long table
with ``unpivot``; nothing loops over columns with a job per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.clean import missing
from tidemark.operators.quantiles import bracket, exact_quantiles_of_columns, quantiles_with, stacked

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def present(col: str) -> Column:
    """A numeric column as double, NaN as null: what counts as a value in moments, ranges and quantiles."""
    x = F.col(f"`{col}`").cast("double")
    return F.when(~F.isnan(x), x)


def group_size(df: DataFrame, keys: Sequence[str], dropna: bool = False) -> DataFrame:
    """Rows per group; ``dropna`` gives pandas' groupby (null keys dropped)."""
    if dropna:
        df = df.dropna(subset=list(keys))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def value_counts(df: DataFrame, col: str, keep_null: bool = False) -> DataFrame:
    """Counts per value, sorted by count descending then value."""
    if not keep_null:
        df = df.filter(F.col(col).isNotNull())
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc_nulls_first(col)))


def distinct_where(df: DataFrame, col: str, cond: Column | None = None,
                   approx: bool = False) -> DataFrame:
    """Distinct count of ``col`` under a predicate, as a one-row frame."""
    if cond is not None:
        df = df.filter(cond)
    agg = F.approx_count_distinct(col) if approx else F.count_distinct(col)
    return df.agg(agg.alias("n_distinct"))


def share_of_total(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per 0/1 column: count of ones and percent of rows, long form."""
    aggs = []
    for c in cols:
        aggs += [F.sum(F.col(c).cast("long")).alias(f"{c}__sum"),
                 (F.avg(F.col(c).cast("double")) * 100).alias(f"{c}__pct")]
    wide = df.agg(*aggs)
    stacked = ", ".join(f"'{c}', `{c}__sum`, `{c}__pct`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {stacked}) AS (label, n_ones, pct)")


def describe(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Count, mean, sample std, min, quartiles, max per numeric column,
    long form (one row per column); NaN is missing.

    Two reads: one aggregate gives the moments and a bracket around each
    quartile, a second one the exact quartiles (``exact_quantiles_of_columns``,
    nothing unbounded in one task); ``exact=False`` takes the sketch's
    ``percentile_approx`` in the first and needs no second. Only the one row of
    numbers reaches the driver."""
    if cols is None:
        cols = [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]
    probs, aggs = [0.25, 0.5, 0.75], []
    for i, c in enumerate(cols):
        x = present(c)
        aggs += [F.count(x).alias(f"c{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
        aggs.append((bracket(x, probs) if exact else F.percentile_approx(x, probs, 10000)).alias(f"q{i}"))
    wide = df.agg(*aggs)
    if exact:
        r = wide.first()
        facts = df.sparkSession.createDataFrame(
            [(c, *(r[f"{k}{i}"] for k in ("c", "m", "s", "lo", "hi"))) for i, c in enumerate(cols)],
            "column_name string, count long, mean double, std double, min double, max double")
        ends = {c: r[f"q{i}"] for i, c in enumerate(cols) if r[f"q{i}"] is not None}
        if not ends:
            return facts.select("column_name", "count", "mean", "std", "min", *[F.lit(None).cast("double").alias(n) for n in ("p25", "p50", "p75")], "max")
        qs = exact_quantiles_of_columns(df, ends, probs).groupBy("column_name").agg(
            *[F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for n, p in zip(("p25", "p50", "p75"), probs)])
        return (facts.join(F.broadcast(qs), "column_name", "left")  # a row per column
                .select("column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max"))
    parts = ", ".join(
        f"'{c}', c{i}, m{i}, s{i}, lo{i}, q{i}[0], q{i}[1], q{i}[2], hi{i}" for i, c in enumerate(cols))
    return wide.selectExpr(
        f"stack({len(cols)}, {parts}) AS (column_name, count, mean, std, min, p25, p50, p75, max)")


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Missing (null or NaN) count and share per column, long form."""
    cols = list(cols or df.columns)
    aggs = [F.count(F.lit(1)).alias("__n")] + [
        F.count(F.when(missing(df, c), 1)).alias(f"m{i}") for i, c in enumerate(cols)]
    parts = ", ".join(f"'{c}', m{i}" for i, c in enumerate(cols))
    return (df.agg(*aggs)
            .selectExpr("__n", f"stack({len(cols)}, {parts}) AS (column_name, n_missing)")
            .select("column_name", "n_missing",
                    F.try_divide(F.col("n_missing").cast("double"), F.col("__n")).alias("share")))


def _value_text(c: str, t: T.DataType) -> str | None:
    """SQL for a column's value as text, equal where values are; null for types whose text does not tell values apart."""
    q = f"`{c}`"
    if isinstance(t, (T.FloatType, T.DoubleType)):
        return f"CAST({q} + 0.0 AS STRING)"  # one zero
    if isinstance(t, T.StringType):  # long texts by their digest
        return f"CASE WHEN length({q}) > 64 THEN sha2({q}, 256) ELSE {q} END"
    if isinstance(t, (*_NUMERIC, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return f"CAST({q} AS STRING)"
    return None


def distinct_counts(df: DataFrame) -> DataFrame:
    """(column_name, n_unique, n_total): distinct and present values of every column, exactly, in two levels.

    Rows become (column, value) pairs, made unique with counts per task before they
    are shuffled by the pair; a second aggregate counts the pairs of a column. A
    column of few values costs a few rows per task, and no row is copied whole for
    each column, as one aggregate with many distinct counts would do."""
    made = {f.name: _value_text(f.name, f.dataType) for f in df.schema.fields}
    made = {c: x or f"sha2(to_json(struct(`{c}`)), 256)" for c, x in made.items()}
    parts = ", ".join(f"'{c}', CASE WHEN `{c}` IS NOT NULL THEN {x} END" for c, x in made.items())
    pairs = df.selectExpr(f"stack({len(made)}, {parts}) AS (column_name, value)").where("value IS NOT NULL")
    per = (pairs.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
           .groupBy("column_name").agg(F.count(F.lit(1)).alias("n_unique"), F.sum("n").alias("n_total")))
    names = df.sparkSession.createDataFrame([(c,) for c in made], "column_name string")
    return names.join(per, "column_name", "left").fillna(0, ["n_unique", "n_total"])


def column_profile(df: DataFrame, max_share: float | None = 0.5, approx: bool = False) -> DataFrame:
    """Dtype, distinct values, non-null count and distinct/non-null per
    column; keep the columns under ``max_share`` (likely categoricals). Exact
    by ``distinct_counts``; ``approx`` takes sketches in one aggregate."""
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    if approx:
        aggs = []
        for i, c in enumerate(types):
            aggs += [F.approx_count_distinct(F.col(f"`{c}`")).alias(f"u{i}"), F.count(F.col(f"`{c}`")).alias(f"t{i}")]
        parts = ", ".join(f"'{c}', u{i}, t{i}" for i, c in enumerate(types))
        out = df.agg(*aggs).selectExpr(f"stack({len(types)}, {parts}) AS (column_name, n_unique, n_total)")
    else:
        out = distinct_counts(df)
    named = df.sparkSession.createDataFrame(list(types.items()), "column_name string, dtype string")
    out = (named.join(out, "column_name").select("column_name", "dtype", "n_unique", "n_total")
           .withColumn("unique_share", F.try_divide(F.col("n_unique").cast("double"), F.col("n_total"))))
    if max_share is not None:
        out = out.filter(F.col("unique_share") < max_share)
    return out


def row_null_histogram(df: DataFrame, cols: Sequence[str] | None = None, count_present: bool = False) -> DataFrame:
    """Per row, number of missing (or present) fields; then rows per number."""
    cols = list(cols or df.columns)
    n_missing = sum((missing(df, c).cast("int") for c in cols), F.lit(0))
    v = (F.lit(len(cols)) - n_missing) if count_present else n_missing
    name = "n_present" if count_present else "n_missing"
    return df.select(v.alias(name)).groupBy(name).agg(F.count(F.lit(1)).alias("n_rows"))


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Equal-width bins over [min, max]; the last bin is closed.

    Missing values (null, NaN) are left out; infinities have no bin of finite
    width and are left out too. The range is one aggregate (two numbers to the
    driver), then one grouped count; the data is scanned twice, never collected."""
    x = present(col)
    x = F.when(F.abs(x) != float("inf"), x)
    r = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    lo, hi = r["lo"], r["hi"]
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, lower double, upper double, n long")
    w = (hi - lo) / bins
    b = (F.lit(0) if w == 0 else F.least(F.floor((x - F.lit(lo)) / F.lit(w)), F.lit(bins - 1))).cast("int")
    return (df.filter(x.isNotNull())
            .select(b.alias("bin"), (F.lit(lo) + b * F.lit(w)).alias("lower"),
                    (F.lit(lo) + (b + 1) * F.lit(w)).alias("upper"))
            .groupBy("bin", "lower", "upper").agg(F.count(F.lit(1)).alias("n")))


def columns_by_missing_count(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Columns sharing the same (non-zero) missing count."""
    return (null_counts(df, cols).filter(F.col("n_missing") > 0)
            .groupBy("n_missing").agg(F.sort_array(F.collect_list("column_name")).alias("columns"))
            .filter(F.size("columns") > 1))


def compare_subsets(a: DataFrame, b: DataFrame, cols: Sequence[str],
                    tags: tuple[str, str] = ("a", "b")) -> DataFrame:
    """Level counts of ``cols`` in two subsets side by side (long over
    columns, pivoted over the two tags with explicit values)."""
    def longform(df, tag):
        parts = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in cols)
        return df.selectExpr(f"'{tag}' AS tag", f"stack({len(cols)}, {parts}) AS (column_name, value)")
    both = longform(a, tags[0]).unionByName(longform(b, tags[1]))
    return (both.groupBy("column_name", "value").pivot("tag", list(tags)).agg(F.count(F.lit(1)))
            .fillna(0, subset=list(tags)))


def classify_categoricals(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Levels per column with missing (null, NaN) counted as one level; class is
    ``binary_numeric`` / ``binary_text`` (2 levels) or ``multi`` (other)."""
    aggs = []
    for i, c in enumerate(cols):
        gone = missing(df, c)
        aggs += [F.count_distinct(F.when(~gone, F.col(c))).alias(f"d{i}"),
                 F.max(gone.cast("int")).alias(f"z{i}")]
    types = {f.name: isinstance(f.dataType, _NUMERIC) for f in df.schema.fields}
    parts = ", ".join(f"'{c}', {str(types[c]).lower()}, d{i} + z{i}" for i, c in enumerate(cols))
    out = df.agg(*aggs).selectExpr(f"stack({len(cols)}, {parts}) AS (column_name, is_numeric, n_levels)")
    return out.withColumn("kind", F.when(F.col("n_levels") != 2, "multi")
                          .when(F.col("is_numeric"), "binary_numeric").otherwise("binary_text"))


def cluster_ratio(a: DataFrame, b: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Per cluster, rows of ``b`` / rows of ``a`` and both shares.

    Both sides are aggregated first (tiny), then full-joined on the cluster."""
    ca = a.groupBy(cluster).agg(F.count(F.lit(1)).alias("n_a"))
    cb = b.groupBy(cluster).agg(F.count(F.lit(1)).alias("n_b"))
    j = ca.join(cb, cluster, "full").fillna(0, subset=["n_a", "n_b"])
    w = Window.partitionBy()
    return j.select(cluster, "n_a", "n_b",
                    F.try_divide(F.col("n_b").cast("double"), F.col("n_a")).alias("ratio"),
                    (F.col("n_a") / F.sum("n_a").over(w)).alias("share_a"),
                    (F.col("n_b") / F.sum("n_b").over(w)).alias("share_b"))


def describe_by(df: DataFrame, key: str, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """Count, mean, std, min, median, max per group and column (long).

    NaN is missing. Two reads of the stacked columns: moments and brackets of the
    medians, then the exact medians (a group may be a third of the rows;
    nothing collects it), joined on group and column; ``exact=False`` uses
    ``percentile_approx`` and one read."""
    moments = [F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"),
               F.min("x").alias("min"), F.max("x").alias("max")]
    if not exact:
        found = stacked(df, cols, [key]).groupBy("key").agg(*moments, F.percentile_approx("x", 0.5, 10000).alias("median"))
        return found.select("key.*", *[c for c in found.columns if c != "key"])
    med, facts = quantiles_with(df, cols, [0.5], [key], moments)
    med = med.select(F.struct(key, "column_name").alias("key"), F.col("value").alias("median"))
    return facts.join(med, "key", "left").select("key.*", "count", "mean", "std", "min", "median", "max")


def row_sum(cols: Sequence[str]) -> Column:
    """Sum across columns of one row."""
    return sum((F.coalesce(F.col(c), F.lit(0)) for c in cols), F.lit(0))


def best_by(df: DataFrame, keys: Sequence[str], order: Sequence[tuple[str, str]]) -> DataFrame:
    """Per group, the best row by a list of ``(column, "max"|"min")``
    criteria applied in turn (e.g. max accuracy, then min loss, then min
    epoch = first), of any ordered type. A null never wins over a value. Runs of equal direction are one struct
    rank: ``max_by`` / ``min_by`` is a partial (map-side) aggregate that keeps
    one row per group and task before the exchange, so a hot group is not a
    problem. Numbers are negated to join a run of the other direction; for
    text, dates and the like the run is cut: the best value of the first
    criteria is found, and only rows that have it go on."""
    types = {f.name: f.dataType for f in df.schema.fields}
    g = list(keys)
    rows, todo = df, list(order)
    while todo:
        take = 1
        while take < len(todo) and (todo[take][1] == todo[0][1] or isinstance(types[todo[take][0]], _NUMERIC)):
            take += 1
        run, todo, lead = todo[:take], todo[take:], todo[0][1]
        parts = []
        for i, (c, how) in enumerate(run):
            v = F.col(c) if how == lead else -F.col(c)
            parts += [(F.col(c).isNotNull() if lead == "max" else F.col(c).isNull()).alias(f"p{i}"), v.alias(f"r{i}")]
        rank = F.struct(*parts)
        if not todo:
            payload = F.struct(*[F.col(c) for c in df.columns if c not in g])
            pick = (F.max_by if lead == "max" else F.min_by)(payload, rank)
            return rows.groupBy(*g).agg(pick.alias("best")).select(*g, "best.*")
        best = (F.max if lead == "max" else F.min)(F.struct(*parts)).alias("__best")
        top = rows.groupBy(*g).agg(best).select(F.struct(F.lit(0), *g).alias("__g"), "__best")
        rows = (rows.withColumn("__g", F.struct(F.lit(0), *g)).withColumn("__best", rank)
                .join(top, ["__g", "__best"], "left_semi").drop("__g", "__best"))
    raise ValueError("no criteria")


def describe_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A11 for text columns (pandas' object describe): non-null count,
    distinct values, most frequent value (ties: smallest) and its count.
    One stacked aggregation per value; the top value per column is a partial
    aggregate over the (column, value) counts (no task sees them all)."""
    parts = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in cols)
    long = df.selectExpr(f"stack({len(cols)}, {parts}) AS (column_name, value)").filter(F.col("value").isNotNull())
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    first = F.struct((-F.col("n")).alias("n"), F.col("value").alias("value"))  # most frequent, then smallest
    per = counts.groupBy("column_name").agg(F.sum("n").alias("count"), F.count(F.lit(1)).alias("unique"), F.min(first).alias("t"))
    return per.select("column_name", "count", "unique", F.col("t.value").alias("top"), (-F.col("t.n")).alias("freq"))
