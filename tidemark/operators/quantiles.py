"""Exact quantiles in two reads, without holding a group in one task.

``percentile`` keeps every distinct value of a group in one aggregation buffer,
which is unbounded when a group (or the whole table) is large. Here:

read one  one aggregate keeps a mergeable quantile sketch per (group, column):
          for every asked probability a bracket of two values, one surely below
          and one surely above the wanted ranks (the bracket is ten times as
          wide as the sketch's error);
read two  one aggregate counts the rows below, between and above the brackets,
          one number each, and the rows inside them per distinct value; running
          totals over these few rows of a group give the value at a wanted rank.

The sketch only decides how many values are kept, never which one is found: the
ranks come from exact counts, and should a rank ever fall outside its bracket the
query ends with an error instead of a wrong answer. Inside a bracket lie about
2 * SPREAD of a group's rows, so no task sorts more than that of any group.
NaN counts as missing; infinities are values like any other. Quantiles
interpolate linearly between order statistics (the ``quantile_cont`` /
``percentile`` definition); between equal neighbours, and exactly on one, the
neighbour itself is the answer.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import written_table

#: Accuracy of the percentile sketch (an error of 1 / ACCURACY of the rows); distance of a bracket's ends from its probability.
ACCURACY, SPREAD = 10_000, 1e-3
#: Largest table of brackets that is broadcast.
BROADCAST_BYTES = 32 * 1024 ** 2


def bracket(x: Column, probs: Sequence[float]) -> Column:
    """Sketch aggregate of a column: the lower and upper end of each probability's bracket, in turn (null without values)."""
    grid = [min(1.0, max(0.0, p + side)) for p in probs for side in (-SPREAD, SPREAD)]
    return F.percentile_approx(x, grid, ACCURACY)


def _found(placed: DataFrame, probs: Sequence[float]) -> DataFrame:
    """(key, prob, value) from (key, x, e: bracket ends)."""
    e = F.col("e")
    begun = sum(((F.col("x") >= e[2 * j]).cast("int") for j in range(len(probs))), F.lit(0))
    passed = sum(((F.col("x") > e[2 * j + 1]).cast("int") for j in range(len(probs))), F.lit(0))
    # both grow with x: the cells between brackets are one row each, inside a bracket each value is a row
    cells = (placed.select("key", begun.alias("a"), passed.alias("b"), "x")
             .select("key", "a", "b", F.when(F.col("a") > F.col("b"), F.col("x")).alias("v"))
             .groupBy("key", "a", "b", "v").agg(F.count(F.lit(1)).alias("n")))
    upto = Window.partitionBy("key").orderBy("a", "b", "v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = cells.select("key", "v", "n", F.sum("n").over(upto).alias("upto"), F.sum("n").over(Window.partitionBy("key")).alias("total"))
    before = F.col("upto") - F.col("n")
    value = F.coalesce(F.col("v"), F.raise_error(F.lit("a wanted rank lies outside its bracket")).cast("double"))
    sides = []
    for i, p in enumerate(probs):
        at = (F.col("total") - 1) * F.lit(p)
        for name, rank in (("low", F.floor(at)), ("high", F.ceil(at))):
            sides.append(F.max(F.when((rank >= before) & (rank < F.col("upto")), value)).alias(f"{name}{i}"))
        sides.append(F.max(at - F.floor(at)).alias(f"rest{i}"))
    wide = ranked.groupBy("key").agg(*sides)

    def between(i: int) -> Column:
        low, high, rest = F.col(f"low{i}"), F.col(f"high{i}"), F.col(f"rest{i}")
        return F.when((rest == 0) | (low == high), low).otherwise(low + (high - low) * rest)

    each = F.array(*[F.struct(F.lit(p).alias("prob"), between(i).alias("value")) for i, p in enumerate(probs)])
    return wide.select("key", F.inline(each))


def stacked(df: DataFrame, cols: Sequence[str], group: Sequence[str]) -> DataFrame:
    """(key, x): one row per column of each row; the key holds the group values and the column's name; NaN as null."""
    parts = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    long = df.selectExpr(*[f"`{g}`" for g in group], f"stack({len(cols)}, {parts}) AS (column_name, x)")
    return long.select(F.struct(*group, "column_name").alias("key"), F.nanvl("x", F.lit(None).cast("double")).alias("x"))


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], group: Sequence[str] = ()) -> DataFrame:
    """One row per group, column and probability: the group columns, ``column_name``, ``prob``,
    ``value``. Columns without a present value in a group have no row."""
    return quantiles_with(df, cols, probs, group, [])[0]


def quantiles_with(df: DataFrame, cols: Sequence[str], probs: Sequence[float], group: Sequence[str],
                   more: Sequence[Column]) -> tuple[DataFrame, DataFrame]:
    """``exact_quantiles`` of each column in each group, and what the first read found besides.

    The first frame has the group columns, ``column_name``, ``prob`` and ``value``, without
    rows for columns that have no value in a group; the second ``key`` (struct of
    the group columns and ``column_name``) and the aggregates ``more`` of ``x``.
    It is written, so the input is read twice in all."""
    probs, group = sorted(set(probs)), list(group)
    long = stacked(df, cols, group)
    facts = written_table(long.groupBy("key").agg(bracket(F.col("x"), probs).alias("e"), *more), "brackets")
    ends = facts.select("key", "e").where(F.col("e").isNotNull())
    if facts.count() * 16 * (2 * len(probs) + 16) <= BROADCAST_BYTES:  # the count reads footers only
        ends = F.broadcast(ends)
    placed = long.where(F.col("x").isNotNull()).join(ends, "key")
    return _found(placed, probs).select("key.*", "prob", "value"), facts.drop("e")


def exact_quantiles_of_columns(df: DataFrame, ends: Mapping[str, Sequence[float]], probs: Sequence[float]) -> DataFrame:
    """(column_name, prob, value) of whole columns, given the bracket ends of each column that has
    values (as ``bracket`` gave them): one read, the ends are literals."""
    probs = sorted(set(probs))

    def number(v: float) -> str:
        return f"CAST('{v!r}' AS DOUBLE)"

    parts = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE), array({', '.join(number(v) for v in e)})" for c, e in ends.items())
    long = df.selectExpr(f"stack({len(ends)}, {parts}) AS (column_name, x, e)")
    placed = long.where(F.col("x").isNotNull() & ~F.isnan("x")).select(F.struct("column_name").alias("key"), "x", "e")
    return _found(placed, probs).select("key.*", "prob", "value")
