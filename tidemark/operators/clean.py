"""Projection, filtering and cleaning operators.

All operators are DataFrame -> DataFrame and are written so that a whole-table
property (a null share, a set of complete columns) is computed in ONE
aggregation pass, then applied as a static projection.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalar import strip_brackets_split

_FLOATS = (T.FloatType, T.DoubleType)
_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)


def _dtype(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def missing(df: DataFrame, name: str) -> Column:
    """null, or NaN for float columns (pandas' notion of missing)."""
    c = F.col(name)
    if isinstance(_dtype(df, name), _FLOATS):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows whose key is null or, for strings, empty."""
    cond = None
    for k in keys:
        ok = F.col(k).isNotNull()
        if isinstance(_dtype(df, k), T.StringType):
            ok = ok & (F.col(k) != "")
        cond = ok if cond is None else cond & ok
    return df.filter(cond) if cond is not None else df


def drop_columns(df: DataFrame, names: Iterable[str], strict: bool = True) -> DataFrame:
    """Drop by name; like pandas, an absent name raises when ``strict``."""
    names = list(names)
    if strict:
        absent = [n for n in names if n not in df.columns]
        if absent:
            raise KeyError(f"columns not found: {absent}")
    return df.drop(*names)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename some columns."""
    return df.withColumnsRenamed(dict(mapping))


def set_header(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Positional header assignment."""
    return df.toDF(*names)


def cast_all(df: DataFrame, to: str = "int", cols: Sequence[str] | None = None) -> DataFrame:
    """Cast columns (all by default); text that does not parse -> null.

    ``try_cast`` keeps the reference's non-ANSI behaviour (fractions truncate
    toward zero, bad text -> null) under ANSI mode.
    """
    cols = set(cols or df.columns)
    return df.select([F.col(c).try_cast(to).alias(c) if c in cols else F.col(c) for c in df.columns])


def bool_to_int(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Booleans -> 0/1."""
    return df.withColumns({c: F.col(c).cast("int") for c in cols})


def fill_nulls(df: DataFrame, value=0, cols: Sequence[str] | None = None) -> DataFrame:
    """Numeric nulls -> value."""
    return df.na.fill(value, subset=list(cols) if cols else None)


def with_constant(df: DataFrame, name: str, value=1) -> DataFrame:
    """Constant marker column."""
    return df.withColumn(name, F.lit(value))


def filter_project(df: DataFrame, cond: Column | str, cols: Sequence[str]) -> DataFrame:
    """Filter then project (both reach the scan when over parquet)."""
    return df.filter(cond).select(*cols)


def columns_of_type(meta: DataFrame, types: Sequence[str], attr: str = "attribute",
                    type_col: str = "type") -> list[str]:
    """Attribute names whose declared type is in ``types``.

    ``meta`` is the small feature-summary table (one row per column), so
    collecting it is bounded by the column count, not the data.
    """
    rows = meta.filter(F.col(type_col).isin(list(types))).select(attr).orderBy(attr).collect()
    return [r[0] for r in rows]


def threshold_flag(value: Column, op: str, threshold: float) -> Column:
    """P10: ``value <op> threshold`` with missing -> false."""
    cond = {"<": value < threshold, "<=": value <= threshold,
            ">": value > threshold, ">=": value >= threshold}[op]
    return F.coalesce(cond, F.lit(False))


def parse_code_list(text: str | Column) -> Column:
    """``"[-1,0]"`` -> array of code strings (``"[]"`` -> ``[""]``)."""
    return strip_brackets_split(text)


def parse_code_list_py(text: str) -> list[str]:
    """Driver-side twin of P12 for the small metadata table."""
    return [t.strip() for t in text.strip().strip("[]").split(",")]


def _as_number(s: str):
    try:
        return float(s)
    except ValueError:
        return None


def codes_to_null(df: DataFrame, codes: Mapping[str, Sequence[str]]) -> DataFrame:
    """Per-column missing codes -> null, all columns in one projection.

    Numeric columns compare numerically against the codes that parse as
    numbers (``1.0`` equals code ``1``); other columns compare as text.
    """
    out = []
    for c in df.columns:
        cl = [x for x in codes.get(c, []) if x is not None]
        if not cl:
            out.append(F.col(c))
            continue
        if isinstance(_dtype(df, c), _NUMERIC):
            nums = [v for v in (_as_number(x) for x in cl) if v is not None]
            hit = F.col(c).cast("double").isin(nums) if nums else F.lit(False)
        else:
            hit = F.col(c).cast("string").isin(cl)
        out.append(F.when(hit, F.lit(None)).otherwise(F.col(c)).alias(c))
    return df.select(out)


def null_shares(df: DataFrame, cols: Sequence[str] | None = None) -> dict[str, float]:
    """One aggregation pass: share of missing values per column."""
    cols = list(cols or df.columns)
    aggs = [F.count(F.lit(1)).alias("__n")] + [
        F.count(F.when(missing(df, c), 1)).alias(f"__m{i}") for i, c in enumerate(cols)]
    r = df.agg(*aggs).first()
    n = r["__n"] or 0
    return {c: (r[f"__m{i}"] / n if n else 0.0) for i, c in enumerate(cols)}


def sparse_columns(df: DataFrame, share: float = 0.25, cols: Sequence[str] | None = None) -> list[str]:
    """Fit part of P13: columns whose missing share is >= ``share``.

    A column with no missing value is never sparse."""
    return [c for c, s in null_shares(df, cols).items() if s > 0 and s >= share]


def drop_sparse_columns(df: DataFrame, share: float = 0.25) -> DataFrame:
    """Drop columns whose missing share is >= ``share``."""
    return df.drop(*sparse_columns(df, share))


def missing_per_row(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    cols = list(cols or df.columns)
    return sum((missing(df, c).cast("int") for c in cols), F.lit(0))


def keep_dense_rows(df: DataFrame, max_missing: int = 10, cols: Sequence[str] | None = None) -> DataFrame:
    """Keep rows with at most ``max_missing`` missing fields."""
    return df.filter(missing_per_row(df, cols) <= max_missing)


def sparse_rows(df: DataFrame, max_missing: int = 10, cols: Sequence[str] | None = None) -> DataFrame:
    """Exact complement of P14."""
    return df.filter(missing_per_row(df, cols) > max_missing)


def dedupe(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop exact duplicate rows."""
    return df.dropDuplicates(list(subset) if subset else None)


def rows_with_any_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """P20: rows with at least one missing field."""
    return df.filter(missing_per_row(df, cols) > 0)


def has_value(c: str | Column) -> Column:
    """Value present -> true."""
    return (F.col(c) if isinstance(c, str) else c).isNotNull()


def complete_columns(df: DataFrame) -> list[str]:
    """Columns without any missing value (one aggregation pass)."""
    return [c for c, s in null_shares(df).items() if s == 0]


def select_complete_columns(df: DataFrame) -> DataFrame:
    return df.select(*complete_columns(df))
