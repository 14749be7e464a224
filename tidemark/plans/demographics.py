"""Customer-segments project: missing codes, cleaning, re-encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions.scalar import ones_digit, tens_digit
from tidemark.operators.clean import (codes_to_null, columns_of_type, drop_columns, keep_dense_rows,
                                     parse_code_list_py)
from tidemark.operators.lookup import observe_unmapped, struct_lookup
from tidemark.sources import testdata as td

# Code -> (decade, movement) with mainstream = 0 and
# avantgarde = 1, as the reference maps its 15-level generation column.
DECADE_MOVEMENT = {
    1: (40, 0), 2: (40, 1), 3: (50, 0), 4: (50, 1), 5: (60, 0), 6: (60, 1), 7: (60, 1),
    8: (70, 0), 9: (70, 1), 10: (80, 0), 11: (80, 1), 12: (80, 0), 13: (80, 1),
    14: (90, 0), 15: (90, 1),
}


def codes_from_meta(meta: DataFrame) -> dict[str, list[str]]:
    """Missing codes per attribute from the feature summary (one row per
    column, so collecting it is bounded by the column count)."""
    rows = meta.select("attribute", "missing_or_unknown").collect()
    return {r[0]: parse_code_list_py(r[1]) for r in rows}


def coded_population(spark, sf_dir) -> DataFrame:
    return codes_to_null(td.population(spark, sf_dir), codes_from_meta(td.demo_meta(spark)))


CODED_SQL = td.DEMO_SQL + """,
coded AS (
  SELECT p_partkey,
    CASE WHEN p_size IN (1, 2, 3) THEN NULL ELSE p_size END AS p_size,
    CASE WHEN p_retailprice = -1 THEN NULL ELSE p_retailprice END AS p_retailprice,
    CASE WHEN p_type = 'PROMO' THEN NULL ELSE p_type END AS p_type,
    p_brand,
    CASE WHEN size_band IN (-1, 0) THEN NULL ELSE size_band END AS size_band,
    mfgr_side,
    CASE WHEN decade_code = 0 THEN NULL ELSE decade_code END AS decade_code,
    CASE WHEN cameo = 'XX' THEN NULL ELSE cameo END AS cameo
  FROM population)
"""

CODED_COLS = ["p_partkey", "p_size", "p_retailprice", "p_type", "p_brand", "size_band",
              "mfgr_side", "decade_code", "cameo"]


def binary_levels(df: DataFrame, cols) -> dict[str, list]:
    """Fit part of X18 in ONE pass: per column, levels ordered by frequency
    (most frequent first, ties lexical; null counts as a level); columns
    with exactly two levels are returned. Counts per (column, value) are a
    stacked aggregate; the number of levels and the first and last of them are
    partial aggregates over the counts, so no task sorts a column's values, and
    one row per column reaches the driver."""
    cols = list(cols)
    if not cols:
        return {}
    parts = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in cols)
    long = df.selectExpr(f"stack({len(cols)}, {parts}) AS (column_name, value)")
    counts = long.groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    place = F.struct((-F.col("n")).alias("n"), F.col("value").alias("value"))
    found = counts.groupBy("column_name").agg(F.count(F.lit(1)).alias("levels"), F.min(place).alias("a"), F.max(place).alias("b"))
    by_col = {r["column_name"]: [r["a"]["value"], r["b"]["value"]] for r in found.where("levels = 2").collect()}
    types = {f.name: f.dataType for f in df.schema.fields}
    out = {}
    for c, levels in by_col.items():
        # back to the column's own type so comparisons stay typed
        out[c] = [None if v is None else (v if types[c].simpleString() == "string" else float(v)) for v in levels]
    return out


#: Lookups of the mixed columns: name -> (code, looked-up value).
MIXED_LOOKUPS = {"decade_code": ("decade_code", "decade"), "cameo": ("cameo", "wealth")}


def split_mixed(x: DataFrame) -> DataFrame:
    """The mixed columns split in two each; null in both where a code is missing or unknown."""
    dm = struct_lookup(F.col("decade_code"), DECADE_MOVEMENT, ["decade", "movement"])
    return x.withColumns({"decade": dm["decade"], "movement": dm["movement"],
                          "wealth": tens_digit("cameo"), "lifestage": ones_digit("cameo")})


def clean_demographics(df: DataFrame, meta: DataFrame, drop_fixed=("p_partkey",),
                       max_missing: int = 1, binary=None, fitted_out: dict | None = None,
                       unmapped: Observation | None = None) -> DataFrame:
    """P11 -> P02 (fixed list) -> P14 -> X18 (binary re-encode, drop
    multi-level categoricals) -> J12/X08 (split mixed columns) -> drop the
    remaining mixed columns. ``binary`` (column -> [level0, level1]) is the
    fitted part; pass the population's to clean customers identically
    (``fitted_out`` receives the levels fitted here). ``unmapped`` counts, with the job
    that runs the result, the rows whose code no lookup knows (``MIXED_LOOKUPS``)."""
    codes = codes_from_meta(meta)
    categorical = set(columns_of_type(meta, ["categorical"]))
    mixed_cols = set(columns_of_type(meta, ["mixed"]))
    x = codes_to_null(df, codes)
    x = drop_columns(x, list(drop_fixed))
    x = keep_dense_rows(x, max_missing)
    cats = [c for c in x.columns if c in categorical]
    binary = binary if binary is not None else binary_levels(x, cats)
    if fitted_out is not None:
        fitted_out.update(binary)
    for c in cats:
        if c in binary:
            lv0 = binary[c][0]
            x = x.withColumn(c, F.when(F.col(c).isNull(), None)
                             .when(F.col(c) == F.lit(lv0), 0).otherwise(1))
        else:
            x = x.drop(c)
    x = split_mixed(x)
    if unmapped is not None:
        x = observe_unmapped(x, unmapped, MIXED_LOOKUPS)
    return x.drop(*[c for c in x.columns if c in mixed_cols])
