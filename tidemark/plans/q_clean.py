"""Cleaning queries (P01-P22, U01) over the stand-in tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import clean as C
from tidemark.operators.setops import symmetric_difference
from tidemark.plans.demographics import CODED_COLS, CODED_SQL, coded_population
from tidemark.plans.registry import register
from tidemark.sources import testdata as td


def _missing_sum_sql(cols):
    return " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in cols)


@register("require_keys", f"""
WITH {td.MUSIC_SQL}
SELECT event_id, userId, artist FROM music_raw
WHERE userId IS NOT NULL AND userId <> '' AND artist IS NOT NULL AND artist <> ''
""")
def q_require_keys(spark, sf_dir):
    """Rows with null or empty key removed."""
    ev = td.music_events_raw(spark, sf_dir)
    return C.require_keys(ev, ["userId", "artist"]).select("event_id", "userId", "artist")


@register("codes_to_null", f"WITH {CODED_SQL} SELECT * FROM coded")
def q_codes_to_null(spark, sf_dir):
    """P11 + P12: per-column missing codes (parsed from the metadata) -> null."""
    return coded_population(spark, sf_dir)


SPARSE_SHARE = 0.25
# per column: rows and missing ones, from which the oracles derive the decisions
_MISSING_SQL = f"""
n AS (SELECT count(*) AS n_rows FROM coded),
m AS ({" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_missing FROM coded" for c in CODED_COLS)})
"""


def _columns_of(df):
    """What a column-dropping step left: (column_name, n_missing, n_rows)."""
    from tidemark.operators.profile import null_counts
    n = df.agg(F.count(F.lit(1)).alias("n_rows"))
    counts = null_counts(df).select("column_name", "n_missing")
    return counts.withColumn("n_rows", F.lit(n.first()["n_rows"]).cast("long"))


@register("sparse_column_report", f"""
WITH {CODED_SQL},
n AS (SELECT count(*) AS n FROM coded),
m AS ({" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_missing FROM coded"
                          for c in CODED_COLS)})
SELECT column_name, n_missing, round(n_missing / n, 6) AS share,
       n_missing > 0 AND n_missing / n >= {SPARSE_SHARE} AS dropped
FROM m, n
""")
def q_sparse_column_report(spark, sf_dir):
    """P13 (+A13): missing share per column and the drop decision (>= share)."""
    from tidemark.operators.profile import null_counts
    df = coded_population(spark, sf_dir)
    dropped = set(C.sparse_columns(df, SPARSE_SHARE))
    nc = null_counts(df)
    return nc.select("column_name", "n_missing", F.round("share", 6).alias("share"),
                     F.col("column_name").isin(sorted(dropped) or ["\u0000"]).alias("dropped"))


@register("drop_sparse_columns", f"""
WITH {CODED_SQL}, {_MISSING_SQL}
SELECT column_name, n_missing, n_rows FROM m, n WHERE NOT (n_missing > 0 AND n_missing / n_rows >= {SPARSE_SHARE})
""")
def q_drop_sparse_columns(spark, sf_dir):
    """Columns left after dropping those with a missing share of 0.25 or more."""
    return _columns_of(C.drop_sparse_columns(coded_population(spark, sf_dir), SPARSE_SHARE))


@register("keep_dense_rows", f"""
WITH {CODED_SQL} SELECT * FROM coded WHERE {_missing_sum_sql(CODED_COLS)} <= 1
""")
def q_keep_dense_rows(spark, sf_dir):
    """Rows with at most 1 missing field (kept at exactly the bound)."""
    return C.keep_dense_rows(coded_population(spark, sf_dir), 1)


@register("sparse_rows", f"""
WITH {CODED_SQL} SELECT * FROM coded WHERE {_missing_sum_sql(CODED_COLS)} > 1
""")
def q_sparse_rows(spark, sf_dir):
    """Exact complement of P14."""
    return C.sparse_rows(coded_population(spark, sf_dir), 1)


@register("rows_with_any_null", f"""
WITH {CODED_SQL} SELECT * FROM coded WHERE {_missing_sum_sql(CODED_COLS)} > 0
""")
def q_rows_with_any_null(spark, sf_dir):
    """P20: rows with at least one missing field."""
    return C.rows_with_any_null(coded_population(spark, sf_dir))


@register("fill_nulls", f"""
WITH {CODED_SQL}
SELECT p_partkey, coalesce(p_size, 0) AS p_size, coalesce(p_retailprice, 0) AS p_retailprice, p_type, p_brand,
       coalesce(size_band, 0) AS size_band, mfgr_side, coalesce(decade_code, 0) AS decade_code, cameo
FROM coded
""")
def q_fill_nulls(spark, sf_dir):
    """Numeric nulls -> 0."""
    return C.fill_nulls(coded_population(spark, sf_dir), 0)


@register("cast_all", f"""
WITH {td.MUSIC_SQL}
SELECT TRY_CAST(userId AS INTEGER) AS userId, TRY_CAST(ts AS INTEGER) AS ts,
       TRY_CAST(sessionId AS INTEGER) AS sessionId, TRY_CAST(trunc(length) AS INTEGER) AS length,
       TRY_CAST(page AS INTEGER) AS page
FROM music_raw
""")
def q_cast_all(spark, sf_dir):
    """Every column to int; fractions truncate, unparsable text and
    overflow -> null."""
    ev = td.music_events_raw(spark, sf_dir).select("userId", "ts", "sessionId", "length", "page")
    return C.cast_all(ev, "int")


@register("filter_project", """
SELECT event_id, user_id, value FROM events WHERE event_type = 'view' AND value > 20
""")
def q_filter_project(spark, sf_dir):
    """Filter + projection (pushed into the parquet scan)."""
    ev = td.table(spark, sf_dir, "events")
    return C.filter_project(ev, (F.col("event_type") == "view") & (F.col("value") > 20),
                            ["event_id", "user_id", "value"])


@register("dedupe", "SELECT DISTINCT text, lang FROM documents")
def q_dedupe(spark, sf_dir):
    """Exact duplicate rows removed (documents hold exact copies)."""
    return C.dedupe(td.table(spark, sf_dir, "documents").select("text", "lang"))


@register("complete_columns", f"""
WITH {CODED_SQL}, {_MISSING_SQL}
SELECT column_name, n_missing, n_rows FROM m, n WHERE n_missing = 0
""")
def q_complete_columns(spark, sf_dir):
    """Keep only the columns without any missing value."""
    return _columns_of(C.select_complete_columns(coded_population(spark, sf_dir)))


@register("symmetric_difference", f"""
WITH {CODED_SQL},
dense AS (SELECT * FROM coded WHERE {_missing_sum_sql(CODED_COLS)} <= 1),
u AS (SELECT * FROM coded UNION ALL SELECT * FROM dense)
SELECT {", ".join(CODED_COLS)} FROM u GROUP BY ALL HAVING count(*) = 1
""")
def q_symmetric_difference(spark, sf_dir):
    """Rows of A and B that occur exactly once in their concatenation
    (the reference's "dirty rows"; repeats within A are dropped too)."""
    a = coded_population(spark, sf_dir)
    return symmetric_difference(a, C.keep_dense_rows(a, 1))
