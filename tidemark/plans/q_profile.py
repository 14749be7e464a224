"""Profiling and aggregation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import profile as P
from tidemark.operators.rank import running_total, tail
from tidemark.plans.demographics import CODED_COLS, CODED_SQL, coded_population
from tidemark.plans.registry import register
from tidemark.sources import testdata as td

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _r(c, d=6):
    return F.round(F.col(c), d).alias(c)


@register("group_size", "SELECT quality, toxic, count(*) AS n FROM labels GROUP BY ALL")
def q_group_size(spark, sf_dir):
    """Rows per group."""
    return P.group_size(td.table(spark, sf_dir, "labels"), ["quality", "toxic"])


@register("value_counts", "SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang")
def q_value_counts(spark, sf_dir):
    """Counts per value, descending (nulls dropped)."""
    return P.value_counts(td.table(spark, sf_dir, "documents"), "lang")


@register("distinct_where", """
SELECT count(DISTINCT user_id) AS n_distinct FROM events WHERE event_type = 'error'
""")
def q_distinct_where(spark, sf_dir):
    """Cohort size = distinct users under a predicate."""
    return P.distinct_where(td.table(spark, sf_dir, "events"), "user_id", F.col("event_type") == "error")


@register("share_of_total", """
SELECT 'quality' AS label, CAST(sum(quality) AS BIGINT) AS n_ones, round(avg(quality) * 100, 6) AS pct FROM labels
UNION ALL
SELECT 'toxic', CAST(sum(toxic) AS BIGINT), round(avg(toxic) * 100, 6) FROM labels
""")
def q_share_of_total(spark, sf_dir):
    """Per 0/1 label: count of ones and percent of rows."""
    return P.share_of_total(td.table(spark, sf_dir, "labels"), ["quality", "toxic"]).select(
        "label", "n_ones", _r("pct"))


@register("describe", " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
  round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50,
  round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6) AS max FROM lineitem""" for c in LI_NUM))
def q_describe(spark, sf_dir):
    """Count, mean, std, min, quartiles, max per column (one pass)."""
    d = P.describe(td.table(spark, sf_dir, "lineitem"), LI_NUM)
    return d.select("column_name", "count", *[_r(c) for c in ["mean", "std", "min", "p25", "p50", "p75", "max"]])


@register("null_counts", f"""
WITH {CODED_SQL}, n AS (SELECT count(*) AS n FROM coded)
{" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_missing, "
                    f"round(count(*) FILTER (WHERE {c} IS NULL) / any_value(n.n), 6) AS share FROM coded, n"
                    for c in CODED_COLS)}
""")
def q_null_counts(spark, sf_dir):
    """Missing count and share per column, long form."""
    return P.null_counts(coded_population(spark, sf_dir)).select("column_name", "n_missing", _r("share"))


_TYPES = {"p_partkey": "bigint", "p_size": "int", "p_retailprice": "double", "p_type": "string",
          "p_brand": "string", "size_band": "int", "mfgr_side": "string", "decade_code": "int",
          "cameo": "string"}


@register("column_profile", f"""
WITH {CODED_SQL},
p AS ({" UNION ALL ".join(f"SELECT '{c}' AS column_name, '{_TYPES[c]}' AS dtype, count(DISTINCT {c}) AS n_unique, "
                          f"count({c}) AS n_total FROM coded" for c in CODED_COLS)})
SELECT column_name, dtype, n_unique, n_total, round(n_unique / n_total, 6) AS unique_share FROM p
WHERE n_unique / n_total < 0.5
""")
def q_column_profile(spark, sf_dir):
    """Dtype, distinct, non-null count, distinct share; shares < 0.5."""
    return P.column_profile(coded_population(spark, sf_dir), 0.5).select(
        "column_name", "dtype", "n_unique", "n_total", _r("unique_share"))


@register("row_null_histogram", f"""
WITH {CODED_SQL}
SELECT {" + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in CODED_COLS)} AS n_missing, count(*) AS n_rows
FROM coded GROUP BY 1
""")
def q_row_null_histogram(spark, sf_dir):
    """Missing fields per row, then rows per count."""
    return P.row_null_histogram(coded_population(spark, sf_dir))


@register("histogram", """
WITH r AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
b AS (SELECT CAST(least(floor((o_totalprice - lo) / ((hi - lo) / 10)), 9) AS INTEGER) AS bin, lo, hi FROM orders, r)
SELECT bin, round(lo + bin * ((hi - lo) / 10), 4) AS lower, round(lo + (bin + 1) * ((hi - lo) / 10), 4) AS upper,
       count(*) AS n FROM b GROUP BY ALL
""")
def q_histogram(spark, sf_dir):
    """10 equal-width bins over [min, max], last bin closed."""
    h = P.histogram(td.table(spark, sf_dir, "orders"), "o_totalprice", 10)
    return h.select("bin", F.round("lower", 4).alias("lower"), F.round("upper", 4).alias("upper"), "n")


@register("columns_by_missing_count", f"""
WITH {CODED_SQL},
m AS ({" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_missing FROM coded"
                          for c in CODED_COLS)}
      UNION ALL SELECT 'p_size_copy', count(*) FILTER (WHERE p_size IS NULL) FROM coded)
SELECT n_missing, array_to_string(list_sort(list(column_name)), ',') AS columns FROM m WHERE n_missing > 0
GROUP BY n_missing HAVING count(*) > 1
""")
def q_columns_by_missing_count(spark, sf_dir):
    """Columns sharing the same missing count (a copied column makes
    sure at least one group exists in the stand-in)."""
    pop = coded_population(spark, sf_dir)
    # add a copy of a coded column so one group always exists
    pop = pop.withColumn("p_size_copy", F.col("p_size"))
    return P.columns_by_missing_count(pop).select("n_missing", F.array_join("columns", ",").alias("columns"))


@register("compare_subsets", f"""
WITH {td.DEMO_SQL},
cust AS (SELECT * FROM population WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R')),
t AS (SELECT 'a' AS tag, 'p_type' AS column_name, p_type AS value FROM population
      UNION ALL SELECT 'a', 'mfgr_side', mfgr_side FROM population
      UNION ALL SELECT 'b', 'p_type', p_type FROM cust
      UNION ALL SELECT 'b', 'mfgr_side', mfgr_side FROM cust)
SELECT column_name, value, count(*) FILTER (WHERE tag = 'a') AS a, count(*) FILTER (WHERE tag = 'b') AS b
FROM t GROUP BY ALL
""")
def q_compare_subsets(spark, sf_dir):
    """Level counts of two subsets side by side."""
    return P.compare_subsets(td.population(spark, sf_dir), td.demo_customers(spark, sf_dir),
                             ["p_type", "mfgr_side"])


_CAT = ["p_type", "p_brand", "mfgr_side", "size_band", "cameo"]


@register("classify_categoricals", f"""
WITH {CODED_SQL},
c AS ({" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {'true' if c == 'size_band' else 'false'} AS is_numeric, "
    f"CAST(count(DISTINCT {c}) + max(CAST({c} IS NULL AS INTEGER)) AS BIGINT) AS n_levels FROM coded"
    for c in _CAT)})
SELECT *, CASE WHEN n_levels <> 2 THEN 'multi' WHEN is_numeric THEN 'binary_numeric' ELSE 'binary_text' END AS kind
FROM c
""")
def q_classify_categoricals(spark, sf_dir):
    """Levels per column (null counts as a level) and the binary class."""
    out = P.classify_categoricals(coded_population(spark, sf_dir), _CAT)
    return out.withColumn("n_levels", F.col("n_levels").cast("long"))


@register("cluster_ratio", f"""
WITH {td.DEMO_SQL},
cust AS (SELECT * FROM population WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R')),
a AS (SELECT size_band AS cluster, count(*) AS n_a FROM population GROUP BY 1),
b AS (SELECT size_band AS cluster, count(*) AS n_b FROM cust GROUP BY 1),
j AS (SELECT coalesce(a.cluster, b.cluster) AS cluster, coalesce(n_a, 0) AS n_a, coalesce(n_b, 0) AS n_b
      FROM a FULL JOIN b ON a.cluster = b.cluster)
SELECT cluster, n_a, n_b, round(n_b / n_a, 6) AS ratio, round(n_a / sum(n_a) OVER (), 6) AS share_a,
       round(n_b / sum(n_b) OVER (), 6) AS share_b FROM j
""")
def q_cluster_ratio(spark, sf_dir):
    """Per cluster (here: a size band), customers / population."""
    a = td.population(spark, sf_dir).withColumnRenamed("size_band", "cluster")
    b = td.demo_customers(spark, sf_dir).withColumnRenamed("size_band", "cluster")
    r = P.cluster_ratio(a, b)
    return r.select("cluster", "n_a", "n_b", _r("ratio"), _r("share_a"), _r("share_b"))


@register("describe_by", " UNION ALL ".join(f"""
SELECT l_returnflag, '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean,
  round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, round(quantile_cont({c}, 0.5), 6) AS median,
  round(max({c}), 6) AS max FROM lineitem GROUP BY l_returnflag""" for c in ["l_quantity", "l_discount"]))
def q_describe_by(spark, sf_dir):
    """Summary per group (cluster) and column."""
    d = P.describe_by(td.table(spark, sf_dir, "lineitem"), "l_returnflag", ["l_quantity", "l_discount"])
    return d.select("l_returnflag", "column_name", "count", *[_r(c) for c in ["mean", "std", "min", "median", "max"]])


@register("labels_per_message", """
SELECT CAST(quality + toxic AS INTEGER) AS n_labels, count(*) AS n FROM labels GROUP BY 1
""")
def q_labels_per_message(spark, sf_dir):
    """A22 + A06: labels per message (row sum), then counts."""
    lab = td.table(spark, sf_dir, "labels").select(P.row_sum(["quality", "toxic"]).cast("int").alias("n_labels"))
    return P.value_counts(lab, "n_labels")


@register("best_by", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax,
       l_returnflag, l_linestatus, l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey
                               ORDER BY l_quantity DESC, l_discount ASC, l_linenumber ASC,
                                        l_partkey ASC, l_suppkey ASC, l_extendedprice ASC) AS rn
  FROM lineitem) WHERE rn = 1
""")
def q_best_by(spark, sf_dir):
    """Per order, the line with the largest quantity, ties by the
    smallest discount, then the first line (max_by: partial aggregate per task)."""
    li = td.table(spark, sf_dir, "lineitem")
    return P.best_by(li, ["l_orderkey"], [("l_quantity", "max"), ("l_discount", "min"), ("l_linenumber", "min"),
                                          ("l_partkey", "min"), ("l_suppkey", "min"), ("l_extendedprice", "min")])


@register("tail_rows", """
SELECT * FROM events ORDER BY ts DESC, event_id DESC LIMIT 10
""")
def q_tail_rows(spark, sf_dir):
    """Last 10 rows in time order (top-k, the limit is the feature)."""
    return tail(td.table(spark, sf_dir, "events"), 10, ["ts", "event_id"])


@register("running_share", """
WITH v AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang)
SELECT lang, n, CAST(sum(n) OVER (ORDER BY n DESC, lang ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum_n,
       round(sum(n) OVER (ORDER BY n DESC, lang ROWS UNBOUNDED PRECEDING) / sum(n) OVER (), 6) AS cum_share
FROM v
""")
def q_running_share(spark, sf_dir):
    """Running total and share over a small ordered summary."""
    v = P.value_counts(td.table(spark, sf_dir, "documents"), "lang")
    r = running_total(v, [F.desc("n"), F.asc("lang")], "n", "cum_n")
    from pyspark.sql import Window
    tot = F.sum("n").over(Window.partitionBy())
    return r.select("lang", "n", "cum_n", F.round(F.col("cum_n") / tot, 6).alias("cum_share"))


@register("row_counts", """
SELECT 'events' AS table_name, count(*) AS n_rows FROM events
UNION ALL SELECT 'documents', count(*) FROM documents
UNION ALL SELECT 'lineitem', count(*) FROM lineitem
""")
def q_row_counts(spark, sf_dir):
    """Global row counts (shape)."""
    parts = [td.table(spark, sf_dir, t).agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(t).alias("table_name"), "n_rows") for t in ["events", "documents", "lineitem"]]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("distinct_values", "SELECT DISTINCT event_type AS page FROM events")
def q_distinct_values(spark, sf_dir):
    """Distinct values of a column (page names)."""
    return td.table(spark, sf_dir, "events").select(F.col("event_type").alias("page")).distinct()


@register("line_count", """
SELECT CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS n_lines FROM documents
""")
def q_line_count(spark, sf_dir):
    """Number of lines over all document texts (whole texts)."""
    d = td.table(spark, sf_dir, "documents")
    return d.agg(F.sum(F.size(F.split("text", "\n", -1))).cast("long").alias("n_lines"))


_TXT = ["lang", "source"]


@register("describe_text", " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, CAST(sum(n) AS BIGINT) AS count, count(*) AS "unique",
       arg_max(value, struct_pack(n := n, neg := -rank)) AS top, max(n) AS freq
FROM (SELECT {c} AS value, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, {c}) AS rank
      FROM documents WHERE {c} IS NOT NULL GROUP BY {c})""" for c in _TXT))
def q_describe_text(spark, sf_dir):
    """A11 for text columns: count, unique, top, freq."""
    return P.describe_text(td.table(spark, sf_dir, "documents"), _TXT)
