"""Column and row rules by themselves."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scalar as X
from tidemark.operators import clean as C
from tidemark.operators.rank import head, order_by
from tidemark.plans.registry import register
from tidemark.sources import testdata as td


@register("column_rules", """
SELECT event_id AS id, CAST(value >= 50 AS INTEGER) AS paid, coalesce(value > 20, false) AS above, 1 AS marker,
       user_id IS NOT NULL AS has_user, CAST(floor((epoch_ms(ts) - 1600000000000) / 86400000.0) AS BIGINT) AS days FROM events
""")
def q_column_rules(spark, sf_dir):
    """P03 header, P05 booleans to ints, P07 constant, P10 threshold, P21 presence, X12 days between."""
    ev = td.table(spark, sf_dir, "events").select("event_id", (F.col("value") >= 50).alias("paid"), "value", "user_id", "ts")
    ev = C.set_header(ev, ["id", "paid", "value", "user_id", "ts"])
    ev = C.with_constant(C.bool_to_int(ev, ["paid"]), "marker")
    ms = F.floor(X.epoch_micros("ts") / 1000)
    return ev.select("id", "paid", C.threshold_flag(F.col("value"), ">", 20).alias("above"), "marker",
                     C.has_value("user_id").alias("has_user"),
                     F.floor(X.days_between_ms(ms, F.lit(1600000000000))).alias("days"))


@register("code_lists", """
SELECT p_partkey, list_transform(string_split('[' || p_size || ', X' || (p_partkey % 3) || ',0]', ','), lambda t: trim(trim(t), '[]')) AS codes
FROM part
""")
def q_code_lists(spark, sf_dir):
    """A bracketed list as text -> array of codes."""
    part = td.table(spark, sf_dir, "part")
    text = F.concat(F.lit("["), F.col("p_size").cast("string"), F.lit(", X"), (F.col("p_partkey") % 3).cast("string"), F.lit(",0]"))
    return part.select("p_partkey", C.parse_code_list(text).alias("codes"))


@register("first_orders", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100
""")
def q_first_orders(spark, sf_dir):
    """T01 + T02: the first rows of a stated order (a top-k report)."""
    o = td.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    order = [F.desc("o_totalprice"), F.asc("o_orderkey")]
    return order_by(head(o, 100, order), order)


@register("scored_customers", """
WITH s AS (SELECT o_custkey, o_orderpriority IN ('1-URGENT', '2-HIGH') AS y, o_totalprice > 150000 AS p FROM orders),
c AS (SELECT o_custkey, count(*) AS n, count(*) FILTER (WHERE y AND p) AS tp, count(*) FILTER (WHERE p AND NOT y) AS fp,
             count(*) FILTER (WHERE y AND NOT p) AS fn, count(*) FILTER (WHERE y = p) AS right_ FROM s GROUP BY o_custkey)
SELECT o_custkey, round(tp / nullif(tp + fp, 0), 6) AS precision, round(tp / nullif(tp + fn, 0), 6) AS recall,
       round(right_ / n, 6) AS accuracy FROM c
""")
def q_scored_customers(spark, sf_dir):
    """Precision, recall and accuracy of a rule per customer."""
    o = td.table(spark, sf_dir, "orders")
    s = o.select("o_custkey", F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("y"), (F.col("o_totalprice") > 150000).alias("p"))
    y, p = F.col("y"), F.col("p")
    c = s.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(y & p).alias("tp"), F.count_if(p & ~y).alias("fp"),
                                   F.count_if(y & ~p).alias("fn"), F.count_if(y == p).alias("right_"))
    return c.select("o_custkey", F.round(X.precision("tp", "fp"), 6).alias("precision"), F.round(X.recall("tp", "fn"), 6).alias("recall"),
                    F.round(X.accuracy("right_", "n"), 6).alias("accuracy"))
