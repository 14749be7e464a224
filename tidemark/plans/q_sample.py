"""Sampling and splitting queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.sample import first_n_by_hash, hash_split, stratified_sample
from tidemark.plans.registry import register
from tidemark.sources import testdata as td

_H = "('0x' || substr(md5(CAST({k} AS VARCHAR) || '{s}'), 1, 8))::BIGINT"


def h_sql(k, s):
    return _H.format(k=k, s=s)


@register("sample_exact", f"""
SELECT * FROM events ORDER BY {h_sql('event_id', 42)}, event_id LIMIT 1000
""")
def q_sample_exact(spark, sf_dir):
    """Exactly 1000 events without replacement, reproducible by seed
    (radix selection on the hash; no global sort)."""
    return first_n_by_hash(td.table(spark, sf_dir, "events"), 1000, "event_id", 42)


@register("take_prefix", f"""
SELECT * FROM orders
QUALIFY row_number() OVER (ORDER BY {h_sql('o_orderkey', 7)}, o_orderkey) <= (SELECT count(*) // 10 FROM orders)
""")
def q_take_prefix(spark, sf_dir):
    """The first 10 % of the orders in a fixed hash order (learning-curve
    subsets: the same rows for 1 %, 10 %, 100 %)."""
    o = td.table(spark, sf_dir, "orders")
    return first_n_by_hash(o, o.count() // 10, "o_orderkey", 7)


@register("stratified_sample", f"""
WITH {td.MUSIC_SQL}
SELECT event_id, userId, page FROM music_raw
WHERE (page = 'error') OR (page <> 'error' AND {h_sql('event_id', 3)} / 4294967296.0 < 0.065)
""")
def q_stratified_sample(spark, sf_dir):
    """Positives kept, negatives kept at 0.065 (hash-decided)."""
    ev = td.music_events_raw(spark, sf_dir).withColumn("y", (F.col("page") == "error").cast("int"))
    return stratified_sample(ev, "y", {1: 1.0, 0: 0.065}, "event_id", 3).select("event_id", "userId", "page")


@register("hash_split", f"""
WITH {td.CENSUS_SQL}
SELECT o_orderkey, CASE WHEN {h_sql('o_orderkey', 147309)} / 4294967296.0 < 0.8 THEN 'train' ELSE 'test' END AS split
FROM census
""")
def q_hash_split(spark, sf_dir):
    """Stable 80/20 split (seed 147309)."""
    c = td.census(spark, sf_dir).select("o_orderkey")
    return hash_split(c, "o_orderkey", 0.2, 147309)
