"""Lookups that count what they could not map."""
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidemark.operators.lookup import lookup_default, map_lookup, observe_unmapped, unmapped_codes, written_with_unmapped
from tidemark.plans.demographics import MIXED_LOOKUPS, clean_demographics
from tidemark.sources import testdata as td
from tests.conftest import SF001

LOOKUPS = {"a": ("a", "va"), "b": ("b", "vb")}


def looked_up(spark, rows):
    df = spark.createDataFrame(rows, "a int, b string")
    return df.select("a", "b", map_lookup("a", {1: "x", 2: "y"}).alias("va"), map_lookup("b", {"k": 7}).alias("vb"))


def test_counts_and_codes(spark):
    rows = [(1, "k"), (2, "q"), (3, None), (3, "q"), (None, "z"), (4, "k")]
    out, seen = written_with_unmapped(looked_up(spark, rows).repartition(3), "t", LOOKUPS)
    assert seen == {"rows": 6, "a": 3, "b": 3}
    assert {tuple(r) for r in unmapped_codes(out, LOOKUPS).collect()} == {("a", "3", 2), ("a", "4", 1), ("b", "q", 2), ("b", "z", 1)}
    assert out.count() == 6 and out.columns == ["a", "b", "va", "vb"]


@pytest.mark.parametrize("rows", [[], [(None, None)], [(1, "k")] * 5])
def test_nothing_unmapped(spark, rows):
    out, seen = written_with_unmapped(looked_up(spark, rows), "t", LOOKUPS)
    assert seen == {"rows": len(rows), "a": 0, "b": 0}
    assert unmapped_codes(out, LOOKUPS).count() == 0


def test_a_joined_lookup_with_a_hot_unknown_code(spark):
    """A dictionary joined by a shuffle; a third of the rows hold one code that it lacks."""
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 50).cast("string").alias("code"))
    dim = spark.range(50).select(F.col("id").cast("string").alias("code"), F.concat(F.lit("n"), "id").alias("name"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        _, seen = written_with_unmapped(df.join(dim, "code", "left"), "t", {"name": ("code", "name")})
        named = lookup_default(df, dim, "code", "name", "out")
        assert named.where("out = 'Unknown'").count() == 3000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert seen == {"rows": 9000, "name": 3000}


def test_the_counts_cost_no_scan(spark):
    df = looked_up(spark, [(1, "k")])
    plan = observe_unmapped(df, Observation(), LOOKUPS)._jdf.queryExecution().executedPlan().toString()
    assert "CollectMetrics" in plan and "Exchange" not in plan


def test_cleaning_reports_unmapped_codes(spark):
    seen = Observation()
    x = clean_demographics(td.population(spark, SF001), td.demo_meta(spark), unmapped=seen)
    n = len(x.collect())
    assert seen.get == {"rows": n, "decade_code": 0, "cameo": 0}  # the feature summary has made their codes null
    raw, seen = td.population(spark, SF001), Observation()
    meta = td.demo_meta(spark).withColumn("missing_or_unknown", F.lit("[]"))
    kept = clean_demographics(raw, meta, unmapped=seen)
    kept.collect()
    assert seen.get["decade_code"] == raw.where("decade_code = 0").count() > 0
    assert set(seen.get) == {"rows", *MIXED_LOOKUPS}
