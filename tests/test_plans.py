"""Plan properties: no Python UDF in the hot path, no cartesian product,
filters and projections reach the scan, one scan for the feature table."""

import pytest

from tests.conftest import SF001
from tidemark.plans.registry import queries

Q = queries()
HOT = ["churn_user_bins", "host_state", "process_context", "cohort_hourly_rates", "describe",
       "clean_demographics", "prepare_census", "tokenize", "bag_of_words", "tf_idf", "roc_points",
       "area_under_roc", "symmetric_difference", "best_by", "expand_labels"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", HOT)
def test_no_python_udf_no_cartesian(spark, name):
    p = plan(Q[name](spark, SF001))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_pushdown_and_pruning(spark):
    p = plan(Q["filter_project"](spark, SF001))
    assert "PushedFilters: [IsNotNull(event_type), IsNotNull(value), EqualTo(event_type,view)" in p
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,event_type:string,value:double>" in p


def test_feature_table_single_scan(spark):
    from pyspark.sql import functions as F
    from tidemark.operators.bins import user_time_bins
    ev = spark.read.parquet(f"{SF001}/events.parquet").select(
        F.col("user_id").cast("string").alias("userId"), F.unix_timestamp("ts").alias("ts"),
        F.lit(0).cast("long").alias("registration"), F.col("event_type").alias("page"),
        F.lit("free").alias("level"), F.lit("M").alias("gender"), F.col("event_id").alias("sessionId"),
        F.lit(None).cast("string").alias("artist"), F.lit(None).cast("string").alias("song"))
    p = plan(user_time_bins(ev, 7, pages=["view"]))
    assert p.count("FileScan parquet") == 1


def test_state_join_slices_hot_keys(spark):
    """The expanded event rows are shuffled by (key, time bucket), never by
    the key alone, so one hot host cannot land in a single task."""
    p = plan(Q["host_state"](spark, SF001))
    assert "hashpartitioning(_key#" in p
    for line in p.splitlines():
        if "Exchange hashpartitioning(_key#" in line and "_bucket" not in line:
            # only the small per-slice carry table may be keyed by _key alone
            assert "Window" not in line
    assert "_bucket" in p


def test_texts_are_tokenised_once_and_never_shuffled(spark):
    """Terms are counted in the scan stage; the exchange carries (doc, term, count)
    and is reused, so the final plan tokenises once."""
    for name in ("bag_of_words", "bag_of_words_top", "bag_of_pairs", "tf_idf", "tf_weights", "tokenize"):
        df = Q[name](spark, SF001)
        df.collect()
        p = df._jdf.queryExecution().executedPlan().toString()
        p = p.split("== Initial Plan ==")[0]
        assert p.count("regexp_extract_all") == 1, name
        assert not any("Exchange" in line and "text#" in line for line in p.splitlines()), name


def test_quantiles_read_their_input_twice(spark):
    """One read for sketches and moments, one for the exact ranks."""
    from pyspark.sql import functions as F
    from tidemark.operators.profile import describe, describe_by
    from tidemark.operators.quantiles import exact_quantiles
    events = spark.read.parquet(f"{SF001}/events.parquet").withColumn("k", F.col("user_id") % 7)
    for df in (describe(events, ["value", "user_id"]), describe_by(events, "k", ["value", "user_id"]),
               exact_quantiles(events, ["value"], [0.1, 0.9], ["k"])):
        # the first read is done by now: its numbers are literals, or a written table
        assert plan(df).count("events.parquet") == 1


def test_a_missed_bracket_is_an_error_not_an_answer(spark):
    from tidemark.operators.quantiles import exact_quantiles_of_columns
    df = spark.range(100).selectExpr("CAST(id AS DOUBLE) AS x")
    assert exact_quantiles_of_columns(df, {"x": [49.0, 50.0]}, [0.5]).first()["value"] == 49.5
    with pytest.raises(Exception, match="outside its bracket"):
        exact_quantiles_of_columns(df, {"x": [60.0, 70.0]}, [0.5]).collect()
