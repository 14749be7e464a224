"""Tokens with lemmas from a joined table."""
import re
from collections import Counter

from pyspark.sql import functions as F

from tidemark.functions.text import tokens
from tidemark.operators.lemmas import lemma_tokens

LEMMAS = [("Words", "Word"), ("words", "word"), ("mice", "mouse"), ("it", " Padded "), ("two", "b"), ("two", "a"), (None, "x"), ("lost", None)]


def expected(text):
    if text is None:
        return None
    of = {}
    for w, l in LEMMAS:
        if w is not None and l is not None:
            of[w] = min(l, of.get(w, l))
    return tuple(of.get(t, t).lower().strip() for t in re.findall(r"[^\W_]+|[^\w\s]|_", text))


def run(spark, rows):
    docs = spark.createDataFrame(rows, "id int, text string, word string")
    got = lemma_tokens(docs, "id", "text", spark.createDataFrame(LEMMAS, "word string, lemma string"))
    assert got.columns == ["id", "tokens"]
    return Counter((r.id, None if r.tokens is None else tuple(r.tokens)) for r in got.collect())


def test_order_case_and_ties(spark):
    rows = [(1, "Words, words and MICE mice: it is two lost words.", "x"), (2, "mice mice mice", None), (3, "none here", "it")]
    assert run(spark, rows) == Counter((i, expected(t)) for i, t, _ in rows)
    assert expected(rows[0][1])[:6] == ("word", ",", "word", "and", "mice", "mouse")


def test_null_empty_and_repeated_rows(spark):
    rows = [(1, None, "a"), (1, "", "a"), (1, "  ", "a"), (None, "mice a mice", "a"), (None, "mice a mice", "b"), (4, "it", "a"), (4, "mice it", "a"),
            (5, None, "a"), (5, None, "a"), (6, "", "a"), (6, "", "a")]
    assert run(spark, rows) == Counter((i, expected(t)) for i, t, _ in rows)
    assert run(spark, []) == Counter()


def test_a_long_text_and_a_word_of_every_text(spark):
    long = "mice and words " * 20_000
    rows = [(i, f"mice {i} words", "") for i in range(500)] + [(1000, long, "")]
    assert run(spark, rows) == Counter((i, expected(t)) for i, t, _ in rows)


def test_an_empty_table_changes_nothing(spark):
    docs = spark.createDataFrame([(1, "Some Words, some words"), (2, None)], "id int, text string")
    none = spark.createDataFrame([], "word string, lemma string")
    got = {r.id: r.tokens for r in lemma_tokens(docs, "id", "text", none).collect()}
    assert got == {r.id: r.t for r in docs.select("id", tokens("text").alias("t")).collect()}


def test_no_literal_map_and_no_python_in_the_plan(spark):
    docs = spark.range(10).select("id", F.lit("mice").alias("text"))
    plan = lemma_tokens(docs, "id", "text", spark.createDataFrame(LEMMAS, "word string, lemma string"))._jdf.queryExecution().executedPlan().toString()
    assert "map(" not in plan and "Python" not in plan and "Cartesian" not in plan


def test_tokens_are_not_shuffled_with_a_small_table(spark):
    docs = spark.range(10).select("id", F.lit("mice and words").alias("text"))
    few = spark.createDataFrame(LEMMAS, "word string, lemma string").coalesce(1).limit(20)
    plan = lemma_tokens(docs, "id", "text", few)._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"Exchange (?:hashpartitioning\(_\w*id#|SinglePartition, REPARTITION)[^\n]*", plan)
    assert "BroadcastHashJoin" in plan and len(dealt) == 1 and "REPARTITION_BY_NUM" in dealt[0], plan
