"""Counts of terms stay in the task of their document."""
import re
from collections import Counter, defaultdict

import pytest

from tidemark.operators import text as T

ROWS = [(1, "The storm, the flood"), (1, "the water"), (2, "the storm"), (3, None), (None, "the quiet day"), (None, "day the storm"), (4, ""), (5, "the  THE the")]


def docs(spark):
    return spark.createDataFrame(ROWS, "id int, message string")


def brute(ngram):
    out = defaultdict(Counter)
    for i, t in ROWS:
        w = [x.lower() for x in re.findall(r"[^\W_]+|[^\w\s]|_", t or "")]
        out[i].update(w + ([f"{a} {b}" for a, b in zip(w, w[1:])] if ngram == 2 else []))
    return out


def exchanges(df):
    df.collect()
    return [line for line in df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].splitlines() if "Exchange hashpartitioning" in line]


@pytest.mark.parametrize("ngram", [1, 2])
@pytest.mark.parametrize("share", [0.1, 0.3, 0.5, 0.99])
def test_dropped_terms_equal_brute_force(spark, ngram, share):
    counts = brute(ngram)
    df = Counter(t for c in counts.values() for t in c)
    want = {(i, t, n) for i, c in counts.items() for t, n in c.items() if df[t] <= share * len(ROWS)}
    got = [tuple(r) for r in T.bag_of_words(docs(spark), "id", "message", ngram, share).collect()]
    assert len(got) == len(want) and set(got) == want


def test_a_bucket_holds_other_terms_too(spark, monkeypatch):
    monkeypatch.setattr(T, "BUCKETS", 1)
    monkeypatch.setattr(T, "SENT_TERMS", 0)
    got = {tuple(r) for r in T.bag_of_words(docs(spark), "id", "message", 1, 0.49).collect()}
    counts = brute(1)
    assert got == {(i, t, n) for i, c in counts.items() for t, n in c.items() if t != "the"} and counts[1]["the"] == 3


def test_counts_are_not_shuffled(spark):
    d = docs(spark)
    for df in (T.bag_of_words(d, "id", "message", 2, 0.5), T.tf_idf(T.term_counts(d, "id", "message"), n_docs=T.doc_count(d))):
        assert not any(re.search(r"doc_id#\w+, term#", line) for line in exchanges(df))


def test_tasks_grow_in_number(spark):
    d = spark.range(9).selectExpr("id", f"repeat('word ', {T.TASK_TEXT // 5}) AS message")
    assert T.text_tasks(d.limit(0), "message") == 1 and T.text_tasks(d, "message") == 9


def test_a_fit_shuffles_sums_by_term_only(spark, monkeypatch):
    from tidemark.operators.text_model import TextFeatures
    d, seen = docs(spark), []
    collect = type(d).collect
    monkeypatch.setattr(type(d), "collect", lambda self: (seen.append(self), collect(self))[1])
    model = TextFeatures(ngramMax=2, maxDF=0.6, maxFeatures=4).fit(d)
    keys = [line for line in exchanges(seen[0]) if "hashpartitioning" in line]
    assert keys and not any(re.search(r"\(id#", line) for line in keys)
    assert model.stages[1].vocabulary == ["storm", "the storm", "day", "the the"]
