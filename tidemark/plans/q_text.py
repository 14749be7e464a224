"""Text queries on the messages stand-in."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.functions.text import TOKEN_PATTERN, raw_tokens, tokens
from tidemark.operators.frozen import fit_vocabulary, vector_batches, weigh
from tidemark.operators.lemmas import lemma_tokens
from tidemark.operators.sample import hash_split
from tidemark.operators.text import bag_of_words, doc_count, tf_idf, term_counts
from tidemark.plans.q_sample import h_sql
from tidemark.plans.registry import register
from tidemark.session import scratch_table_path
from tidemark.sources import testdata as td
from tidemark.streaming.stream import file_stream

_TOK_SQL = ("list_transform(regexp_extract_all(text, '" + TOKEN_PATTERN.replace("'", "''") +
            "'), lambda t: lower(trim(t)))")


@register("tokenize", f"""
SELECT doc_id, CAST(len({_TOK_SQL}) AS INTEGER) AS n_tokens, array_to_string({_TOK_SQL}, ' ') AS tokens
FROM documents
""")
def q_tokenize(spark, sf_dir):
    """F13 (re-aimed): whole-text tokens, lower-cased and trimmed."""
    d = td.table(spark, sf_dir, "documents")
    made = F.transform(F.array(tokens("text")), lambda t: F.struct(F.size(t).alias("n_tokens"), F.array_join(t, " ").alias("tokens")))
    return d.select("doc_id", F.inline(made))


_RAW_SQL = "regexp_extract_all(text, '" + TOKEN_PATTERN.replace("'", "''") + "')"


def _lemma_table(spark, sf_dir):
    """Stand-in lemma table: words of the benchmark items of four letters and more, and the same without the last letter."""
    raw = F.explode(raw_tokens("text")).alias("word")
    return td.table(spark, sf_dir, "benchmark").select(raw).distinct().where("length(word) >= 4").selectExpr(
        "word", "left(word, length(word) - 1) AS lemma")


@register("tokenize_lemmas", f"""
WITH l AS (SELECT DISTINCT word, left(word, length(word) - 1) AS lemma
           FROM (SELECT unnest({_RAW_SQL}) AS word FROM benchmark) WHERE length(word) >= 4),
r AS (SELECT doc_id, {_RAW_SQL} AS raw FROM documents),
t AS (SELECT doc_id, unnest(raw) AS word, generate_subscripts(raw, 1) AS pos FROM r),
m AS (SELECT doc_id, list(lower(trim(coalesce(lemma, t.word))) ORDER BY pos) AS tokens FROM t LEFT JOIN l ON t.word = l.word GROUP BY doc_id)
SELECT r.doc_id, CAST(len(r.raw) AS INTEGER) AS n_tokens, coalesce(array_to_string(m.tokens, ' '), '') AS tokens
FROM r LEFT JOIN m ON r.doc_id = m.doc_id
""")
def q_tokenize_lemmas(spark, sf_dir):
    """F13 with a joined lemma table: whole-text tokens in order, lemma of the token as written, then lower-cased and trimmed."""
    t = lemma_tokens(td.table(spark, sf_dir, "documents"), "doc_id", "text", _lemma_table(spark, sf_dir))
    return t.select("doc_id", F.size("tokens").alias("n_tokens"), F.array_join("tokens", " ").alias("tokens"))


BOW_SQL = f"""
WITH t AS (SELECT doc_id, unnest({_TOK_SQL}) AS term FROM documents),
c AS MATERIALIZED (SELECT doc_id, term, count(*) AS count FROM t GROUP BY ALL),
v AS (SELECT term FROM c GROUP BY term HAVING count(*) <= 0.5 * (SELECT count(*) FROM documents))
SELECT doc_id, term, count FROM c JOIN v USING (term)
"""


@register("bag_of_words", BOW_SQL)
def q_bag_of_words(spark, sf_dir):
    """term counts per document, terms in more than half of the
    documents dropped (max_df = 0.5)."""
    return bag_of_words(td.table(spark, sf_dir, "documents"), "doc_id", "text", max_df=0.5)


@register("bag_of_words_top", f"""
WITH t AS (SELECT doc_id, unnest({_TOK_SQL}) AS term FROM documents),
c AS MATERIALIZED (SELECT doc_id, term, count(*) AS count FROM t GROUP BY ALL),
v AS (SELECT term FROM c GROUP BY term ORDER BY sum(count) DESC, term LIMIT 500)
SELECT doc_id, term, count FROM c WHERE term IN (SELECT term FROM v)
""")
def q_bag_of_words_top(spark, sf_dir):
    """F14 with max_features = 500 (the most frequent terms, ties by term)."""
    return bag_of_words(td.table(spark, sf_dir, "documents"), "doc_id", "text", max_features=500)


@register("tf_idf", f"""
WITH t AS (SELECT doc_id, unnest({_TOK_SQL}) AS term FROM documents),
c AS MATERIALIZED (SELECT doc_id, term, count(*) AS count FROM t GROUP BY ALL),
n AS (SELECT count(*) AS n FROM documents),
d AS (SELECT term, count(*) AS df FROM c GROUP BY term),
w AS (SELECT doc_id, term, count * (ln((1.0 + n.n) / (1.0 + df)) + 1.0) AS w FROM c JOIN d USING (term), n)
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM w
""")
def q_tf_idf(spark, sf_dir):
    """scikit-learn-style TF-IDF with L2 norm per document (n = number
    of documents)."""
    docs = td.table(spark, sf_dir, "documents")
    c = term_counts(docs, "doc_id", "text")
    return tf_idf(c, n_docs=doc_count(docs)).select("doc_id", "term", F.round("weight", 6).alias("weight"))


_PAIRS_SQL = f"""
WITH w AS (SELECT doc_id, {_TOK_SQL} AS t FROM documents),
t AS (SELECT doc_id, unnest(list_concat(t, list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))) AS term FROM w),
c AS MATERIALIZED (SELECT doc_id, term, count(*) AS count FROM t GROUP BY ALL)
"""


@register("bag_of_pairs", _PAIRS_SQL + """,
v AS (SELECT term FROM c GROUP BY term HAVING count(*) <= 0.75 * (SELECT count(*) FROM documents))
SELECT doc_id, term, count FROM c JOIN v USING (term)
""")
def q_bag_of_pairs(spark, sf_dir):
    """F14 with words and word pairs, max_df = 0.75."""
    return bag_of_words(td.table(spark, sf_dir, "documents"), "doc_id", "text", ngram_max=2, max_df=0.75)


@register("tf_weights", f"""
WITH t AS (SELECT doc_id, unnest({_TOK_SQL}) AS term FROM documents),
c AS MATERIALIZED (SELECT doc_id, term, count(*) AS count FROM t GROUP BY ALL)
SELECT doc_id, term, round(count / sqrt(sum(count * count) OVER (PARTITION BY doc_id)), 6) AS weight FROM c
""")
def q_tf_weights(spark, sf_dir):
    """F15 without idf: L2-normalised term counts per document."""
    c = term_counts(td.table(spark, sf_dir, "documents"), "doc_id", "text")
    return tf_idf(c, use_idf=False).select("doc_id", "term", F.round("weight", 6).alias("weight"))


#: Document frequencies of the train split (words and pairs, at most half of its messages) weigh the terms of the test split.
_FROZEN_SQL = _PAIRS_SQL + f""",
s AS (SELECT doc_id, {h_sql('doc_id', 5)} / 4294967296.0 < 0.75 AS train FROM documents),
n AS (SELECT count(*) AS n FROM s WHERE train),
d AS (SELECT term, count(*) AS df FROM c JOIN s USING (doc_id) WHERE train GROUP BY term
      HAVING count(*) <= 0.5 * (SELECT n FROM n)),
g AS (SELECT doc_id, term, count * (ln((1.0 + (SELECT n FROM n)) / (1.0 + df)) + 1.0) AS w
      FROM c JOIN s USING (doc_id) JOIN d USING (term) WHERE NOT train)
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM g
"""


def _frozen(spark, sf_dir):
    """Vocabulary of the train split, and the test split's messages."""
    docs = hash_split(td.table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", 0.25, 5)
    vocab = fit_vocabulary(docs.where("split = 'train'"), "doc_id", "text", ngram_max=2, max_df=0.5)
    return vocab, docs.where("split = 'test'").drop("split")


@register("tf_idf_new_messages", _FROZEN_SQL)
def q_tf_idf_new_messages(spark, sf_dir):
    """F14 + F15 fitted once: the vocabulary and idf of the train split, saved and loaded, weigh the
    terms of messages that it has not seen."""
    vocab, new = _frozen(spark, sf_dir)
    path = scratch_table_path(spark, f"vocabularies/{uuid.uuid4().hex}")
    vocab.save(path)
    return weigh(type(vocab).load(spark, path), new, "doc_id", "text").select("doc_id", "term", F.round("weight", 6).alias("weight"))


@register("stream_tf_idf_new_messages", _FROZEN_SQL)
def q_stream_tf_idf_new_messages(spark, sf_dir):
    """F14 + F15 on a stream: new messages arrive in several micro-batches, each joined to the stored
    vocabulary and put together as one vector per message."""
    vocab, new = _frozen(spark, sf_dir)
    path = scratch_table_path(spark, f"streams/messages-{uuid.uuid4().hex}")
    new.repartition(4).write.parquet(path)
    out = spark.read.parquet(vector_batches(vocab, file_stream(spark, path, new.schema), "doc_id", "text", f"messages-{uuid.uuid4().hex}"))
    return out.select("doc_id", F.inline("terms")).select("doc_id", "term", F.round("weight", 6).alias("weight"))
