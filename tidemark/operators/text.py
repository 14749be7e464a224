"""Bag of words and TF-IDF as DataFrame jobs.

The words of a document are dealt out by its id, one row for a text, and only then
exploded to (doc, term) rows: counts and the normalisation by document (a window, bounded
by the document's own length) need no further shuffle of such rows. The vocabulary is an
aggregate over terms, partly added up before its shuffle. Nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import TOKEN_PATTERN, tokens
from tidemark.session import written_table


#: Buckets of term hashes that occurrences are first counted in.
BUCKETS = 1 << 14
#: Dropped terms are sent to all tasks up to this number; more are joined by a shuffle.
SENT_TERMS = 100_000
#: Bytes of text whose terms a task counts, about.
TASK_TEXT = 4 << 20


def text_tasks(docs: DataFrame, text: str) -> int:
    """Number of tasks of about ``TASK_TEXT`` bytes of text each: they grow in number with the texts, not in size."""
    size = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    return max(1, -(-int(size) // TASK_TEXT))


def _words(docs: DataFrame, doc_id: str, text: str, pattern: str = TOKEN_PATTERN, lemmas=None) -> tuple[DataFrame, Column]:
    """(doc_id, _words), a row for each text, and the array of words from it. Tokens of the usual pattern hold no
    line break and are never empty: they travel as one string, a fraction of an array's size."""
    words = tokens(text, pattern, lemmas)
    if pattern == TOKEN_PATTERN and not lemmas:
        line = docs.select(F.col(doc_id).alias("doc_id"), F.array_join(words, "\n").alias("_words"))
        return line, F.split(F.col("_words"), "\n")
    return docs.select(F.col(doc_id).alias("doc_id"), words.alias("_words")), F.col("_words")


def _terms(words: DataFrame, made: Column, ngram_max: int) -> DataFrame:
    """(doc_id, term) for every word, and every pair of neighbours when ngram_max=2."""
    if ngram_max > 1:
        def with_pairs(t):
            last = F.greatest(F.size(t) - 1, F.lit(0))
            return F.concat(t, F.zip_with(F.slice(t, F.lit(1), last), F.slice(t, F.lit(2), last),
                                          lambda a, b: F.concat_ws(" ", a, b)))

        # the words are bound by a one-element array: made once, used several times
        made = F.flatten(F.transform(F.array(made), with_pairs))
    return words.select("doc_id", F.explode(made).alias("term")).where(F.col("term") != "")


def term_counts(docs: DataFrame, doc_id: str, text: str, ngram_max: int = 1,
                pattern: str = TOKEN_PATTERN, lemmas=None) -> DataFrame:
    """(doc, term, count) for every token (and word pair when ngram_max=2).

    Texts are tokenised in the scan stage; the words of a text are shuffled as one row, by the document.
    All counts of a document are then in one task, and users of the counts that keep all three columns
    share this one exchange, so texts are tokenised once per query."""
    words, made = _words(docs, doc_id, text, pattern, lemmas)
    t = _terms(words.repartition(text_tasks(docs, text), "doc_id"), made, ngram_max)
    return t.groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("count"))


def doc_count(docs: DataFrame) -> DataFrame:
    """Number of documents as a one-row frame (``__n``): scikit-learn's n
    counts every document, empty ones included; an id-only scan. Only this
    one number reaches the driver."""
    return docs.agg(F.count(F.lit(1)).cast("double").alias("__n"))


def _n_value(counts: DataFrame, n_docs) -> float:
    """The document count as a number (one scalar to the driver)."""
    if n_docs is None:
        n_docs = counts.agg(F.count_distinct("doc_id").cast("double").alias("__n"))
    if isinstance(n_docs, DataFrame):
        return float(n_docs.first()["__n"] or 0.0)
    return float(n_docs)


def _term_stats(counts: DataFrame) -> DataFrame:
    """(term, df, tf). ``df`` reads ``count`` (always positive) so that no column of the
    counts is pruned and their exchange can be reused."""
    return counts.groupBy("term").agg(F.sum(F.when(F.col("count") > 0, 1)).alias("df"), F.sum("count").alias("tf"))


def vocabulary(counts: DataFrame, n_docs=None, max_df: float = 1.0,
               max_features: int | None = None) -> DataFrame:
    """Terms kept by document frequency (df <= max_df * n_docs, as
    scikit-learn) and, optionally, the ``max_features`` most frequent ones
    (total count, ties by term). ``n_docs``: an int, a one-row frame from
    ``doc_count``, or None (documents with at least one token)."""
    stats = _term_stats(counts)
    if max_df < 1.0:
        stats = stats.filter(F.col("df") <= F.lit(_n_value(counts, n_docs) * max_df))
    if max_features:
        stats = stats.orderBy(F.desc("tf"), F.asc("term")).limit(max_features)
    return stats


def bag_of_words(docs: DataFrame, doc_id: str, text: str, ngram_max: int = 1, max_df: float = 1.0,
                 max_features: int | None = None) -> DataFrame:
    """(doc_id, term, count) restricted to the vocabulary."""
    c = term_counts(docs, doc_id, text, ngram_max)
    if max_df >= 1.0 and not max_features:
        return c
    if max_features:
        v = vocabulary(c, doc_count(docs), max_df, max_features).select("term")
        return c.join(v, "term").select("doc_id", "term", "count")  # inner: a semi join would be pushed below the counts
    return _without_frequent(docs, doc_id, text, ngram_max, c, _n_value(c, doc_count(docs)) * max_df)


def _without_frequent(docs: DataFrame, doc_id: str, text: str, ngram_max: int, counts: DataFrame, most: float) -> DataFrame:
    """The counts without the terms of more than ``most`` documents.

    The dropped terms are found, not the kept ones. A term of so many documents comes at least as often, so it is in a
    bucket (of its hash) with more than ``most`` occurrences: only terms of such buckets are counted by document."""
    bucket = F.pmod(F.xxhash64("term"), F.lit(BUCKETS))
    everywhere = _terms(*_words(docs, doc_id, text), ngram_max).groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n"))
    full = {r["b"]: r["n"] for r in everywhere.where(F.col("n") > F.lit(most)).collect()}  # BUCKETS rows at most
    if not full:
        return counts
    often = _term_stats(counts.where(bucket.isin(list(full)))).where(F.col("df") > F.lit(most)).select(F.col("term").alias("_often"))
    if sum(full.values()) <= SENT_TERMS * most:  # then there are no more than SENT_TERMS of them
        often = F.broadcast(often)
    kept = counts.join(often.withColumn("_drop", F.lit(True)), F.col("term") == F.col("_often"), "left")
    return kept.where(F.col("_drop").isNull()).select("doc_id", "term", "count")


def tf_idf(counts: DataFrame, use_idf: bool = True, norm: bool = True, n_docs=None) -> DataFrame:
    """scikit-learn's default weighting: tf * (ln((1+n)/(1+df)) + 1),
    then L2-normalised per document. (MLlib's IDF omits the +1 and the norm.)
    ``n_docs`` as in ``vocabulary`` (pass ``doc_count(docs)``). The document frequencies are written
    first: Spark then knows their size, and shuffles the counts only for a vocabulary that is too large to send."""
    x = counts
    if use_idf:
        n = _n_value(counts, n_docs)
        df = written_table(_term_stats(counts).select("term", "df"), "document-frequencies")
        x = x.join(df, "term").withColumn(
            "w", F.col("count") * (F.log(F.lit(1.0 + n) / (1.0 + F.col("df"))) + 1.0))
    else:
        x = x.withColumn("w", F.col("count").cast("double"))
    if norm:
        w = Window.partitionBy("doc_id")
        x = x.withColumn("w", F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(w)))
    return x.select("doc_id", "term", F.col("w").alias("weight"))
