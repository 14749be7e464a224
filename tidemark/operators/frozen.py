"""A vocabulary fitted once and applied to new messages.

The vocabulary is a table (term, df, idf) of any size: it is stored as Parquet,
joined to the counted terms of unseen messages and never collected. Terms that it
does not know count for nothing. Weights are ``count * idf`` with the smoothed idf
of the fitted messages, L2-normalised over a message's known terms. The same
function runs on a batch and on the micro-batches of a stream.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.text import doc_count, term_counts, vocabulary
from tidemark.session import written_table
from tidemark.streaming.stream import stream_folder


@dataclass(frozen=True)
class Vocabulary:
    """``terms``: (term, df, idf), one row per kept term; ``ngram_max``: 2 with word pairs."""
    terms: DataFrame
    ngram_max: int = 1

    def save(self, path: str) -> None:
        self.terms.write.mode("overwrite").parquet(f"{path}/terms")
        self.terms.sparkSession.createDataFrame([(self.ngram_max,)], "ngram_max int").write.mode("overwrite").parquet(f"{path}/options")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Vocabulary:
        return Vocabulary(spark.read.parquet(f"{path}/terms"), spark.read.parquet(f"{path}/options").first()["ngram_max"])


def fit_vocabulary(docs: DataFrame, doc_id: str, text: str, ngram_max: int = 1, max_df: float = 1.0,
                   max_features: int | None = None, use_idf: bool = True) -> Vocabulary:
    """The terms of ``docs`` kept by document frequency and, optionally, total count, with the idf
    ``ln((1 + n) / (1 + df)) + 1`` over all ``n`` documents (1 without ``use_idf``)."""
    n = doc_count(docs).first()["__n"]
    kept = vocabulary(term_counts(docs, doc_id, text, ngram_max), n, max_df, max_features)
    idf = F.log(F.lit(1.0 + n) / (1.0 + F.col("df"))) + 1.0 if use_idf else F.lit(1.0)
    return Vocabulary(written_table(kept.select("term", "df", idf.alias("idf")), "vocabulary"), ngram_max)


def weigh(vocab: Vocabulary, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, term, weight) of the known terms of each message."""
    counts = term_counts(docs, doc_id, text, vocab.ngram_max)
    x = counts.join(vocab.terms, "term").withColumn("w", F.col("count") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("doc_id")))
    return x.select("doc_id", "term", (F.col("w") / norm).alias("weight"))


def vectors(vocab: Vocabulary, docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """One row per message: ``doc_id`` and ``terms``, its known terms with weights in the order of the
    terms; empty for a message without any (null and empty texts too). Repeated ids count as one message."""
    per = weigh(vocab, docs, doc_id, text).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("term", "weight"))).alias("terms"))
    ids = docs.select(F.col(doc_id).alias("doc_id")).distinct()
    none = F.expr("CAST(array() AS ARRAY<STRUCT<term: STRING, weight: DOUBLE>>)")
    return ids.join(per, "doc_id", "left").select("doc_id", F.coalesce("terms", none).alias("terms"))


def vector_batches(vocab: Vocabulary, stream: DataFrame, doc_id: str, text: str, name: str, base: str | None = None) -> str:
    """``vectors`` of a stream of messages: every micro-batch joins the stored vocabulary and is written
    under its batch id with overwrite, so a retried batch rewrites its own files. A run of the same name goes
    on where the last one stopped. Returns the output folder (partitioned by batch)."""
    root = base or stream_folder(stream.sparkSession, name)

    def run(batch: DataFrame, b: int) -> None:
        vectors(vocab, batch, doc_id, text).write.mode("overwrite").parquet(f"{root}/out/batch={b:012d}")

    q = (stream.writeStream.foreachBatch(run).option("checkpointLocation", f"{root}/checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return f"{root}/out"
