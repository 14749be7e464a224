"""Message models work on tasks of a fixed number of messages, whatever the bytes of the files."""
from pyspark.sql import functions as F

from tidemark.plans import q_models


def test_texts_are_dealt_out_before_they_are_counted(spark, monkeypatch, tmp_path):
    docs = spark.createDataFrame([(i, f"word{i % 7} and word{i % 3}", "en", "s", 10) for i in range(300)],
                                 "doc_id long, text string, lang string, source string, n_chars int")
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    docs.select("doc_id", (F.col("doc_id") % 7 > 3).cast("int").alias("quality"), (F.col("doc_id") % 3 > 1).cast("int").alias("toxic")) \
        .coalesce(1).write.parquet(str(tmp_path / "labels.parquet"))
    monkeypatch.setattr(q_models, "MESSAGE_ROWS", 25)
    seen = []
    fit = q_models.CountVectorizer._fit
    monkeypatch.setattr(q_models.CountVectorizer, "_fit", lambda self, df: seen.append(df.rdd.getNumPartitions()) or fit(self, df))
    got = {(r["category"], str(r["class"])): r["support"] for r in q_models.q_message_classifier(spark, str(tmp_path)).collect()}
    assert seen == [12]
    assert sum(n for (c, _), n in got.items() if c == "toxic") == sum(n for (c, _), n in got.items() if c == "quality") > 0
