"""Document pipeline: toxicity, near-duplicates, benchmark leaks, personal data, tokens.

Each stage takes (spark, docs, sf_dir), where ``docs`` is what its predecessor
wrote, applies one operator of ``tidemark.llm`` to all of it and returns the rows
it keeps. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import byte_bpe, decontaminate, pii, simhash, toxicity
from tidemark.llm.common import fresh, only, table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject. It is fitted on the labelled
    ones of ``docs`` outside the held-out remainder; without any, nothing is rejected."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    score, predicted = fresh(docs, "score", "predicted")
    scored = toxicity.score(docs, model, score_col=score, predicted_col=predicted)
    return only(scored.where(f"{predicted} = 0"), docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each SimHash group."""
    return simhash.keep_one(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts masked and ``n_chars`` counted anew."""
    return pii.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with ``token_ids``, their number and digests."""
    return byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("decontaminate", drop_leaks),
    ("pii", mask_personal_data),
    ("byte_bpe", encode),
]

#: The fitted model and the fingerprints are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written to the shared folder and reread for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
