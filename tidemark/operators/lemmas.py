"""Tokens with lemmas from a table of any size.

The word -> lemma table is joined, never held in the plan: a small one reaches the
tokens in the scan stage, a large one by a shuffle on the word. Positions put the tokens
in order again. A lemma is looked up as the token is written; lower-casing comes afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import TOKEN_PATTERN, raw_tokens
from tidemark.operators.text import text_tasks


def lemma_tokens(docs: DataFrame, doc_id: str, text: str, lemmas: DataFrame, word: str = "word", lemma: str = "lemma",
                 pattern: str = TOKEN_PATTERN, out: str = "tokens") -> DataFrame:
    """``doc_id`` and ``out``: a text's tokens in order, each as lemma (else as written), lower-cased and trimmed.

    A word with several lemmas gets the smallest; null words and lemmas are left out.
    An empty text has no tokens, a null text null. Repeated rows come back each time,
    a null id is an id like others. Only the two named columns are read. The last step
    holds what the text itself (with its copies of the same id) holds; no task holds all rows of a
    word: they are on the join's streamed side, which adaptive execution splits. Texts are dealt out whole,
    by id and text, before they are cut into tokens: with a small table no token is shuffled."""
    d = docs.select(F.col(doc_id).alias("_id"), F.unhex(F.md5(F.col(text).cast("string"))).alias("_h"), F.col(text).cast("string").alias("_text"))
    d = d.repartition(text_tasks(docs, text), "_id", "_h")
    made = d.select("_id", "_h", F.posexplode_outer(raw_tokens("_text", pattern)).alias("_pos", "_raw"))
    known = (lemmas.where(F.col(word).isNotNull() & F.col(lemma).isNotNull())
             .groupBy(F.col(word).alias("_raw")).agg(F.min(lemma).alias("_lemma")))
    # a position of eight hex digits in front of the token: shorter than a struct, and in order as text
    placed = made.join(known, "_raw", "left").select(
        "_id", "_h", (F.col("_pos") == 0).alias("_first"),
        F.concat(F.lpad(F.hex("_pos"), 8, "0"), F.lower(F.trim(F.coalesce("_lemma", "_raw")))).alias("_at"))
    # equal rows (id and text) share a key: each position then comes once for each of them
    whole = placed.groupBy("_id", "_h").agg(
        F.sort_array(F.collect_list("_at")).alias("_t"), F.count(F.lit(1)).alias("_rows"), F.count_if("_first").alias("_starts"))
    copies = F.when(F.col("_starts") > 0, F.col("_starts")).otherwise(F.col("_rows")).cast("int")
    whole = whole.select("_id", "_h", "_t", copies.alias("_copies"))
    once = F.expr("transform(if(_copies = 1 or size(_t) = 0, _t, transform(sequence(0, size(_t) - 1, _copies), i -> _t[i])), x -> substr(x, 9))")
    return (whole.select("_id", F.when(F.col("_h").isNotNull(), once).alias(out), F.explode(F.sequence(F.lit(1), "_copies")).alias("_c"))
            .select(F.col("_id").alias(doc_id), out))
