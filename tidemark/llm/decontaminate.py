"""Benchmark decontamination: size-partitioned MinHash containment search, native.

Short test items are looked for inside long documents. Items are partitioned by
the size of their shingle set (classes of doubling size). A class keeps, for each
of its items, a bottom-k MinHash sketch: the k smallest shingle hashes, k being
one more than the shingles that an item of the class's largest size may miss. A
document that holds the asked share of an item must hold at least one of any k of
its shingles, so probing sketches finds every such pair, whatever the length of
the document. Candidates are then verified by the exact containment of the
item's shingles, compared as text.

Documents are never shuffled as texts: both passes explode shingles in the scan
stage and meet the (size-checked) item tables there; what is aggregated are the
few matches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, if_small, small, written

SHINGLE = 5
SHARE = (4, 5)  # at least 4/5 of an item's shingles


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def shingles(text: Column, make: Callable[[Column], Column]) -> Column:
    """``make`` of each distinct word shingle of a text. Fewer words than a shingle: of the
    whole sequence; no words: none.

    The word array is bound by a one-element array, so it is made once per text.
    """
    some = F.filter(F.array(words(text)), lambda w: F.size(w) > 0)
    return F.array_distinct(F.flatten(F.transform(some, lambda w: F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(w) - (SHINGLE - 1), F.lit(1))),
        lambda i: make(F.concat_ws(" ", F.slice(w, i, SHINGLE)))))))


def _rows(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return rows.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))


def _hashes(rows: DataFrame) -> DataFrame:
    """(id, n, h): distinct shingle hashes and their number."""
    return rows.select("id", shingles(F.col("text"), F.xxhash64).alias("hs")).select(
        "id", F.size("hs").alias("n"), F.explode("hs").alias("h"))


def _texts(rows: DataFrame) -> DataFrame:
    """(id, s): distinct shingles as text."""
    return rows.select("id", F.explode(shingles(F.col("text"), lambda s: s)).alias("s"))


def sketches(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, need, h): each item's sketch and the fewest shingles a holder of it has."""
    a, b = SHARE
    each = (_hashes(_rows(items, id_col, text_col)).groupBy("id")
            .agg(F.array_sort(F.collect_set("h")).alias("hs")))  # one item's shingles
    n = F.size("hs")
    # an item's class: sizes from a power of two to just below the next one
    largest = F.expr("shiftleft(1, cast(floor(log2(size(hs))) as int) + 1) - 1")
    k = largest - F.ceil(largest * a / b) + 1
    return (each.select(F.col("id").alias("item_id"), F.ceil(n * a / b).alias("need"),
                                     F.explode(F.slice("hs", F.lit(1), F.least(k, n).cast("int"))).alias("h")))


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Pairs with at least ``SHARE`` of the item's word shingles in the document:
    the id columns, ``n_shared``, ``n_item``, ``containment``.

    Words are runs of letters and digits, lower-cased. An item or document of
    fewer than five words is one shingle, its whole sequence; without words
    (null or empty text) it takes part in no pair. Rows that repeat an id count
    as one document (or item), their shingles united; rows with a null id cannot
    be named and are left out. Either table may be empty; further columns are
    not read.
    """
    d, i = _rows(docs, id_col, text_col), _rows(items, item_col, item_text_col)
    sketch = written(sketches(items, item_col, item_text_col), "sketches")
    probe = _hashes(d)
    candidates = written(probe.join(if_small(sketch, 64), "h").where(F.col("n") >= F.col("need"))
                         .select("id", "item_id").distinct(), "candidates")
    known = written(_texts(i).distinct().withColumnRenamed("id", "item_id"), "items")
    sizes = known.groupBy("item_id").agg(F.count("*").alias("n_item"))
    held = candidates.select(F.col("id").alias("held")).distinct()
    if small(candidates, 64):  # else the rows are kept out by the last join alone
        d = d.join(F.broadcast(held), F.col("id") == F.col("held"), "left_semi")
    shared = (_texts(d).join(if_small(known, 256), "s")
              .groupBy("id", "item_id").agg(F.countDistinct("s").alias("n_shared")))
    a, b = SHARE
    return (shared.join(candidates, ["id", "item_id"], "left_semi").join(if_small(sizes, 64), "item_id")
            .where(F.col("n_shared") * b >= F.col("n_item") * a)
            .select(F.col("id").alias(id_col), F.col("item_id").alias(item_col), "n_shared", "n_item",
                    (F.col("n_shared") / F.col("n_item")).alias("containment")))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that hold a test item (rows with a null id stay)."""
    name = fresh(docs, "id_")[0]
    found = written(contaminated(docs, items, id_col, text_col).select(F.col(id_col).alias(name)).distinct(), "leaks")
    return docs.join(if_small(found, 64), F.col(id_col) == F.col(name), "left_anti")
