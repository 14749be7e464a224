"""SimHash near-duplicates by multi-index hashing.

A 64-bit fingerprint is cut into two 32-bit segments. Two fingerprints that
differ in at most two bits agree within one bit on the left segment or are
equal on the right one, so each fingerprint enumerates a Hamming ball of radius
one in its left segment and of radius zero in its right one, looks the probes
up in the segment tables, and every table match is verified by the complete
distance. A left pair at distance one is probed only from the side whose bit is
set. Inside a segment's match the other segment must lie within the remaining
distance, so some piece of it agrees exactly; that piece is part of the table
key and keeps buckets of fingerprints that share half of their bits small
without dropping any pair.

Equal fingerprints are one node however many documents carry them, so groups of
copies never expand into pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, fresh, if_small, prepare, written

SHINGLE = 3
MAX_BITS = 2
SEED = 42
_ROWS = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit SimHash of the word shingles of a whole text, repeats included.

    Words are runs of non-white ASCII-wise characters after lower-casing A-Z; a
    text with fewer words than a shingle has its whole sequence as its only
    shingle; a null text or one without words gives zero.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    joined, last = b" ".join(words), min(shingle, len(words)) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[:len(words) - last].tolist(), ends[last:].tolist())),
                         np.uint64, len(words) - last)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _ROWS):
        part = hashes[i:i + _ROWS]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def _fingerprints(batches: Iterator[pd.DataFrame], shingle: int) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield pd.DataFrame({"id": b["id"], "h": b["h"], "fp": [fingerprint(t, shingle) for t in b["text"]]})


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``id`` (long), ``h`` (hash of the text), ``fp`` (long) for every row of ``docs``."""
    prepare(docs.sparkSession)
    text = F.col(text_col).cast("string")
    return (docs.select(F.col(id_col).cast("long").alias("id"), _hash(text_col).alias("h"), text.alias("text"))
            .mapInPandas(lambda it: _fingerprints(it, shingle), "id long, h long, fp long"))


def _hash(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def _left(fp: Column) -> Column:
    return F.shiftrightunsigned(fp, 32)


def _right(fp: Column) -> Column:
    return fp.bitwiseAND(F.lit(0xFFFFFFFF))


def _piece(half: Column, at: int, width: int) -> Column:
    return F.shiftright(half, at).bitwiseAND(F.lit((1 << width) - 1))


def _key(kind: int, half: Column, piece: Column) -> Column:
    """Table number (3 bits), whole segment (32) and a piece of the other (16) in one long."""
    return F.shiftleft(F.lit(kind).cast("long"), 48).bitwiseOR(F.shiftleft(half, 16)).bitwiseOR(piece)


_THIRDS, _HALVES = ((0, 11), (11, 11), (22, 10)), ((0, 16), (16, 16))


def links(nodes: DataFrame) -> DataFrame:
    """Pairs of ``nodes`` (fp, rep: distinct fingerprints) at one or two differing
    bits, as ``u``, ``v`` (rep values), possibly more than once."""
    fp = F.col("fp")
    left, right = _left(fp), _right(fp)
    exact = [_key(i, left, _piece(right, *p)) for i, p in enumerate(_THIRDS)]
    exact += [_key(3 + i, right, _piece(left, *p)) for i, p in enumerate(_THIRDS)]
    stored = [_key(6 + i, left, _piece(right, *p)) for i, p in enumerate(_HALVES)]
    lookup = nodes.select(F.explode(F.array(*exact, *stored)).alias("key"), fp.alias("fp2"), F.col("rep").alias("rep2"))
    same = nodes.select("fp", "rep", F.explode(F.array(*exact)).alias("key"))
    ball = (nodes.select("fp", "rep", F.explode(F.sequence(F.lit(0), F.lit(31))).alias("bit"))
            .select("fp", "rep", F.expr("shiftleft(1L, bit)").alias("mask"))
            .where(_left(fp).bitwiseAND(F.col("mask")) != 0)
            .select("fp", "rep", _left(fp).bitwiseXOR(F.col("mask")).alias("l"), _right(fp).alias("r"))
            .select("fp", "rep", F.explode(F.array(*[_key(6 + i, F.col("l"), _piece(F.col("r"), *p))
                                                     for i, p in enumerate(_HALVES)])).alias("key")))
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("fp2")))
    return (same.unionByName(ball).join(lookup, "key").where((F.col("fp") != F.col("fp2")) & (distance <= MAX_BITS))
            .select(F.col("rep").alias("u"), F.col("rep2").alias("v")))


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``id``, ``h``, ``fp``, ``root`` (the group's smallest linked fingerprint), ``component_id`` (the group's smallest id)
    for every row of ``docs``. Fingerprints are the nodes, so rows without an id link like any other."""
    fps = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = written(fps.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    roots = written(components(links(nodes.select("fp", F.col("fp").alias("rep")))), "roots")
    known = written(nodes.join(if_small(roots, 64), F.col("fp") == F.col("node"), "left")
                    .select(F.col("fp").alias("fp_"), F.coalesce("root", "fp").alias("root"), "least"), "groups")
    least = written(known.groupBy(F.col("root").alias("root_")).agg(F.min("least").alias("component_id")), "least")
    known = written(known.join(if_small(least, 64), F.col("root") == F.col("root_")).select("fp_", "root", "component_id"), "components")
    return fps.join(if_small(known, 72), F.col("fp") == F.col("fp_"), "left").select("id", "h", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row per row of ``docs``: the id column, ``fingerprint`` (16 hex digits),
    ``component_id`` (smallest id reachable over links of at most two differing bits).

    A null text counts as empty; texts without words share fingerprint zero and
    are linked like any other. A row with a null id links others like any row, but
    never names a group: it gets the smallest id of its group (null if the
    group has none). Repeated rows give repeated results. An empty table gives
    an empty one. Only the two named columns are read, so further columns may have
    any name.
    """
    return grouped(docs, id_col, text_col, shingle).select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: that of the smallest id, rows without an id coming last
    and rows of one id by a hash of the text. Rows are told apart by id and text: an id that is repeated
    with other texts keeps those that are nobody's copy, and of equal rows one stays."""
    found = written(grouped(docs, id_col, text_col, shingle).select("id", "h", "root"), "found")
    first = F.struct(F.col("id").isNull().alias("last"), "id", "h")
    best = written(found.groupBy(F.col("root").alias("root_")).agg(F.min(first).alias("best")), "best")
    i, h, key = fresh(docs, "id_", "h_", "key_")
    out = (found.join(if_small(best, 96), F.col("root") == F.col("root_")).where(first != F.col("best"))
           .select(F.col("id").alias(i), F.col("h").alias(h)).distinct())
    keyed = docs.withColumn(key, _hash(text_col))
    same = F.col(id_col).cast("long").eqNullSafe(F.col(i)) & (F.col(key) == F.col(h))
    kept = keyed.join(if_small(written(out, "out"), 64), same, "left_anti")
    again = written(found.groupBy(F.col("id").alias(i), F.col("h").alias(h)).agg(F.count("*").alias("n")).where("n > 1").drop("n"), "again")
    if not again.head(1):
        return kept.drop(key)
    again = if_small(again, 64)
    return kept.join(again, same, "left_anti").unionByName(
        kept.join(again, same, "left_semi").dropDuplicates([id_col, key])).drop(key)
