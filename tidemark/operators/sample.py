"""Reproducible sampling and splitting by hash.

Spark's ``sample``/``randomSplit``/``sampleBy`` depend on the partitioning of
their input; a hash of (row key, seed) does not, so a split or a sample is
the same on any cluster. The unit hash is the first 32 bits of
``md5(key || seed)``, which DuckDB computes identically (oracle-checkable).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TWO32 = 4294967296.0


def hash32(key: str | Column, seed: int | str = 0) -> Column:
    """First 32 bits of md5(key || seed) as a non-negative long."""
    k = F.col(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(F.concat(k.cast("string"), F.lit(str(seed)))), 1, 8), 16, 10).cast("long")


def hash_unit(key: str | Column, seed: int | str = 0) -> Column:
    """Uniform in [0, 1) per key."""
    return hash32(key, seed) / TWO32


def first_n_by_hash(df: DataFrame, n: int, key: str, seed: int | str = 0,
                    levels: tuple[int, ...] = (16, 16)) -> DataFrame:
    """Exactly ``n`` rows - the first ``n`` in (hash, key) order.

    No global sort and no large limit: the 32-bit hash is cut into radix
    digits; per digit a tiny histogram (at most 2^bits rows) finds the digit
    value where the running count crosses ``n``; rows below it are taken
    whole, the boundary digit is refined at the next level, and only the
    final boundary (equal full hashes) is ordered by key with a small limit.
    """
    x = df.withColumn("__h", hash32(key, seed))
    taken: list[DataFrame] = []
    need, shift, prefix = n, 32, None
    for bits in levels:
        shift -= bits
        digit = F.shiftright("__h", shift).bitwiseAND((1 << bits) - 1)
        cand = x if prefix is None else x.filter(prefix)
        hist = sorted((r[0], r[1]) for r in cand.groupBy(digit.alias("d")).count().collect())
        cum, cut = 0, None
        for d, c in hist:
            if cum + c >= need:
                cut = d
                break
            cum += c
        if cut is None:  # fewer rows than asked: take everything
            taken.append(cand)
            need = 0
            break
        taken.append(cand.filter(digit < cut))
        need -= cum
        prefix = (digit == cut) if prefix is None else (prefix & (digit == cut))
        if need == 0:
            break
    if need > 0:
        taken.append(x.filter(prefix).orderBy("__h", key).limit(need))
    out = taken[0]
    for t in taken[1:]:
        out = out.unionByName(t)
    return out.drop("__h")


def stratified_sample(df: DataFrame, label: str, fractions: Mapping, key: str, seed: int | str = 0) -> DataFrame:
    """Keep each row with the probability of its label (hash-decided);
    labels not listed are dropped, as ``sampleBy`` does."""
    cond = None
    for lv, f in fractions.items():
        c = (F.col(label) == F.lit(lv)) & (hash_unit(key, seed) < F.lit(float(f)))
        cond = c if cond is None else cond | c
    return df.filter(cond)


def hash_split(df: DataFrame, key: str, test_share: float = 0.2, seed: int | str = 0,
               out: str = "split") -> DataFrame:
    """Stable train/test assignment by hash."""
    return df.withColumn(out, F.when(hash_unit(key, seed) < F.lit(1.0 - test_share), "train").otherwise("test"))
