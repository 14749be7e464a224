"""Vector code compression: product codes found by equal-average search.

Vectors are cut into equal parts; a part is coded by the number of its nearest
codebook entry. Entries are sorted by the sum of their components. For a part x
and an entry y of d components, (sum x - sum y)^2 / d never exceeds the squared
distance, so a search expands outward from the place of x's sum among the sorted
sums and stops on a side as soon as that side's squared sum gap over d strictly
exceeds the best distance. Nothing that could win, or tie with a lower index, is
left out: the result is exact.

All parts of a batch walk outward together in numpy. Codebooks are learned by
rounds like the cluster centres of ``centroids``: a scan, partial sums for each
entry in each task, and a result as large as the codebooks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import if_small, prepare, written
from tidemark.llm.vectors import matrix, scaled, vector_sums, whole

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
_BLOCK = 1 << 15


class Codebooks:
    """Entries by part (parts x entries x width), and the search for the nearest one."""

    def __init__(self, entries: np.ndarray):
        self.entries = np.asarray(entries, np.int64)
        self.parts, self.size, self.width = self.entries.shape
        sums = self.entries.sum(2)
        self.order = np.argsort(sums, axis=1, kind="stable")
        self.sums = np.take_along_axis(sums, self.order, 1)
        self.sorted = np.take_along_axis(self.entries, self.order[:, :, None], 1)

    def nearest(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry and squared distance to it, by row and part."""
        index, far = np.zeros((len(v), self.parts), np.int64), np.zeros((len(v), self.parts), np.int64)
        cut = v.reshape(len(v), self.parts, self.width)
        for p in range(self.parts):
            for a in range(0, len(v), _BLOCK):
                index[a:a + _BLOCK, p], far[a:a + _BLOCK, p] = self._part(p, np.ascontiguousarray(cut[a:a + _BLOCK, p]))
        return index, far

    def _part(self, p: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sums, entries, order = self.sums[p], self.sorted[p], self.order[p]
        own = x.sum(1)
        start = np.searchsorted(sums, own)
        best = np.full(len(x), np.iinfo(np.int64).max)
        at = np.full(len(x), self.size)
        for step in (1, -1):  # first up from the part's sum, then down
            live = np.arange(len(x))
            place = start if step > 0 else start - 1
            while True:
                inside = (place >= 0) & (place < self.size)
                live, place = live[inside], place[inside]
                gap = sums[place] - own[live]
                # width * best could pass 2^63 only before a first entry is known
                on = (best[live] == np.iinfo(np.int64).max) | (gap * gap <= best[live] * self.width)
                live, place = live[on], place[on]
                if not len(live):
                    break
                d = x[live] - entries[place]
                d = (d * d).sum(1)
                number = order[place]
                win = (d < best[live]) | ((d == best[live]) & (number < at[live]))
                best[live[win]], at[live[win]] = d[win], number[win]
                place = place + step
        return at, best


def first_codebooks(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> np.ndarray:
    """The parts of the vectors with the smallest ids, ascending (ties by components); null ids start none."""
    rows = kept.where(F.col("id").isNotNull()).orderBy("id", "v").limit(entries).select("v").collect()
    v = np.array([r["v"] for r in rows], np.int64)
    return v.reshape(len(v), parts, -1).transpose(1, 0, 2)


def _sums(kept: DataFrame, books: np.ndarray) -> DataFrame:
    """Count and componentwise sum of the parts of each used entry (``slot``: part * entries + index)."""
    parts, size, width = books.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, n, s = Codebooks(books), np.zeros(parts * size, np.int64), np.zeros((parts * size, width), np.int64)
        for b in batches:
            v = matrix(b.column(0))
            if not len(v):
                continue
            slot = (codes.nearest(v)[0] + np.arange(parts) * size).ravel()
            n += np.bincount(slot, minlength=parts * size)
            np.add.at(s, slot, v.reshape(-1, width))
        used = np.flatnonzero(n)
        yield pa.record_batch([pa.array(used, pa.int32()), pa.array(n[used]), pa.array(s[used].tolist(), pa.list_(pa.int64()))],
                              names=["slot", "n", "s"])

    return vector_sums(kept.select("v").mapInArrow(work, "slot int, n long, s array<long>"), ["slot"], width)


def fit(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (parts x entries x width) after ``rounds`` rounds over ``kept`` (id, v): each used entry
    becomes the floor of the exact mean of its parts, unused ones stay."""
    prepare(kept.sparkSession)
    books = first_codebooks(kept, parts, entries)
    for _ in range(rounds if books.size else 0):
        sums = _sums(kept, books).collect()  # parts * entries rows
        books = books.copy()
        for r in sums:
            books[r["slot"] // books.shape[1], r["slot"] % books.shape[1]] = np.array(r["s"], np.int64) // r["n"]
    return books


def encode(kept: DataFrame, books: np.ndarray, carry: list[str] = ()) -> DataFrame:
    """``id``, the ``carry`` columns, ``code`` (two hex digits a part) and ``error`` (long) of every vector of ``kept``."""
    prepare(kept.sparkSession)
    rows = kept.select("v", "id", *carry)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = Codebooks(books)
        for b in batches:
            v = matrix(b.column(0))
            index, far = codes.nearest(v) if len(v) else (np.zeros((0, 1), np.int64), np.zeros((0, 1), np.int64))
            text = [row.tobytes().hex() for row in index.astype(np.uint8)]
            yield pa.record_batch([*b.columns[1:], pa.array(text, pa.string()), pa.array(far.sum(1), pa.int64())],
                                  names=[*b.schema.names[1:], "code", "error"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:]]
    return rows.mapInArrow(work, ", ".join([*fields, "code string", "error long"]))


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
             id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """Codes of all kept vectors, and the codebooks.

    One row per vector that is not null and holds no null or non-finite
    component: the id column, ``code``, ``error`` (squared distances summed over
    the parts), ``label_error`` (error summed over the vectors of equal label,
    null labels together). ``entries`` is at most 256, so a part has two hex
    digits. Codebooks fit one length: that of the kept vector with the smallest
    id; it must be a multiple of ``parts``, and vectors of another length get
    null ``code`` and ``error`` and add nothing to a sum. A repeated row is
    coded and counted each time; a vector with a null id is coded, but starts
    no entry. Ties go to the lower index. No kept vector with an id: no codes,
    empty codebooks, an empty result. Only the three named columns are read.
    """
    if not 0 < entries <= 256:
        raise ValueError("entries must be 1 to 256")
    v = F.col(vec_col)
    kept = written(vectors.where(whole(v)).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"),
                                                  scaled(v, scale).alias("v")), "integers")
    first = kept.where(F.col("id").isNotNull()).orderBy("id", "v").select(F.size("v").alias("n")).head()
    if first is None:
        none = kept.sparkSession.createDataFrame([], f"`{id_col}` long, code string, error long, label_error long")
        return none, np.zeros((parts, 0, 0), np.int64)
    if not first["n"] or first["n"] % parts:
        raise ValueError(f"{first['n']} components cannot be cut into {parts} equal parts")
    fitting = kept.where(F.size("v") == first["n"])
    books = fit(fitting, parts, entries, rounds)
    other = kept.where(F.size("v") != first["n"]).select("id", "label", F.lit(None).cast("string").alias("code"),
                                                         F.lit(None).cast("long").alias("error"))
    coded = written(encode(fitting, books, ["label"]).unionByName(other), "codes")
    sums = written(coded.groupBy(F.col("label").alias("label_")).agg(F.sum("error").alias("label_error")), "label-errors")
    rows = coded.join(if_small(sums, 128), F.col("label").eqNullSafe(F.col("label_")))
    return rows.select(F.col("id").alias(id_col), "code", "error", "label_error"), books


def codebooks_digest(books: np.ndarray) -> str:
    """Lowercase hex sha256 of all components in decimal, by part, entry and position, joined by commas."""
    return hashlib.sha256(",".join(map(str, np.asarray(books).ravel().tolist())).encode()).hexdigest()
