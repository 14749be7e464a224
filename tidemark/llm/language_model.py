"""Language-model scoring with a hierarchical Pitman-Yor model.

Three levels: a uniform base over the training vocabulary and one unknown word; one
restaurant over words (the parent); and a restaurant for every context, all of which
share this parent. A context is the word before (the end of text before a first
word), and every training word is one. Customers of a context are its training
tokens; each of its tables is a customer of the parent. A word without training tokens
is a context without customers: the parent alone speaks for it.

Seating is sampled by Gibbs steps: a customer leaves a table and sits down again,
at an occupied table or a new one, with the probabilities of the Chinese-restaurant
process. All dishes are seated side by side: within a sweep a dish sees the other
dishes' tables as they were at its start (the totals of a context are summed up
between sweeps). A sweep moves every customer of every dish once.
Discounts and strengths of both levels are sampled on a grid after each sweep.
After ``BURN_IN`` sweeps each further one is a sample, and predictive probabilities
are averaged over the samples.

Texts are read once and written as blocks of about ``BLOCK`` tokens (a dictionary of
the block's words and token numbers into it). The pairs of context and word are dealt to
buckets of about ``BUCKET`` training tokens, a row each. A context's pairs are in one bucket,
which so knows its totals; the pairs of a context that makes up at least ``CONTEXT_SHARE``
of all training tokens are dealt out by word as well, and its totals pass the driver (there are
at most 1 / ``CONTEXT_SHARE`` of them). Where a pair is held changes no result. Words are
dealt to buckets too. In a sweep the buckets of pairs send each word's tables to its bucket, and
get back the word's customers and tables in the parent. A pair with one training token
always has one table: it is counted, not stored. Words are keyed by 64-bit hashes; the vocabulary
keeps the words themselves, and another seed is taken if two words share a key.
"""

from __future__ import annotations

import uuid
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import crc_mod, prepare, written
from tidemark.session import checkpoint_dir

CONTEXT_SHARE = 1e-4
BLOCK = 1 << 22
#: Training tokens whose pairs are held in one bucket, about.
BUCKET = 1 << 20
BURN_IN, SAMPLES = 2, 3
DISCOUNTS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95)
STRENGTHS = (0.1, 1.0, 10.0, 100.0, 1e3, 1e4, 1e5)
#: The end of a text as a word of the vocabulary (no word is empty).
END = b""


# --- tables of large rows ----------------------------------------------------------------------

#: A row of a block or a bucket has tens of megabytes, and a task writes or reads as many as it is dealt. A writer looks at its
#: size after each (Spark's default: after a hundred) and ends a row group at 16 MB; a reader holds one row group at a time.
_LARGE_ROWS = {"parquet.block.size": 1 << 24, "parquet.block.size.row.check.min": 1, "parquet.block.size.row.check.max": 1,
               "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1}


def _kept(df: DataFrame, path: str) -> DataFrame:
    """``df``, a table of large rows, written to ``path`` and read back."""
    df.write.mode("overwrite").options(**_LARGE_ROWS).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _path(df: DataFrame, name: str) -> str:
    return f"{checkpoint_dir(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"


# --- texts to blocks ---------------------------------------------------------------------------

_BLOCKS = ("blk long, doc array<long>, held array<boolean>, learn array<boolean>, size array<long>, tok array<int>, "
           "word array<binary>, key array<long>, n array<long>")


def words(text: bytes | None) -> list[bytes]:
    """Words of a text: A-Z lower-cased, cut at ASCII white space."""
    return (text or b"").lower().split()


def blocks(docs: DataFrame, held: Column, id_col: str = "doc_id", text_col: str = "text", seed: int = 0,
           tokens: int = BLOCK) -> DataFrame:
    """Blocks of whole texts: documents, their sizes, token numbers, and the block's words with keys and training counts."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), held.alias("held"), F.col(text_col).cast("string").cast("binary").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, made, total = TaskContext.get().partitionId(), 0, 0
        docs_, held_, size, tok, known = [], [], [], [], {END: 0}

        def block() -> pa.RecordBatch:
            t, w = np.concatenate(tok), list(known)
            learn = [h is False for h in held_]
            n = np.bincount(t[np.repeat(learn, size)], minlength=len(w))
            keys = np.fromiter((xxhash.xxh64_intdigest(x, seed) for x in w), np.uint64, len(w)).view(np.int64)
            cells = [(part << 32) + made, docs_, held_, learn, size, t.astype(np.int32), w, keys, n.astype(np.int64)]
            types = [pa.int64(), *map(pa.list_, (pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64()))]
            return pa.record_batch([pa.array([c], t) for c, t in zip(cells, types)], names=[f.split()[0] for f in _BLOCKS.split(", ")])

        for b in batches:
            for i, h, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                w = words(text.as_py())
                tok.append(np.fromiter((known.setdefault(x, len(known)) for x in w), np.int64, len(w)))
                tok.append(np.zeros(1, np.int64))
                docs_.append(i)
                held_.append(h)
                size.append(len(w) + 1)
                total += size[-1]
                if total >= tokens:
                    yield block()
                    made, total = made + 1, 0
                    docs_, held_, size, tok, known = [], [], [], [], {END: 0}
        if docs_:
            yield block()

    return rows.mapInArrow(work, _BLOCKS)

# --- seating -----------------------------------------------------------------------------------

@dataclass
class Levels:
    """All that dishes share within a sweep. Index 0: contexts, 1: the parent."""
    customers: np.ndarray  # of the common contexts (from number 1 on)
    tables: np.ndarray
    parent: tuple[int, int]  # customers and tables of the parent
    base: float  # probability of a word under the uniform base
    discount: tuple[float, float] = (0.8, 0.8)
    strength: tuple[float, float] = (10.0, 10.0)

    def backoff(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """Weight of the parent in contexts with so many customers and tables."""
        d, s = self.discount[0], self.strength[0]
        return (s + d * tables) / (s + customers)

    def own(self, n, t, customers):
        """A pair's own part, of ``n`` customers at ``t`` tables, in a context with so many customers."""
        return (n - self.discount[0] * t) / (self.strength[0] + customers)

    def word(self, customers, tables):
        """Predictive probability of words in the parent, by their customers and tables there."""
        d, s = self.discount[1], self.strength[1]
        c, t = self.parent
        return (customers - d * tables) / (s + c) + (s + d * t) / (s + c) * self.base


def _uniform(key: np.ndarray, *salt: int) -> np.ndarray:
    """Numbers in [0, 1) from keys and salts: the same wherever and whenever a row is worked on."""
    with np.errstate(over="ignore"):
        x = key.astype(np.uint64)
        for s in salt:
            x = x + np.uint64((s + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            x = x ^ (x >> np.uint64(31))
    return (x >> np.uint64(11)).astype(float) / (1 << 53)


def _log_rise(n: np.ndarray, d: float) -> np.ndarray:
    """log of (1 - d)(2 - d)...(n - 1 - d), the weight of a table of n customers."""
    return _log_gamma(n - d) - _log_gamma(np.array([1.0 - d]))[0]


def _log_gamma(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, float)
    shift = np.log(x) + np.log(x + 1) + np.log(x + 2) + np.log(x + 3) + np.log(x + 4) + np.log(x + 5)
    y = x + 6
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + 1 / (12 * y) - 1 / (360 * y ** 3) + 1 / (1260 * y ** 5) - shift


class Tables:
    """Table sizes of many dishes, one run of ``sizes`` for each (``count`` of them)."""

    def __init__(self, count: np.ndarray, sizes: np.ndarray):
        self.count, self.sizes = count, sizes

    def reseat(self, customers: np.ndarray, discount: float, new, key: np.ndarray, salt: int) -> Tables:
        """The tables after each dish has been brought to ``customers`` and then every one of them made a Gibbs step.

        ``new(rows, tables)``: weight of a new table for dishes with so many tables now.
        """
        customers = np.asarray(customers, np.int64)
        now = np.bincount(np.repeat(np.arange(len(self.count)), self.count), self.sizes, len(self.count)).astype(np.int64)
        start = np.concatenate(([0], np.cumsum(self.count)))
        room = np.maximum(customers, now)
        width = 1 << np.ceil(np.log2(np.maximum(room, 2))).astype(np.int64)
        parts_rows, parts_flat, parts_count = [], [], []
        for wide in np.unique(width):
            of_width = np.flatnonzero(width == wide)
            for a in range(0, len(of_width), max(1, (1 << 20) // int(wide))):
                rows = of_width[a:a + max(1, (1 << 20) // int(wide))]
                rows = rows[np.argsort(-customers[rows], kind="stable")]
                n = self.count[rows]
                r = np.repeat(np.arange(len(rows)), n)
                c = np.arange(len(r)) - np.repeat(np.cumsum(n) - n, n)
                z = np.zeros((len(rows), int(room[rows].max()) + 1), np.int32)
                z[r, c] = self.sizes[start[rows][r] + c]
                _Seats(z, n, now[rows], discount, new, rows, key[rows], salt).sweep(customers[rows])
                seated = z > 0
                parts_rows.append(rows)
                parts_count.append(seated.sum(1))
                parts_flat.append(z[seated].astype(np.int64))
        if not parts_rows:
            return self
        rows, count, flat = map(np.concatenate, (parts_rows, parts_count, parts_flat))
        back = np.argsort(rows, kind="stable")
        begin = np.concatenate(([0], np.cumsum(count)))[:-1]
        n = count[back]
        take = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin[back], n)
        return Tables(n, flat[take])


#: Fewer dishes than these are seated one by one: a step of numpy costs as much as so many of plain numbers.
ALONG = 24


class _Seats:
    """Customers of dishes by seat: ``seat`` is a customer's table, ``z`` the tables' sizes, ``free`` a stack of empty ones.

    A customer sits down at a table as large as ``z`` with weight ``z - discount``: another customer is drawn, whose table it
    is with probability ``1 - discount / z``, else it draws again. A step so costs the same whatever the tables are.
    """

    def __init__(self, z: np.ndarray, tables: np.ndarray, here: np.ndarray, discount: float, new, rows: np.ndarray, key: np.ndarray, salt: int):
        self.z, self.t, self.here, self.d, self.new, self.rows = z, tables.astype(np.int64), here.copy(), discount, new, rows
        self.state = (_uniform(key, salt) * (1 << 53)).astype(np.uint64) << np.uint64(11)
        m, cap = z.shape
        self.seat = np.zeros((m, cap), np.int32)
        who = np.repeat(np.arange(m), here)
        at = np.arange(len(who)) - np.repeat(np.cumsum(here) - here, here)
        # a dish's customers are in an order of chance, whatever table they are at
        order = np.lexsort((_mixed(~self.state[who] + (at.astype(np.uint64) * np.uint64(_GOLD))), who))
        self.seat[who, at] = _tables_of(z)[order]
        # the stack of a dish: its empty tables, the lowest on top
        self.free = np.where(np.arange(cap)[None, :] < (cap - self.t)[:, None], cap - 1 - np.arange(cap, dtype=np.int32)[None, :], 0).astype(np.int32)
        self.left = cap - self.t

    def sweep(self, want: np.ndarray) -> None:
        """Brings the dishes to ``want`` customers (most first) and moves each customer once."""
        # a dish's draws are numbered by its own steps: other dishes must not change them
        less, out, come = np.flatnonzero(self.here > want), 1 << 40, 1 << 41
        while len(less):
            u = self._draw(less, out)
            out += 1
            at = np.minimum((u * self.here[less]).astype(np.int64), self.here[less] - 1)
            gone = self.seat[less, at]
            self.here[less] -= 1
            self.seat[less, at] = self.seat[less, self.here[less]]
            self._leave(less, gone)
            less = less[self.here[less] > want[less]]
        more = np.flatnonzero(self.here < want)
        while len(more):
            self._sit(more, self.here[more], self.here[more], come)
            self.here[more] += 1
            come += 1
            more = more[self.here[more] < want[more]]
        step = 0
        last = int(want[0]) if len(want) else 0
        while step < last:
            m = int(np.searchsorted(-want, -step, side="left"))  # dishes that still move
            if m < ALONG:
                for row in range(m):
                    self._alone(row, step, int(want[row]))
                return
            i = np.arange(m)
            self._leave(i, self.seat[:m, step])
            self._sit(i, np.full(m, step), want[:m] - 1, step)
            step += 1

    def _draw(self, i: np.ndarray, step: int, again: int = 0) -> np.ndarray:
        return _mixed(self.state[i] + np.uint64((step * 64 + again) * _GOLD & _LOW))

    def _leave(self, i: np.ndarray, k: np.ndarray) -> None:
        self.z[i, k] -= 1
        empty = self.z[i, k] == 0
        i, k = i[empty], k[empty]
        self.free[i, self.left[i]] = k
        self.left[i] += 1
        self.t[i] -= 1

    def _sit(self, i: np.ndarray, me: np.ndarray, others: np.ndarray, step: int) -> None:
        """Customers ``me`` of the dishes ``i`` sit down beside so many others (those of numbers below ``others + 1``, but ``me``)."""
        weight = self.new(self.rows[i], self.t[i])
        again = 0
        while len(i):
            x = self._draw(i, step, again) * (others + weight)
            fresh = x < weight
            x = np.where(fresh, 0.0, x - weight)
            j = np.minimum(x.astype(np.int64), np.maximum(others - 1, 0))
            part = x - j
            j += j >= me
            k = self.seat[i, np.minimum(j, self.seat.shape[1] - 1)]
            done = fresh | (part * self.z[i, k] >= self.d)
            if fresh.any():
                f = i[fresh]
                self.left[f] -= 1
                k[fresh] = self.free[f, self.left[f]]
                self.t[f] += 1
            if done.all():
                self.z[i, k] += 1
                self.seat[i, me] = k
                return
            d = i[done]
            self.z[d, k[done]] += 1
            self.seat[d, me[done]] = k[done]
            i, me, others, weight = (v[~done] for v in (i, me, others, weight))
            again += 1

    def _alone(self, row: int, step: int, want: int) -> None:
        """The steps of one dish from ``step`` on, as ``_leave`` and ``_sit`` make them, by plain numbers."""
        z, seat, free = (array("i", x[row].tobytes()) for x in (self.z, self.seat, self.free))
        t, left, d, others, state = int(self.t[row]), int(self.left[row]), self.d, want - 1, int(self.state[row])
        weights: dict[int, float] = {}
        at_once = 1 << 14
        for begin in range(step, want, at_once):
            end = min(want, begin + at_once)
            draws = _mixed(np.uint64(state) + (np.arange(begin, end, dtype=np.uint64) * np.uint64(64 * _GOLD & _LOW))).tolist()
            for me in range(begin, end):
                k = seat[me]
                z[k] -= 1
                if not z[k]:
                    free[left] = k
                    left += 1
                    t -= 1
                w = weights.get(t)
                if w is None:
                    w = weights[t] = float(np.broadcast_to(self.new(self.rows[row:row + 1], np.array([t])), 1)[0])
                u, again = draws[me - begin], 0
                while True:
                    x = u * (others + w)
                    if x < w:
                        left -= 1
                        k = free[left]
                        t += 1
                        break
                    x -= w
                    j = int(x)
                    if j >= others:
                        j = max(others - 1, 0)
                    part = x - j
                    k = seat[j + 1 if j >= me else j]
                    if part * z[k] >= d:
                        break
                    again += 1
                    u = _mixed_one(state + (me * 64 + again) * _GOLD)
                z[k] += 1
                seat[me] = k
        self.z[row] = z


def _tables_of(z: np.ndarray) -> np.ndarray:
    """The table of each customer, dish after dish, where the tables hold ``z``."""
    return np.repeat(np.tile(np.arange(z.shape[1], dtype=np.int32), len(z)), z.ravel())


_GOLD, _LOW = 0x9E3779B97F4A7C15, 0xFFFFFFFFFFFFFFFF


def _mixed(x: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) from counted states (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) / (1 << 53)


def _mixed_one(x: int) -> float:
    """``_mixed`` of a plain number."""
    x &= _LOW
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & _LOW
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & _LOW
    return ((x ^ (x >> 31)) >> 11) / (1 << 53)


# --- rows of arrays ----------------------------------------------------------------------------

_KINDS = {"int": pa.int32(), "long": pa.int64(), "float": pa.float32(), "double": pa.float64()}


def _ragged(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and values of a list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.diff(column.offsets.to_numpy()), column.flatten().to_numpy(zero_copy_only=False)


def _row(schema: str, **cells) -> pa.RecordBatch:
    """One row of ``schema``; cells that are not given are empty lists or null."""
    out, names = [], []
    for name, kind in (f.split() for f in schema.split(", ")):
        value = cells.get(name)
        if kind.startswith("array"):
            item = _KINDS[kind[6:-1]]
            flat = pa.array(np.asarray([] if value is None else value).astype(item.to_pandas_dtype()), item)
            out.append(pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat))
        else:
            out.append(pa.array([None if value is None else int(value)], _KINDS[kind]))
        names.append(name)
    return pa.record_batch(out, names=names)


def _cells(t: pa.Table | pa.RecordBatch, i: int = 0) -> dict:
    """The cells of a row, lists as numpy arrays."""
    row = {n: t.column(n)[i] for n in t.schema.names}
    return {n: x.values.to_numpy(zero_copy_only=False) if pa.types.is_list(x.type) else x.as_py() for n, x in row.items()}


def _parts(where: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each value of ``where`` with its positions, ascending."""
    order = np.argsort(where, kind="stable")
    value, first = np.unique(where[order], return_index=True)
    yield from zip(value.tolist(), np.split(order, first[1:]))


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    return (key.view(np.uint64) % np.uint64(buckets)).astype(np.int64)


def _rise(sizes: np.ndarray) -> list[float]:
    """The weight of tables under each discount, as a log."""
    n, times = np.unique(sizes[sizes > 1], return_counts=True)
    return [float((_log_rise(n, d) * times).sum()) for d in DISCOUNTS]


def _context_logs(customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """The log weight of restaurants of so many customers and tables, but for their tables' sizes, by discount and strength."""
    pair, times = np.unique(np.stack([customers, tables])[:, np.asarray(tables) > 0].astype(np.int64), axis=1, return_counts=True)
    n, t = pair.astype(float)
    return np.array([[((t * np.log(d) + _log_gamma(s / d + t) - _log_gamma(np.array([s / d])) - _log_gamma(s + n) + _log_gamma(np.array([s])))
                      * times).sum() for s in STRENGTHS] for d in DISCOUNTS])


def _opened(n: np.ndarray, weight, u: np.ndarray) -> np.ndarray:
    """As many tables as are expected for ``n`` customers."""
    return np.minimum(n, 1 + np.floor(weight * np.log((n + weight) / (1 + weight)) + u)).astype(np.int64)


def _singles(tables: np.ndarray, customers: np.ndarray) -> np.ndarray:
    """Sizes of ``tables`` tables each: the first takes all but one customer for each other."""
    out = np.ones(int(tables.sum()), np.int64)
    first = (np.cumsum(tables) - tables)[tables > 0]
    out[first] = (customers - tables + 1)[tables > 0]
    return out


# --- pairs: from blocks to buckets --------------------------------------------------------------

#: A block's pairs for a bucket: contexts (place in the block, key, number if common) with a run of pairs each;
#: ``step``: differences of the pairs' places among the block's pairs; ``n``: training tokens.
_SENT = ("bucket int, blk long, pos array<int>, ctx array<long>, common array<int>, runs array<int>, key array<long>, "
         "n array<int>, step array<int>")
#: A bucket: words with two customers and more in some context, contexts with training tokens, pairs with two and more;
#: ``every``, ``pairs``, ``ones``: all words with their pairs and pairs of one customer. The rest tells what the blocks ``blk``
#: ask for, in runs of ``asks``: pairs of two and more, pairs that another block has the one customer of, and rare contexts.
_COUNTED = ("bucket int, word array<long>, ctx array<long>, common array<int>, own array<long>, solo array<int>, pw array<int>, "
            "pc array<int>, n array<long>, every array<long>, pairs array<int>, ones array<int>, stats array<double>, blk array<long>, "
            "asks array<int>, ask_pair array<int>, ask_at array<int>, lone_at array<int>, ask_ctx array<int>, ask_pos array<int>")
_HELD = _COUNTED.split(", every")[0]
#: The seating of a bucket: ``tables`` of each word, what the samples so far gave, and sums for the driver.
_SEATS = _HELD + ", t array<int>, sizes array<long>, direct array<double>, back array<float>, tables array<long>, stats array<double>"
#: Words of a bucket, or (``reply`` to a bucket of pairs) the customers and tables in the parent of the words it asked for.
_WORDS = ("bucket int, key array<long>, c array<long>, lone array<long>, customers array<long>, seats array<int>, top array<long>, "
          "p1 array<float>, stats array<double>, reply int, src int, r_customers array<long>, r_seats array<int>")
_ASKED = "dest int, src int, key array<long>, x array<long>, y array<long>"


def _read(b: pa.RecordBatch | pa.Table, i: int) -> dict:
    row = {n: b.column(n)[i].values for n in ("tok", "size", "learn", "doc", "held", "word", "key", "n") if n in b.schema.names}
    return {n: (x.to_numpy(zero_copy_only=False).astype(np.int64) if n in ("tok", "size", "key", "n") else x.to_pylist()) for n, x in row.items()}


def _pairs(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of a block (places of context and word in one number), the pair of each token, and training tokens of each pair."""
    before = np.concatenate(([0], row["tok"][:-1]))  # word 0 is the end: a text starts after the end of the one before
    pair, of = np.unique(before << 32 | row["tok"], return_inverse=True)
    return pair, of, np.bincount(of[np.repeat(row["learn"], row["size"])], minlength=len(pair))


def _numbers(row: dict, contexts: dict[bytes, int]) -> np.ndarray:
    return np.array([contexts.get(w, 0) for w in row["word"]], np.int64)


def _sent(made: DataFrame, contexts: dict[bytes, int], buckets: int) -> DataFrame:
    """The distinct pairs of all blocks, dealt to buckets."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):
                row = _read(b, i)
                pair, _, n = _pairs(row)
                c, w, key, number = pair >> 32, pair & 0xFFFFFFFF, row["key"], _numbers(row, contexts)
                with np.errstate(over="ignore"):
                    spread = np.where(number[c] > 0, key[c] * np.int64(3) + key[w], key[c])
                for bucket, at in _parts(_bucket(spread, buckets)):
                    first = np.flatnonzero(np.diff(c[at], prepend=-1))
                    pos = c[at][first]
                    yield _row(_SENT, bucket=bucket, blk=b.column("blk")[i].as_py(), pos=pos, ctx=key[pos], common=number[pos],
                               runs=np.diff(np.append(first, len(at))), key=key[w[at]], n=n[at], step=np.diff(at, prepend=0))

    return made.select("blk", "tok", "size", "learn", "word", "key").mapInArrow(work, _SENT)


def _merge(t: pa.Table) -> dict:
    """A bucket's pairs from what the blocks sent: cells (context, word, training tokens) in order, and the sent rows of each."""
    size, key = _ragged(t["key"])
    runs, step = _ragged(t["runs"])[1], _ragged(t["step"])[1].astype(np.int64)
    ctx, common = np.repeat(_ragged(t["ctx"])[1], runs), np.repeat(_ragged(t["common"])[1], runs)
    at = np.cumsum(step)
    first = np.cumsum(size) - size
    at -= np.repeat(at[first] - step[first], size)
    order = np.lexsort((key, ctx))
    ctx, key, n = ctx[order], key[order], _ragged(t["n"])[1][order]
    new = np.concatenate(([True], (ctx[1:] != ctx[:-1]) | (key[1:] != key[:-1])))
    cell = np.cumsum(new) - 1
    return {"ctx": ctx[new], "key": key[new], "common": common[order][new], "n": np.bincount(cell, n).astype(np.int64),
            "cell": cell, "blk": np.repeat(t["blk"].to_numpy(), size)[order], "at": at[order], "sent": n}


def _counted(sent: DataFrame, contexts: int, buckets: int) -> DataFrame:
    """Buckets with the counts of their pairs, and which blocks ask for what."""
    def count(t: pa.Table) -> pa.Table:
        m = _merge(t)
        there = m["n"] > 0
        ctx, first, pc = np.unique(m["ctx"][there], return_index=True, return_inverse=True)
        n, key, common = m["n"][there], m["key"][there], m["common"][there][first]
        many = n > 1
        every, of = np.unique(key, return_inverse=True)
        word = np.unique(key[many])
        word = word[np.argsort(_bucket(word, buckets), kind="stable")]
        back = np.argsort(word)
        # which blocks ask: places among the pairs of two customers and more, and among the contexts
        place = np.cumsum(m["n"] > 1) - 1
        of_many, lone = m["n"][m["cell"]] > 1, (m["n"][m["cell"]] == 1) & (m["sent"] == 0)
        pos_size, pos = _ragged(t["pos"])
        from_blk, of_ctx = np.repeat(t["blk"].to_numpy(), pos_size), _ragged(t["ctx"])[1]
        hit = np.minimum(np.searchsorted(ctx, of_ctx), max(len(ctx) - 1, 0))
        told = (ctx[hit] == of_ctx) & (_ragged(t["common"])[1] == 0) if len(ctx) else np.zeros(len(of_ctx), bool)
        blk, asks = np.unique(t["blk"].to_numpy()), []
        runs = {"ask_pair": [], "ask_at": [], "lone_at": [], "ask_ctx": [], "ask_pos": []}
        for b in blk:
            a, o, c = np.flatnonzero(of_many & (m["blk"] == b)), np.flatnonzero(lone & (m["blk"] == b)), np.flatnonzero(told & (from_blk == b))
            asks += [len(a), len(o), len(c)]
            for name, x in zip(runs, (place[m["cell"][a]], m["at"][a], m["at"][o], hit[c], pos[c])):
                runs[name].append(x)
        return pa.Table.from_batches([_row(
            _COUNTED, bucket=t["bucket"][0].as_py(), word=word, ctx=ctx, common=common, own=np.bincount(pc, n, len(ctx)),
            solo=np.bincount(pc[~many], minlength=len(ctx)), pw=back[np.searchsorted(word[back], key[many])], pc=pc[many], n=n[many],
            every=every, pairs=np.bincount(of, minlength=len(every)), ones=np.bincount(of[~many], minlength=len(every)),
            stats=np.bincount(common[pc], minlength=contexts), blk=blk, asks=asks, **{k: np.concatenate(v) for k, v in runs.items()})])

    return sent.groupBy("bucket").applyInArrow(count, _COUNTED)


# --- sweeps -------------------------------------------------------------------------------------

def _asked(rows: DataFrame, buckets: int, key: str, x: str, y: str | None = None) -> DataFrame:
    """What buckets of pairs send to the buckets of words: runs of words with a number or two."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):
                r = _cells(b, i)
                for dest, at in _parts(_bucket(r[key], buckets)):
                    yield _row(_ASKED, dest=dest, src=r["bucket"], key=r[key][at], x=r[x][at], y=r[y][at] if y else None)

    return rows.select("bucket", key, x, *([y] if y else [])).mapInArrow(work, _ASKED)


def _answers(asked: pa.Table, key: np.ndarray, customers: np.ndarray, seats: np.ndarray) -> list[pa.RecordBatch]:
    out = []
    for i in range(len(asked)):
        r = _cells(asked, i)
        # a first call names all words: those with a pair of two customers and more are answered
        at = np.searchsorted(key, r["key"][r["x"] > r["y"]] if len(r["y"]) else r["key"])
        out.append(_row(_WORDS, reply=r["src"], src=r["dest"], r_customers=customers[at], r_seats=seats[at]))
    return out


def _first_words(known: DataFrame, counted: DataFrame, buckets: int) -> DataFrame:
    """Words with one table for all their contexts, and the answers for a first seating of the pairs."""
    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        key, c = (left[n].combine_chunks().to_numpy() for n in ("key", "c"))
        order = np.argsort(key)
        key, c = key[order], c[order]
        size, asked = _ragged(right["key"])
        at = np.searchsorted(key, asked)
        pairs, lone = (np.bincount(at, _ragged(right[n])[1], len(key)).astype(np.int64) for n in ("x", "y"))
        state = _row(_WORDS, bucket=left["dest"][0].as_py(), key=key, c=c, lone=lone, customers=pairs, seats=np.ones(len(key)), top=pairs,
                     stats=[pairs.sum(), len(key), *_rise(pairs)])
        return pa.Table.from_batches([state, *_answers(right, key, pairs, np.ones(len(key), np.int64))])

    dest = F.pmod(F.col("key"), F.lit(buckets))
    # keys as unsigned numbers: 2^64 is added to a negative one
    dest = F.when(F.col("key") < 0, F.pmod(dest + F.lit((1 << 64) % buckets), F.lit(buckets))).otherwise(dest).cast("int")
    asked = _asked(counted, buckets, "every", "pairs", "ones")
    return known.select("key", "c", dest.alias("dest")).groupBy("dest").cogroup(asked.groupBy("dest")).applyInArrow(work, _WORDS)


def _seated_words(words: DataFrame, seats: DataFrame, buckets: int, at: Levels, number: int, record: bool) -> DataFrame:
    """The words after sweep ``number`` over the parent (below 0: a first seating), and the answers for the next sweep."""
    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        r = _cells(left)
        key, seated = r["key"], Tables(r["seats"].astype(np.int64), r["top"])
        p1 = r["p1"].reshape(len(key), -1) if len(key) else np.zeros((0, 0))
        if record:
            p1 = np.column_stack([p1, at.word(r["customers"], seated.count)])
        customers = r["lone"] + np.bincount(np.searchsorted(key, _ragged(right["key"])[1]), _ragged(right["x"])[1], len(key)).astype(np.int64)
        parent = seated.count
        if number < 0:
            count = _opened(customers, (at.strength[1] + at.discount[1] * at.parent[1]) * at.base, _uniform(key, 2, 0))
            seated = Tables(count, _singles(count, customers))
        else:
            def open_in_parent(rows, tables):
                return (at.strength[1] + at.discount[1] * np.maximum(at.parent[1] + tables - parent[rows], 0)) * at.base

            seated = seated.reseat(customers, at.discount[1], open_in_parent, key, 2 * number + 12)
        state = _row(_WORDS, bucket=r["bucket"], key=key, c=r["c"], lone=r["lone"], customers=customers, seats=seated.count, top=seated.sizes,
                     p1=p1.ravel(), stats=[seated.sizes.sum(), len(seated.sizes), *_rise(seated.sizes)])
        return pa.Table.from_batches([state, *_answers(right, key, customers, seated.count)])

    state = words.where("reply is null").select(*[f.split()[0] for f in _WORDS.split(", ")[:8]])
    return state.groupBy("bucket").cogroup(_asked(seats, buckets, "word", "tables").groupBy("dest")).applyInArrow(work, _WORDS)


def _context_tables(r: dict, at: Levels) -> tuple[np.ndarray, np.ndarray]:
    """Customers and tables of a bucket's contexts; of the common ones in all buckets."""
    common = r["common"]
    tables = r["solo"] + np.bincount(r["pc"], r["t"], len(r["ctx"]))
    return np.where(common > 0, at.customers[common], r["own"]), np.where(common > 0, at.tables[common], tables)


def _recorded(r: dict, at: Levels) -> dict:
    """``r`` with the predictive values of its seating: pairs' own parts, the parent's weight in contexts."""
    customers, tables = _context_tables(r, at)
    back = np.asarray(r["back"], float).reshape(len(r["ctx"]), -1) if len(r["ctx"]) else np.zeros((0, 0))
    return r | {"direct": r["direct"] + at.own(r["n"], r["t"], customers[r["pc"]]),
                "back": np.column_stack([back, at.backoff(customers, tables)]).ravel()}


def _seated_pairs(seats: DataFrame, words: DataFrame, at: Levels, number: int, record: bool) -> DataFrame:
    """The buckets of pairs after sweep ``number`` over contexts (below 0: a first seating, all but one table with a single customer)."""
    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        r = _cells(left)
        right = right.sort_by("src")  # in the order of the bucket's words
        customers, top = (_ragged(right[n])[1].astype(np.int64)[r["pw"]] if len(right) else np.zeros(0, np.int64) for n in ("r_customers", "r_seats"))
        d, s, key, n, pc = at.discount[0], at.strength[0], r["word"][r["pw"]], r["n"], r["pc"]
        if number < 0:
            r |= {"t": np.ones(len(n), np.int64), "direct": np.zeros(len(n)), "back": np.zeros(0)}
        elif record:
            r = _recorded(r, at)
        _, tables = _context_tables(r, at)
        with np.errstate(over="ignore"):
            pair = key * np.int64(1_000_003) + r["ctx"][pc]
        if number < 0:
            count = _opened(n, (s + d * tables[pc]) * at.word(customers.astype(float), 1.0), _uniform(pair, 1, 0))
            seated = Tables(count, _singles(count, n))
        else:
            before = r["t"].astype(np.int64)

            def open_in_context(rows, now):
                more = now - before[rows]
                return (s + d * np.maximum(tables[pc[rows]] + more, 0)) * at.word(np.maximum(customers[rows] + more, top[rows]), top[rows])

            seated = Tables(before, r["sizes"]).reseat(n, d, open_in_context, pair, 2 * number + 11)
        own = r["solo"] + np.bincount(pc, seated.count, len(r["ctx"])).astype(np.int64)
        rare = r["common"] == 0
        of_word = np.bincount(r["pw"], seated.count, len(r["word"]))
        stats = np.concatenate([np.bincount(r["common"], own, len(at.customers)), _rise(seated.sizes),
                                _context_logs(r["own"][rare], own[rare]).ravel()])
        r |= {"t": seated.count, "sizes": seated.sizes, "tables": of_word, "stats": stats}
        return pa.Table.from_batches([_row(_SEATS, **r)])

    replies = words.where("reply is not null").select("reply", "src", "r_customers", "r_seats")
    names = [f.split()[0] for f in (_HELD if number < 0 else _SEATS.split(", tables")[0]).split(", ")]
    return seats.select(*names).groupBy("bucket").cogroup(replies.groupBy("reply")).applyInArrow(work, _SEATS)


def _sums(rows: DataFrame, length: int) -> np.ndarray:
    """The sums of all rows' ``stats``; they are as long as the list of common contexts."""
    out = np.zeros(length)
    summed = rows.where("size(stats) > 0").select(F.posexplode("stats").alias("i", "x")).where("x <> 0").groupBy("i").agg(F.sum("x").alias("x"))
    for r in summed.collect():
        out[r["i"]] = r["x"]
    return out


def _grid(at: Levels, contexts: np.ndarray, rise: np.ndarray, number: int) -> Levels:
    """``at`` with discounts and strengths drawn from their posterior on the grid, given the seating's sums."""
    rng = np.random.default_rng(100 + number)
    d_out, s_out = [], []
    logs = (contexts + _context_logs(at.customers, at.tables), _context_logs(np.array([at.parent[0]]), np.array([at.parent[1]])))
    for log, of_sizes in zip(logs, rise):
        log = log + of_sizes[:, None]
        p = np.exp(log - log.max()).ravel()
        pick = rng.choice(len(p), p=p / p.sum())
        d_out.append(DISCOUNTS[pick // len(STRENGTHS)])
        s_out.append(STRENGTHS[pick % len(STRENGTHS)])
    return Levels(at.customers, at.tables, at.parent, at.base, tuple(d_out), tuple(s_out))


# --- model -------------------------------------------------------------------------------------

#: Stands for the own part of a pair with a single customer, which its context tells.
ALONE = -1.0


@dataclass
class Model:
    """The last seating with what the samples before gave, as tables, and the numbers that all words share."""
    sent: DataFrame
    counted: DataFrame
    seats: DataFrame
    known: DataFrame  # words of the last seating
    buckets: int
    contexts: dict[bytes, int]  # numbers of the common contexts
    backoff: np.ndarray  # weight of the parent by common context and sample
    alone: np.ndarray  # a single customer's own part, by common context
    unknown: np.ndarray  # probability of the unknown word in the parent, by sample
    tokens: int
    words: int
    levels: list[Levels]

    @property
    def lists(self) -> DataFrame:
        """The model by word: ``key`` with ``p1`` (probabilities in the parent by sample), or with contexts ``ctx`` (a common one's
        number, else its word's key) and own parts ``direct`` there. Made when it is read: scoring has no need of it."""
        levels, at, samples = self.levels, self.levels[-1], len(self.levels)

        def of_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for key, _, p1 in _words_of(batches, at):
                for k, p in zip(key, p1):
                    yield _row(_LISTS, key=k, p1=p)

        def of_pairs(left: pa.Table, right: pa.Table) -> pa.Table:
            m, r = _merge(left), _recorded(_cells(right), at)
            there = m["n"] > 0
            key, ctx, common, n = (m[x][there] for x in ("key", "ctx", "common", "n"))
            direct = np.where(common > 0, ALONE, _alone(levels, r["own"][np.searchsorted(r["ctx"], ctx)]))
            direct[n > 1] = r["direct"] / samples
            rows = [_row(_LISTS, key=k, ctx=[c], direct=[d]) for k, c, d in zip(key, np.where(common > 0, common, ctx), direct)]
            return pa.Table.from_batches(rows or [_row(_LISTS).slice(1)])

        words = self.known.select("key", "c", "customers", "seats", "p1").mapInArrow(of_words, _LISTS)
        pairs = self.sent.groupBy("bucket").cogroup(self.seats.drop("stats", "tables").groupBy("bucket")).applyInArrow(of_pairs, _LISTS)
        return words.unionByName(pairs)


def _alone(levels: list[Levels], customers: np.ndarray) -> np.ndarray:
    """A single customer's own part in contexts of so many customers."""
    return np.mean([x.own(1, 1, customers) for x in levels], axis=0)


_LISTS = "key long, p1 array<float>, ctx array<long>, direct array<float>"


def _words_of(batches: Iterator[pa.RecordBatch], at: Levels) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Keys, counts and probabilities by sample of rows of words."""
    for b in batches:
        for i in range(len(b)):
            r = _cells(b, i)
            if len(r["key"]):
                yield r["key"], r["c"], np.column_stack([r["p1"].reshape(len(r["key"]), -1), at.word(r["customers"], r["seats"])])


def fit(made: DataFrame, known: DataFrame, share: float = CONTEXT_SHARE, burn_in: int = BURN_IN, samples: int = SAMPLES,
        bucket: int = BUCKET) -> Model:
    """The model of written ``blocks`` and their ``vocabulary`` (``known``): documents whose ``learn`` is true are its customers."""
    facts = known.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    tokens, v = facts["n"] or 0, facts["v"]
    # at most 1 / share words can hold that share
    common = known.where(F.col("c") >= F.lit(share * tokens)).orderBy(F.desc("c"), "word").collect()
    contexts = {bytes(r["word"]): i + 1 for i, r in enumerate(common)}
    k, buckets = len(contexts) + 1, max(1, -(-tokens // bucket))
    sent = _sent(made, contexts, buckets)
    counted = _kept(_counted(sent, k, buckets), _path(made, "pairs"))
    customers = np.array([0, *(r["c"] for r in common)], float)
    root = _path(made, "seating")

    def kept(df: DataFrame, name: str) -> DataFrame:
        # two folders in turn: a seating takes the place of the last but one
        return _kept(df, f"{root}-{name}")

    width = k + len(DISCOUNTS) * (1 + len(STRENGTHS))
    seats, words = counted, kept(_first_words(known, counted, buckets), "words-0")
    at = Levels(customers, _sums(counted, k), (0, 0), 1 / (v + 1))
    at.tables[0] = 0
    at.parent = tuple(int(x) for x in _sums(words, 2 + len(DISCOUNTS))[:2])
    levels = []
    for number in range(-1, burn_in + samples):
        record = number > burn_in
        seats = kept(_seated_pairs(seats, words, at, number, record), f"pairs-{number % 2}")
        words = kept(_seated_words(words, seats, buckets, at, number, record), f"words-{number % 2}")
        own, top = _sums(seats, width), _sums(words, 2 + len(DISCOUNTS))
        at = Levels(customers, np.concatenate(([0.0], own[1:k])), (int(top[0]), int(top[1])), at.base, at.discount, at.strength)
        if number >= 0:
            at = _grid(at, own[k + len(DISCOUNTS):].reshape(len(DISCOUNTS), -1), np.stack([own[k:k + len(DISCOUNTS)], top[2:]]), number)
        if number >= burn_in:
            levels.append(at)
    backoff = np.column_stack([x.backoff(x.customers, x.tables) for x in levels])
    unknown = np.array([float(x.word(0.0, 0.0)) for x in levels])
    return Model(sent, counted, seats, words.where("reply is null"), buckets, contexts, backoff, _alone(levels, customers), unknown,
                 tokens, v, levels)


def vocabulary(docs: DataFrame, held: Column, id_col: str = "doc_id", text_col: str = "text",
               tokens: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Written blocks of ``docs`` and their training words with counts (``word``, ``key``, ``c``); keys tell all words apart."""
    seed = 0
    while True:
        made = _kept(blocks(docs, held, id_col, text_col, seed, tokens), _path(docs, "blocks"))
        of_words = made.select(F.explode(F.arrays_zip("word", "key", "n")).alias("x")).select("x.*")
        # words that only held-out texts have count too: their keys must not meet a training word's
        known = written(of_words.groupBy("word").agg(F.first("key").alias("key"), F.sum("n").alias("c")), "words")
        shared = known.groupBy("key").count().where("count > 1")
        if not shared.head(1):
            return made, known.where("c > 0")
        seed += 1


#: What a block is told: own parts of pairs, pairs with one customer elsewhere, rare contexts with customers and weights of
#: the parent, and words with counts and probabilities.
_TOLD = ("blk long, at array<int>, direct array<float>, lone array<int>, cpos array<int>, customers array<long>, back array<float>, "
         "pos array<int>, c array<long>, p1 array<float>")


#: Pairs whose samples are looked at in one go.
_SLICE = 1 << 18


def score(made: DataFrame, model: Model) -> DataFrame:
    """``id``, ``held_out``, ``n_tokens``, ``n_known``, ``base_score``, ``score`` of every document of ``made``."""
    contexts, unknown, backoff, alone = model.contexts, model.unknown, model.backoff, model.alone
    levels, at, samples, buckets = model.levels, model.levels[-1], len(model.levels), model.buckets
    base = float(model.tokens + model.words + 1)

    def asks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):
                r = _cells(b, i)
                for dest, pos in _parts(_bucket(r["key"], buckets)):
                    yield _row(_WANTED, dest=dest, blk=r["blk"], pos=pos, key=r["key"][pos])

    def tell_words(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [_row(_TOLD).slice(1)]
        for key, c, p1 in _words_of(left.to_batches(), at):
            for i in range(len(right)):
                r = _cells(right, i)
                hit = np.minimum(np.searchsorted(key, r["key"]), len(key) - 1)
                there = key[hit] == r["key"]
                out.append(_row(_TOLD, blk=r["blk"], pos=r["pos"][there], c=c[hit[there]], p1=p1[hit[there]].ravel()))
        return pa.Table.from_batches(out)

    def tell_pairs(left: pa.Table, right: pa.Table) -> pa.Table:
        r, a = _recorded(_cells(left), at), _cells(right)
        back, direct, out = np.asarray(r["back"]).reshape(len(r["ctx"]), samples), r["direct"] / samples, []
        start = np.zeros(3, np.int64)
        for blk, size in zip(a["blk"], a["asks"].reshape(-1, 3)):
            p, o, c = (slice(x, x + n) for x, n in zip(start, size))
            ctx = a["ask_ctx"][c]
            out.append(_row(_TOLD, blk=blk, at=a["ask_at"][p], direct=direct[a["ask_pair"][p]], lone=a["lone_at"][o], cpos=a["ask_pos"][c],
                            customers=r["own"][ctx], back=back[ctx].ravel()))
            start += size
        return pa.Table.from_batches(out)

    wanted = made.select("blk", "key").mapInArrow(asks, _WANTED)
    told = (model.known.select("bucket", "key", "c", "customers", "seats", "p1").groupBy("bucket").cogroup(wanted.groupBy("dest"))
            .applyInArrow(tell_words, _TOLD))
    told = told.unionByName(model.seats.drop("stats", "tables").groupBy("bucket").cogroup(
        model.counted.select("bucket", "blk", "asks", "ask_pair", "ask_at", "lone_at", "ask_ctx", "ask_pos").groupBy("bucket"))
        .applyInArrow(tell_pairs, _TOLD))

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {n: [] for n in ("id", "held_out", "n_tokens", "n_known", "base_score", "score")}
        for i in range(len(left)):  # one row: block numbers are unique
            row = _read(left, i)
            pair, of, n = _pairs(row)
            c, tok, number = pair >> 32, row["tok"], _numbers(row, contexts)
            count, p1 = np.zeros(len(number), np.int64), np.tile(unknown, (len(number), 1))
            # a context that nothing is told of has no customers
            weight = np.where(number[:, None] > 0, backoff[number], 1.0)
            single, own, done = alone[number], np.zeros(len(pair)), np.zeros(len(pair), bool)
            for j in range(len(right)):
                r = _cells(right, j)
                count[r["pos"]], p1[r["pos"]] = r["c"], r["p1"].reshape(len(r["pos"]), samples)
                weight[r["cpos"]] = r["back"].reshape(len(r["cpos"]), samples)
                single[r["cpos"]] = _alone(levels, r["customers"])
                own[r["at"]], done[r["at"]] = r["direct"], True
                n[r["lone"]] = 1
            ones = (n == 1) & ~done
            own[ones] = single[c[ones]]
            # a word's own part in the context, and its probability in the parent by sample
            for a in range(0, len(pair), _SLICE):
                at_ = slice(a, a + _SLICE)
                own[at_] = np.log10(own[at_] + (weight[c[at_]] * p1[pair[at_] & 0xFFFFFFFF]).mean(1))
            log = own[of]
            starts = np.cumsum(row["size"]) - row["size"]
            out["id"] += row["doc"]
            out["held_out"] += row["held"]
            out["n_tokens"] += row["size"].tolist()
            out["n_known"] += np.add.reduceat((count > 0)[tok].astype(np.int64), starts).tolist()
            out["base_score"] += np.add.reduceat(np.log10((count + 1) / base)[tok], starts).tolist()
            out["score"] += np.add.reduceat(log, starts).tolist()
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        return pa.table([pa.array(x, k) for x, k in zip(out.values(), kinds)], names=list(out))

    return (made.drop("n").groupBy("blk").cogroup(told.groupBy("blk"))
            .applyInArrow(work, "id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"))


#: The words that a block wants to be told of.
_WANTED = "dest int, blk long, pos array<int>, key array<long>"


#: Removes a query's shuffle files when it ends; everything that later queries need is a written table.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows go to Python in batches of about a row: a batch ends behind the row that reaches so many bytes.
_BATCH, _BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", str(1 << 22)


def score_documents(docs: DataFrame, modulus: int = 7, remainder: int = 2, id_col: str = "doc_id", text_col: str = "text",
                    share: float = CONTEXT_SHARE, burn_in: int = BURN_IN, samples: int = SAMPLES) -> DataFrame:
    """One row per row of ``docs``: the id column, ``held_out`` (crc32 of the id as text leaves ``remainder``),
    ``n_tokens`` and ``n_known`` (tokens, and those with training tokens), ``train_tokens``, ``base_score``
    (add-one unigrams) and ``score``, both log10 probabilities of the whole text and its end.

    The documents that are not held out are learned from. A null text counts as
    empty (one token: the end); a null id is neither held out (null) nor learned
    from. Repeated rows count and are scored each time; copies of a text score
    alike. Without training documents every token has probability 1 under both.
    An empty table gives an empty one. Only the two named columns are read.
    """
    spark = docs.sparkSession
    prepare(spark)
    before, batch = spark.conf.get(_CLEANUP, "false"), spark.conf.get(_BATCH)
    spark.conf.set(_CLEANUP, "true")
    spark.conf.set(_BATCH, _BATCH_BYTES)
    try:
        made, known = vocabulary(docs, crc_mod(F.col(id_col), modulus) == remainder, id_col, text_col)
        model = fit(made, known, share, burn_in, samples)
        found = written(score(made, model), "scores")
    finally:
        spark.conf.set(_CLEANUP, before)
        spark.conf.set(_BATCH, batch)
    return found.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known",
                        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def perplexity(scored: DataFrame, score_col: str = "score") -> DataFrame:
    """Perplexity by ``held_out``: 10 to the negated mean log10 probability of a token."""
    return scored.groupBy("held_out").agg(F.pow(F.lit(10.0), -F.sum(score_col) / F.sum("n_tokens")).alias("perplexity"))
