"""Byte-level BPE encoding and decoding with a two-tier lookup.

A text is cut by the split pattern. Tier one: a minimal perfect hash over the
vocabulary (hash and displace: one displacement per bucket sends every
vocabulary entry to its own slot, no slot is empty) resolves pre-tokens that are
vocabulary entries. Tier two: the others start as linked single bytes with a
heap of mergeable neighbours; the lowest rank, leftmost first, is merged until
none is left. Ids decode through the slot table's byte strings.

Vocabularies are files of ranks (base64, space, rank); their path is a
parameter, nothing is trained.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, prepare

_MASK = (1 << 64) - 1
#: Bytes of words and their codes that one worker remembers in a generation, about; when it is full it becomes the old
#: one, and what that held and has not been asked for since is forgotten. Longer words are never remembered whole.
REMEMBERED_BYTES, LONGEST = 96 << 20, 64
#: Bytes of an entry besides its characters and ids: two objects and a place in a dictionary.
_ENTRY = 200
#: White space before a space: only there can a pre-token hold the end of one word and the next one's space.
_RUN = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S)(?= )")


class PerfectHash:
    """Minimal perfect hash of distinct byte strings to 0..n-1 by hash and displace.

    Buckets are placed largest first, each with the first displacement that sends
    its keys to free slots; a bucket of one key names its slot outright.
    """

    def __init__(self, keys: list[bytes], per_bucket: int = 3):
        self.n, self.buckets = len(keys), max(1, len(keys) // per_bucket)
        hashes = [xxhash.xxh64_intdigest(k) for k in keys]
        members: list[list[int]] = [[] for _ in range(self.buckets)]
        for i, h in enumerate(hashes):
            members[h % self.buckets].append(i)
        self.shift, self.at = [0] * self.buckets, [-1] * self.n
        for b in sorted((b for b in range(self.buckets) if len(members[b]) > 1), key=lambda b: -len(members[b])):
            own, d = [hashes[i] for i in members[b]], 0
            while True:
                slots = [self._slot(h, d) for h in own]
                if all(self.at[s] < 0 for s in slots) and len(set(slots)) == len(slots):
                    break
                d += 1
            self.shift[b] = d
            for i, s in zip(members[b], slots):
                self.at[s] = i
        free = iter([s for s in range(self.n) if self.at[s] < 0])
        for b, own in enumerate(members):
            if len(own) == 1:
                s = next(free)
                self.at[s], self.shift[b] = own[0], -1 - s

    def _slot(self, h: int, d: int) -> int:
        x = ((h >> 17) ^ (h << 3) ^ (d * 0x9E3779B97F4A7C15)) & _MASK
        x = ((x ^ (x >> 31)) * 0xBF58476D1CE4E5B9) & _MASK
        return (x ^ (x >> 29)) % self.n

    def slot(self, key: bytes) -> int:
        """The only slot that can hold ``key``; the caller compares what is there."""
        h = xxhash.xxh64_intdigest(key)
        d = self.shift[h % self.buckets]
        return -1 - d if d < 0 else self._slot(h, d)


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        words = list(ranks)
        self.hash = PerfectHash(words)
        self.key = [words[i] for i in self.hash.at]
        self.id = [ranks[k] for k in self.key]
        self.bytes_of = {r: k for k, r in ranks.items()}
        self.text_of = {r: str(r) for r in ranks.values()}
        self.one = [ranks[bytes([i])] for i in range(256)]
        self.bits = max(ranks.values()).bit_length()
        self.pair = {}  # (left id << bits | right id) -> id of the joined bytes
        for word, r in ranks.items():
            for cut in range(1, len(word)):
                a, b = ranks.get(word[:cut]), ranks.get(word[cut:])
                if a is not None and b is not None:
                    self.pair[a << self.bits | b] = r
        self.split = regex.compile(pattern).findall
        self.known = _Known(self)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of ``piece`` by merging linked bytes, lowest rank and leftmost first."""
        get, push, pop, bits = self.pair.get, heapq.heappush, heapq.heappop, self.bits
        ids = list(map(self.one.__getitem__, piece))
        n = len(ids)
        place = n.bit_length()
        low = (1 << place) - 1
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # an entry is a rank and, in its low bits, a position; it holds as long as the pair there still has this rank
        heap = [r << place | i for i, r in enumerate([get(a << bits | b) for a, b in zip(ids, ids[1:])]) if r is not None]
        heapq.heapify(heap)
        while heap:
            r = pop(heap)
            i = r & low
            r >>= place
            a, j = ids[i], after[i]
            if a < 0 or j >= n or get(a << bits | ids[j]) != r:
                continue
            ids[i], ids[j] = r, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                s = get(r << bits | ids[k])
                if s is not None:
                    push(heap, s << place | i)
            h = before[i]
            if h >= 0:
                s = get(ids[h] << bits | r)
                if s is not None:
                    push(heap, s << place | h)
        return [x for x in ids if x >= 0]

    def piece(self, token: str) -> list[int]:
        """Ids of one pre-token."""
        raw = token.encode("utf-8", "surrogatepass")
        s = self.hash.slot(raw)
        return [self.id[s]] if self.key[s] == raw else self.merge(raw)

    def words(self, text: str) -> list[str]:
        """``text`` cut before every space that follows no white space: no pre-token crosses such a cut."""
        if _RUN.search(text):
            found = _CUT.split(text)
        else:
            first, *rest = text.split(" ")
            found = [first, *map(" ".__add__, rest)]
        return found if found[0] else found[1:]

    def packed(self, text: str) -> bytes:
        """The ids as 32-bit integers."""
        return b"".join(map(self.known.__getitem__, self.words(text)))

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), np.int32).tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def digests(self, text: str) -> tuple[bytes, str, str]:
        """The ids as 32-bit integers, sha256 of the ids as text, sha256 of the bytes they decode to."""
        packed = self.packed(text)
        ids = np.frombuffer(packed, np.int32).tolist()
        return (packed, hashlib.sha256(" ".join(map(self.text_of.__getitem__, ids)).encode()).hexdigest(),
                hashlib.sha256(self.decode(ids)).hexdigest())


class _Known(dict):
    """Ids of a word as 32-bit integers, worked out when first asked for."""

    def __init__(self, codec: Codec):
        super().__init__()
        self.codec, self.old, self.bytes = codec, {}, 0

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            c = self.codec
            pieces = c.split(word)
            ids = array("i", c.piece(word)).tobytes() if len(pieces) == 1 else b"".join([self[p] for p in pieces])
        if len(word) <= LONGEST:
            self.bytes += _ENTRY + 4 * len(word) + len(ids)
            if self.bytes >= REMEMBERED_BYTES:
                self.old, self.bytes = dict(self), 0
                self.clear()
            self[word] = ids
        return ids


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The codec of a rank file, built once per process. Every machine reads its own
    copy of the file: vocabularies are installed with the workers' Python."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = Codec(read_ranks(path), pattern)
    return _CODECS[path, pattern]


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", ids: bool = True) -> DataFrame:
    """``docs`` with ``token_ids`` (array of int; left out if ``ids`` is false),
    ``n_tokens``, ``ids_sha256``, ``decoded_sha256``.

    A null text counts as empty (no tokens). Whole texts are encoded, without
    special tokens; rows, their order of columns and repeated rows stay as they
    are. New columns replace columns of the same name. An empty table gives an
    empty one. One text is held in memory at a time, besides its Arrow batch.
    """
    prepare(docs.sparkSession)
    made = "n_tokens long, ids_sha256 string, decoded_sha256 string" + (", token_ids array<int>" if ids else "")
    names = [f.split()[0] for f in made.split(", ")]

    def work(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        c = codec(path, pattern)
        for texts in batches:
            rows = [c.digests(t or "") for t in texts.to_pylist()]
            ends = np.cumsum([0] + [len(r[0]) >> 2 for r in rows])
            cells = [pa.array(np.diff(ends), pa.int64()), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string())]
            if ids:
                flat = np.frombuffer(b"".join([r[0] for r in rows]), np.int32)
                cells.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)))
            yield pa.StructArray.from_arrays(cells, names)

    run = F.arrow_udf(work, made)
    name = fresh(docs, "__bpe")[0]
    packed = docs.withColumn(name, run(F.col(text_col).cast("string")))
    return packed.withColumns({n: F.col(name)[n] for n in names}).drop(name)


def decode(tokens: DataFrame, path: str, pattern: str, ids_col: str = "token_ids", out: str = "decoded") -> DataFrame:
    """``tokens`` with binary column ``out``: the bytes of the ids (null ids: empty)."""
    prepare(tokens.sparkSession)

    def work(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        c = codec(path, pattern)
        for ids in batches:
            yield pd.Series([b"" if x is None else c.decode(x.tolist()) for x in ids])

    return tokens.withColumn(out, F.pandas_udf(work, "binary")(F.col(ids_col)))
