"""Quality classifier: a byte-level convolutional network in numpy.

A text's bytes are cut into overlapping chunks of ``WIDTH`` bytes, one every
``STRIDE``, over the whole document. Every filter has a learned weight for each
byte value at each place of a chunk, and one for chunks that repeat what stood
up to ``ECHO`` bytes before. Rectified filter outputs are max-pooled and averaged
over the chunks; a logistic layer joins the pooled values into one probability.
Because a byte is one of 256 values, a filter is a table, and a chunk's output is
the sum of ``WIDTH`` looked-up rows. Long texts are pooled piece by piece, in the fit as in the scoring.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import prepare
from tidemark.llm.toxicity import training_rows

#: Labelled rows that the network is fitted on, at most, each with its whole text; once the rows taken have so many
#: bytes together, no further row is taken.
TRAIN_ROWS, TRAIN_BYTES = 4_000, 32 << 20
WIDTH, STRIDE, ECHO, FILTERS = 8, 4, 24, 16
THRESHOLD = 0.5
_PIECE = 1 << 18


def chunks(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of each chunk, whether it repeats an earlier one). Zero bytes pad the end;
    the lookback reaches into what comes before, so pieces must carry it along."""
    data = data or b"\0"  # an empty text is one chunk of padding
    padded = np.frombuffer(data + bytes(WIDTH - 1 + (-len(data)) % STRIDE), np.uint8)
    view = np.lib.stride_tricks.sliding_window_view(padded, WIDTH)[:len(data)]
    words = np.ascontiguousarray(view).view(np.uint64)[:, 0]
    at = np.arange(0, len(words), STRIDE)
    here = words[at]
    echo = np.zeros(len(at), bool)
    for lag in range(1, ECHO + 1):
        start = -(-lag // STRIDE)
        echo[start:] |= here[start:] == words[at[start:] - lag]
    return view[at], echo


@dataclass
class Network:
    table: np.ndarray  # (WIDTH * 256 + 2, FILTERS): byte weights by place and value, echo, constant
    dense: np.ndarray  # (2 * FILTERS + 1,): weights of the maxima, of the means, constant

    def outputs(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rectified filter outputs of a piece's chunks, the chunks' rows of the table, and their echoes."""
        view, echo = chunks(data)
        rows = view.astype(np.int32) + np.arange(0, WIDTH * 256, 256, dtype=np.int32)
        out = self.table[rows[:, 0]]
        for j in range(1, WIDTH):
            out += self.table[rows[:, j]]
        out += echo[:, None] * self.table[-2] + self.table[-1]
        return np.maximum(out, 0, out=out), rows, echo

    def pieces(self, data: bytes) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``outputs`` of a whole text, piece by piece; every chunk once."""
        for a in range(0, max(1, len(data)), _PIECE):
            skip = min(a, ECHO) // STRIDE  # chunks that only give the lookback
            part = slice(skip, skip + -(-min(_PIECE, max(1, len(data) - a)) // STRIDE))
            out, rows, echo = self.outputs(data[a - skip * STRIDE:a + _PIECE + WIDTH - STRIDE])
            yield out[part], rows[part], echo[part]

    def pooled(self, data: bytes) -> np.ndarray:
        best, total, n = np.zeros(FILTERS, np.float32), np.zeros(FILTERS), 0
        for out, _, _ in self.pieces(data):
            best, total, n = np.maximum(best, out.max(0)), total + out.sum(0), n + len(out)
        return np.concatenate([best, total / n, [1.0]])

    def slopes(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``pooled``, and how the maxima and the means of a whole text change with the table (each like the table).

        A maximum changes with the rows of its first largest chunk, a mean with
        the rows of all chunks whose output is positive.
        """
        best, total, n = np.zeros(FILTERS, np.float32), np.zeros(FILTERS), 0
        of_max, of_mean = np.zeros_like(self.table), np.zeros_like(self.table)
        for out, rows, echo in self.pieces(data):
            top, on = out.argmax(0), out > 0
            for f in range(FILTERS):
                if out[top[f], f] > best[f]:
                    of_max[:, f] = 0
                    of_max[rows[top[f]], f] = 1
                    of_max[-2:, f] = echo[top[f]], 1
                of_mean[:-2, f] += np.bincount(rows[on[:, f]].ravel(), minlength=WIDTH * 256)
            of_mean[-2] += on[echo].sum(0)
            of_mean[-1] += on.sum(0)
            best, total, n = np.maximum(best, out.max(0)), total + out.sum(0), n + len(out)
        of_mean /= n
        return np.concatenate([best, total / n, [1.0]]), of_max, of_mean

    def probability(self, text: str | None) -> float:
        """Probability of class 1; a null text counts as empty."""
        z = float(self.pooled((text or "").encode("utf-8", "surrogatepass")) @ self.dense)
        return 1 / (1 + float(np.exp(-max(-35.0, min(35.0, z)))))


def train(texts: list[str], labels: np.ndarray, passes: int = 6, batch: int = 16, rate: float = 0.02, seed: int = 3) -> Network:
    """The network by Adam on the log loss; classes weigh alike. One class only: a constant network."""
    rng = np.random.default_rng(seed)
    net = Network((rng.standard_normal((WIDTH * 256 + 2, FILTERS)) * 0.05).astype(np.float32), rng.standard_normal(2 * FILTERS + 1) * 0.1)
    net.dense[-1] = 0.0
    share = float(labels.mean()) if len(labels) else 0.0
    if share in (0.0, 1.0):
        net.table[:], net.dense[:] = 0, 0
        net.dense[-1] = 35.0 if share else -35.0
        return net
    data = [t.encode("utf-8", "surrogatepass") for t in texts]
    moments = [np.zeros_like(x) for x in (net.table, net.table, net.dense, net.dense)]
    step = 0
    for _ in range(passes):
        order = rng.permutation(len(data))
        for a in range(0, len(order), batch):
            d_table, d_dense = np.zeros_like(net.table), np.zeros_like(net.dense)
            for i in order[a:a + batch]:
                x, of_max, of_mean = net.slopes(data[i])
                z = np.clip(x @ net.dense, -35, 35)
                g = (1 / (1 + np.exp(-z)) - labels[i]) * (0.5 / share if labels[i] else 0.5 / (1 - share))
                d_dense += g * x
                d_table += of_max * (g * net.dense[:FILTERS]).astype(np.float32)
                d_table += of_mean * (g * net.dense[FILTERS:-1]).astype(np.float32)
            step += 1
            for p, d, m, v in ((net.table, d_table, *moments[:2]), (net.dense, d_dense, *moments[2:])):
                d /= batch
                m *= 0.9
                m += 0.1 * d
                v *= 0.999
                v += 0.001 * d * d
                p -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return net


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1) -> Network:
    """The network from the whole texts of labelled rows outside the held-out remainder: those with the smallest
    hashes of the id, ``TRAIN_ROWS`` at most and none after ``TRAIN_BYTES``."""
    rows = training_rows(docs, labels, "quality", modulus, held, TRAIN_ROWS)
    order = F.xxhash64("doc_id")
    taken, last = 0, None
    for r in sorted(rows.select(order.alias("h"), F.octet_length("text").alias("n")).collect()):  # TRAIN_ROWS rows at most
        if taken >= TRAIN_BYTES:
            break
        taken, last = taken + r["n"], r["h"]
    sample = rows.where(order <= F.lit(last)).select("doc_id", "text", "y").toPandas().sort_values("doc_id")
    return train(sample["text"].tolist(), sample["y"].to_numpy(float))


def score(docs: DataFrame, net: Network, text_col: str = "text", score_col: str = "score",
          predicted_col: str = "predicted") -> DataFrame:
    """``docs`` with ``score_col`` (0 to 1) and ``predicted_col`` (1 from ``THRESHOLD`` on).

    Every chunk of every whole text is seen; a null text counts as empty, an
    empty one is a single chunk of padding. Rows, repeated ones too, and further
    columns stay; columns of the two names are replaced. An empty table gives an
    empty one.
    """
    prepare(docs.sparkSession)

    def work(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([net.probability(t) for t in texts], dtype="float64")

    return (docs.withColumn(score_col, F.pandas_udf(work, "double")(F.col(text_col).cast("string")))
            .withColumn(predicted_col, (F.col(score_col) >= THRESHOLD).cast("int")))
