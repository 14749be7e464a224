"""Toxicity by Levenshtein automata over a lexicon trie, with context-window scores.

The lexicon is learned from labelled rows: whole words and word stems that occur
in far more toxic than clean documents. Its trie and the Levenshtein automata of
its entries are walked together; the set of (trie node, edits so far) pairs is
made deterministic state by state as words ask for it, so a word costs a few
dictionary steps and most words die after two or three letters. A hit keeps its
entry's weight and its number of edits.

Windows of words around hits tell quotation from abuse: hits inside quotation
marks or beside a reporting word count as quoted; hits near a word of address
and near other hits count more. A logistic regression joins the sums.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import crc_mod, prepare, written

#: Labelled rows the model is fitted on, at most (smallest hashes of the id first).
TRAIN_ROWS = 10_000
#: Entries of the lexicon, strongest first.
LEXICON = 400
WINDOW = 6
STEM = (4, 5, 6, 7, 8)
THRESHOLD = 0.3
_WORD = re.compile(r"[^\W_]+")
# Words that report speech, words of address (en, de, fr, es).
REPORTING = frozenset("said says say quote quoted word words term called wrote sagte sagt wort zitat dit mot cite dijo dice palabra".split())
ADDRESS = frozenset("you your youre u ur du dich dir ihr tu toi te vous usted ustedes".split())
QUOTES = "\"'«»“”„‘’"


@dataclass(frozen=True)
class Entry:
    text: str
    stem: bool  # matches every word that begins with it
    weight: float

    @property
    def edits(self) -> int:
        """Edits allowed: none in short entries, one in longer ones."""
        return int(len(self.text) >= (7 if self.stem else 5))


class Automaton:
    """Trie of the entries crossed with their Levenshtein automata, made deterministic lazily."""

    def __init__(self, entries: list[Entry]):
        self.child: list[dict[str, int]] = [{}]
        self.ends: list[list[Entry]] = [[]]
        self.room = [0]  # edits that some entry below the node allows
        for e in entries:
            at = 0
            for ch in e.text:
                self.room[at] = max(self.room[at], e.edits)
                if ch not in self.child[at]:
                    self.child[at][ch] = len(self.child)
                    self.child.append({})
                    self.ends.append([])
                    self.room.append(0)
                at = self.child[at][ch]
            self.room[at] = max(self.room[at], e.edits)
            self.ends[at].append(e)
        self.letters = {ch for c in self.child for ch in c}
        self.number: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.next: list[dict[str, int]] = []
        self.word: list[tuple[float, int]] = []  # best whole-word hit that ends in the state
        self.stems: list[tuple[float, int]] = []  # best stem hit that the state completes
        self.start = self._state({(0, 0)})

    def _state(self, pairs: set[tuple[int, int]]) -> int:
        """Number of the state, closed under skipped letters; -1 if it is dead."""
        todo, best = list(pairs), {}
        while todo:
            node, e = todo.pop()
            if e > self.room[node] or best.get(node, 99) <= e:
                continue
            best[node] = e
            if e < self.room[node]:
                todo += [(c, e + 1) for c in self.child[node].values()]
        if not best:
            return -1
        key = frozenset(best.items())
        if key not in self.number:
            self.number[key] = len(self.sets)
            self.sets.append(key)
            self.next.append({})
            found = [(e.weight, d, e.stem) for n, d in key for e in self.ends[n] if d <= e.edits]
            self.word.append(max(((w, -d) for w, d, stem in found if not stem), default=(0.0, 0)))
            self.stems.append(max(((w, -d) for w, d, stem in found if stem), default=(0.0, 0)))
        return self.number[key]

    def _step(self, s: int, ch: str) -> int:
        pairs = set()
        for node, e in self.sets[s]:
            if ch in self.child[node]:
                pairs.add((self.child[node][ch], e))
            if e < self.room[node]:
                pairs.add((node, e + 1))
                pairs.update((c, e + 1) for c in self.child[node].values())
        return self._state(pairs)

    def match(self, word: str) -> tuple[float, int, bool] | None:
        """Weight, edits and whether a stem hit; the strongest hit, fewest edits first."""
        s, stem = self.start, (0.0, 0)
        for ch in word:
            ch = ch if ch in self.letters else ""
            t = self.next[s].get(ch)
            if t is None:
                t = self.next[s][ch] = self._step(s, ch)
            s = t
            if s < 0:
                break
            stem = max(stem, self.stems[s])
        whole = self.word[s] if s >= 0 else (0.0, 0)
        best, is_stem = max((whole, False), (stem, True), key=lambda x: (x[0][1] == 0 and x[0][0] > 0, x[0][0]))
        return (best[0], -best[1], is_stem) if best[0] > 0 else None


class Scorer:
    """Features and score of a text."""

    SEEN = 300_000  # words whose match is remembered; dropped together when full

    def __init__(self, entries: list[Entry], coef: list[float] | None = None):
        self.automaton, self.coef = Automaton(entries), coef
        self.seen: dict[str, tuple[float, int, bool] | None] = {}

    def _hits(self, words: set[str]) -> dict[str, tuple[float, int, bool]]:
        seen, found = self.seen, {}
        for w in words:
            if w in seen:
                m = seen[w]
            else:
                if len(seen) >= self.SEEN:
                    seen.clear()
                m = seen[w] = self.automaton.match(w)
            if m:
                found[w] = m
        return found

    def features(self, text: str | None) -> list[float]:
        low = (text or "").lower()
        words = _WORD.findall(low)
        hits = self._hits(set(words))
        if not hits:
            return [1.0] + [0.0] * 7
        at = [(i, m.group(), m.start(), m.end()) for i, m in enumerate(_WORD.finditer(low)) if m.group() in hits]
        exact = stem = fuzzy = quoted = address = 0.0
        weights = []
        for i, w, a, b in at:
            weight, edits, is_stem = hits[w]
            near = words[max(0, i - WINDOW):i + WINDOW + 1]
            inside = any(c in QUOTES for c in low[max(0, a - 1):a]) and any(c in QUOTES for c in low[b:b + 1])
            if inside or not REPORTING.isdisjoint(near):
                quoted += weight
                weights.append(0.25 * weight)
                continue
            address += not ADDRESS.isdisjoint(near)
            weights.append(weight)
            if edits:
                fuzzy += weight
            elif is_stem:
                stem += weight
            else:
                exact += weight
        # strongest window: sliding sum of the hits' weights over neighbouring words
        best, total, j = 0.0, 0.0, 0
        for k, (i, *_) in enumerate(at):
            total += weights[k]
            while at[j][0] < i - 2 * WINDOW:
                total -= weights[j]
                j += 1
            best = max(best, total)
        return [1.0, *map(math.log1p, (exact, stem, fuzzy, quoted, best, address, 100 * sum(weights) / len(words)))]

    def score(self, text: str | None) -> float:
        z = sum(a * b for a, b in zip(self.coef, self.features(text)))
        return 1 / (1 + math.exp(-max(-35.0, min(35.0, z))))


def training_rows(docs: DataFrame, labels: DataFrame, target: str, modulus: int, held: int,
                  rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id``, ``text``, ``y`` of the labelled rows outside the held-out remainder, ``rows`` at most.

    The sample takes the smallest hashes of the id; a repeated id counts once, in
    the labels (1 if any is) and in ``docs`` (the smallest of its texts).
    Unlabelled rows and null ids are left out.
    """
    sample = (labels.where(F.col("doc_id").isNotNull() & F.col(target).isNotNull()
                           & (crc_mod(F.col("doc_id"), modulus) != held))
              .groupBy("doc_id").agg(F.max(F.col(target).cast("int")).alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).withColumnRenamed("doc_id", "id_"))
    return written(docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
                   .join(F.broadcast(sample), F.col("doc_id") == F.col("id_"))  # ``rows`` rows
                   .groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y")), "train")


def learn_lexicon(train: DataFrame, size: int = LEXICON) -> list[Entry]:
    """Words and stems that mark class 1, from document counts (copies of a text count once).

    Candidates occur in three positive documents or more; an entry is kept if
    its share of positives is beyond chance (binomial tail bound, corrected for
    the number of candidates). Weight: lower bound of the log odds.
    """
    once = train.groupBy(F.xxhash64("text").alias("h"), F.length("text").alias("n")).agg(
        F.max("y").alias("y"), F.max("text").alias("text"))
    forms = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))
    marks = F.flatten(F.transform(forms, lambda w: F.array(F.concat(F.lit("w"), w), *[
        F.when(F.length(w) >= k, F.concat(F.lit("s"), F.left(w, F.lit(k)))) for k in STEM])))
    entry = once.select("y", F.explode(F.array_distinct(marks)).alias("e")).where(F.col("e").isNotNull())
    total = {r["y"]: r["n"] for r in once.groupBy("y").agg(F.count("*").alias("n")).collect()}
    pos, neg = total.get(1, 0), total.get(0, 0)
    if not pos or not neg:
        return []
    base = pos / (pos + neg)
    counts = (entry.groupBy("e").agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("n"))
              .where(F.col("p") >= 3).withColumn("share", F.col("p") / (F.col("p") + F.col("n"))).where(F.col("share") > base))
    tail = (F.col("p") * F.log(F.col("share") / base)
            + F.when(F.col("n") > 0, F.col("n") * F.log((1 - F.col("share")) / (1 - base))).otherwise(0.0))
    p, n = F.col("p") + 0.5, F.col("n") + 0.5
    odds = F.log(p / (pos + 1)) - F.log(n / (neg + 1)) - F.sqrt(1 / p + 1 / n)
    table = counts.select("e", tail.alias("g"), odds.alias("w")).where("w > 0")
    need = math.log(max(1, table.count()))  # about one entry by chance
    best = table.where(F.col("g") >= need).orderBy(F.desc("g"), "e").limit(size).collect()
    return [Entry(r["e"][1:], r["e"][0] == "s", float(r["w"])) for r in best]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, rounds: int = 50) -> np.ndarray:
    """Coefficients by damped Newton steps; the first column is the constant and is not shrunk."""
    w, shrink = np.zeros(x.shape[1]), ridge * np.r_[0.0, np.ones(x.shape[1] - 1)]
    w[0] = math.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(shrink + 1e-9)
        step = np.linalg.solve(h, x.T @ (y - p) - shrink * w)
        w = w + step * min(1.0, 4 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, modulus: int = 4, held: int = 2) -> tuple[list[Entry], list[float]]:
    """Lexicon and coefficients. Without labels of both classes: no entries and a constant score."""
    prepare(docs.sparkSession)
    train = training_rows(docs, labels, "toxic", modulus, held)
    entries = learn_lexicon(train)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        s = Scorer(entries)
        for b in batches:
            yield pd.DataFrame({"y": b["y"], "x": [s.features(t) for t in b["text"]]})

    rows = train.select("text", "y").mapInPandas(work, "y int, x array<double>").toPandas()  # TRAIN_ROWS rows at most
    if not len(rows):
        return entries, [-35.0] + [0.0] * 7
    return entries, fit_logistic(np.stack(rows["x"].to_numpy()), rows["y"].to_numpy(float)).tolist()


def score(docs: DataFrame, model: tuple[list[Entry], list[float]], text_col: str = "text", score_col: str = "score",
          predicted_col: str = "predicted") -> DataFrame:
    """``docs`` with ``score_col`` (0 to 1) and ``predicted_col`` (1 from ``THRESHOLD`` on).

    Whole texts are scored; a null text counts as empty, and an empty text gets
    the model's constant. Rows, repeated ones too, and further columns stay;
    columns of the two names are replaced. An empty table gives an empty one.
    """
    prepare(docs.sparkSession)
    entries, coef = model

    def work(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        s = Scorer(entries, coef)
        for texts in batches:
            yield pd.Series([s.score(t) for t in texts], dtype="float64")

    return (docs.withColumn(score_col, F.pandas_udf(work, "double")(F.col(text_col).cast("string")))
            .withColumn(predicted_col, (F.col(score_col) >= THRESHOLD).cast("int")))
