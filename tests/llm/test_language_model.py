import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language_model as lm

SCHEMA = "doc_id long, text string, score string"


def brute_base(rows):
    """Token counts and add-one unigram score in plain Python."""
    tokens = [(i, [w.decode() for w in (t or "").encode().lower().split()] + [None]) for i, t in rows]
    held = {i: None if i is None else zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    c = Counter(w for i, ws in tokens if held[i] is False for w in ws)
    n, v = sum(c.values()), len(c)
    out = [(i, held[i], len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6))
           for i, ws in tokens]
    return sorted(out, key=repr)


def compare(spark, rows, **more):
    got = lm.score_documents(spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA), **more).collect()
    assert sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got],
                  key=repr) == brute_base(rows)
    return got


def corpus(n=120, seed=3):
    r = np.random.default_rng(seed)
    words = [f"w{i}" for i in range(60)]
    chain = r.dirichlet(np.full(60, 0.05), 60)
    out = []
    for i in range(n):
        at, text = 0, []
        for _ in range(int(r.integers(1, 80))):
            at = r.choice(60, p=chain[at])
            text.append(words[at])
        out.append((i, " ".join(text)))
    return out


def test_base_score_and_gain(spark):
    rows = corpus()
    got = compare(spark, rows, share=0.005)
    held = [r for r in got if r.held_out]
    # words follow words here: the contexts must show
    assert sum(r.score for r in held) > 0.8 * sum(r.base_score for r in held)
    assert all(r.score < 0 for r in got)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (None, "a b"), (5, "A b c a"), (5, "A b c a"), (6, "É é a"), (7, "x " * 3000),
            (8, "　 y"), (9, "only here"), (10, "a b a b")]
    got = compare(spark, rows)
    assert len({r.score for r in got if r.doc_id == 5}) == 1
    assert all(np.isfinite(r.score) for r in got)
    empty = spark.createDataFrame([], SCHEMA)
    assert lm.score_documents(empty).collect() == []
    held_only = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2][:3]
    for r in lm.score_documents(spark.createDataFrame([(i, "a b", "") for i in held_only], SCHEMA)).collect():
        assert (r.train_tokens, r.n_known, r.base_score, r.score) == (0, 0, 0.0, 0.0)


def test_size_of_blocks_changes_nothing(spark):
    rows = corpus(40) + [(1000 + i, "the " * 50) for i in range(40)]
    df = spark.createDataFrame([(i, t, "") for i, t in rows], SCHEMA)
    held = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7) == 2

    def scores(tokens):
        made, known = lm.vocabulary(df.coalesce(1), held, tokens=tokens)
        return made.count(), {r.id: round(r.score, 9) for r in lm.score(made, lm.fit(made, known, share=0.01)).collect()}

    (one, whole), (many, cut) = scores(1 << 20), scores(100)
    assert whole == cut and one == 1 and many > 20


def test_predictive_probabilities_sum_to_one(spark):
    rows = corpus(60)
    df = spark.createDataFrame([(i, t, "") for i, t in rows], SCHEMA)
    made, known = lm.vocabulary(df, F.lit(False))
    model = lm.fit(made, known, share=0.01, burn_in=2, samples=2)
    own, p1 = {}, {}
    for r in model.lists.collect():
        if r.p1:
            p1[r.key] = np.array(r.p1)
        for c, d in zip(r.ctx, r.direct):
            own[r.key, c] = model.alone[c] if d == lm.ALONE else d
    assert set(p1) == {r.key for r in known.collect()}
    for ctx in range(len(model.backoff)):
        if not any(c == ctx for _, c in own):
            continue
        total = sum(own.get((k, ctx), 0.0) + (model.backoff[ctx] * p).mean() for k, p in p1.items())
        assert abs(total + (model.backoff[ctx] * model.unknown).mean() - 1) < 1e-6


@pytest.mark.parametrize("customers, d, s, p0", [(5, 0.5, 1.0, 0.3), (8, 0.8, 0.1, 0.9), (30, 0.3, 4.0, 0.5)])
def test_gibbs_steps_reach_the_exact_distribution_of_tables(customers, d, s, p0):
    # weights of t tables: generalised Stirling numbers times the tables' own weights
    stirling = np.zeros((customers + 1, customers + 2))
    stirling[0, 0] = 1
    for n in range(customers):
        for t in range(1, n + 2):
            stirling[n + 1, t] = stirling[n, t - 1] + (n - t * d) * stirling[n, t]
    exact = np.array([stirling[customers, t] * np.prod([(s + d * i) * p0 for i in range(t)]) for t in range(customers + 1)])
    exact /= exact.sum()
    dishes = 6_000
    tables = lm.Tables(np.ones(dishes, np.int64), np.full(dishes, customers, np.int64))
    key = np.arange(dishes, dtype=np.int64)
    for sweep in range(100):
        tables = tables.reseat(np.full(dishes, customers), d, lambda rows, t: (s + d * t) * p0, key, sweep)
    assert tables.sizes.sum() == dishes * customers and (tables.sizes > 0).all()
    got = np.bincount(tables.count, minlength=customers + 1) / dishes
    assert np.abs(got - exact).max() < 0.025


def test_customers_are_added_and_removed():
    tables = lm.Tables(np.array([1, 2, 0]), np.array([4, 1, 1]))
    moved = tables.reseat(np.array([9, 1, 3]), 0.5, lambda rows, t: np.full(len(rows), 0.7), np.arange(3), 1)
    parts = np.split(moved.sizes, np.cumsum(moved.count)[:-1])
    assert [int(p.sum()) for p in parts] == [9, 1, 3] and (moved.sizes > 0).all()


def test_log_gamma():
    x = np.array([0.05, 0.5, 1.0, 3.3, 50.0, 1e6])
    assert np.allclose(lm._log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-9, atol=1e-8)


def test_query(spark):
    from tidemark.llm.queries import op12_language_model
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = op12_language_model(spark, sf).collect()
    assert sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got],
                  key=repr) == brute_base(rows)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_every_word_is_a_context_wherever_its_pairs_are_held(spark):
    """Contexts below the share and more buckets: the same model. Words of one token each still are contexts."""
    rows = corpus(60) + [(500 + i, f"rare{i} next{i} rare{i} next{i} rare{i} next{i}") for i in range(30)]
    df = spark.createDataFrame([(i, t, "") for i, t in rows], SCHEMA)
    held = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7) == 2
    made, known = lm.vocabulary(df, held)
    scores = [{r.id: r.score for r in lm.score(made, lm.fit(made, known, burn_in=1, samples=2, **more)).collect()}
              for more in ({"share": 1e-9}, {"share": 2.0}, {"share": 0.01, "bucket": 200})]
    assert len(scores[0]) == len(rows)
    for other in scores[1:]:
        assert all(abs(s - other[i]) < 1e-4 * abs(s) for i, s in scores[0].items())


def test_lists_of_slices():
    t = pa.table({"x": pa.array([[1], [2, 3], [], [4]])}).slice(1, 3)
    size, flat = lm._ragged(t["x"])
    assert size.tolist() == [2, 0, 1] and flat.tolist() == [2, 3, 4]


def test_a_sweep_moves_every_customer():
    """60 customers of a dish, all at one table: one sweep spreads them, forty reach the exact mean number of tables."""
    n, dishes, d, w = 60, 3_000, 0.5, 2.0
    row = np.zeros(n + 2)
    row[0] = 1.0
    for i in range(n):  # scaled weights of t tables
        row[1:] = row[:-1] * w + np.maximum(i - np.arange(1, n + 2) * d, 0) * row[1:]
        row[0] = 0.0
        row /= row.sum()
    mean = (row * np.arange(n + 2)).sum()
    tables = lm.Tables(np.ones(dishes, np.int64), np.full(dishes, n, np.int64))
    one = tables.reseat(np.full(dishes, n), d, lambda rows, t: np.full(len(rows), w), np.arange(dishes), 1)
    assert one.sizes.sum() == n * dishes
    # a customer alone at a table has moved; where only some move, most of the dish stays at its first table
    assert one.count.mean() > 0.5 * mean
    for sweep in range(2, 45):
        one = one.reseat(np.full(dishes, n), d, lambda rows, t: np.full(len(rows), w), np.arange(dishes), sweep)
    assert abs(one.count.mean() - mean) < 0.03 * mean


def test_dishes_seated_alone_or_along_give_the_same(monkeypatch):
    rng = np.random.default_rng(0)
    n, key = np.r_[rng.integers(1, 200, 60), 900, 3], rng.integers(-2 ** 62, 2 ** 62, 62)
    found = []
    for along in (0, 10, 10 ** 9):
        monkeypatch.setattr(lm, "ALONG", along)
        tables = lm.Tables(np.ones(len(n), np.int64), n.copy())
        for sweep in range(3):
            tables = tables.reseat(n + sweep % 2, 0.5, lambda rows, t: 0.3 + 0.02 * t, key, sweep)
        found.append((tables.count.tolist(), tables.sizes.tolist()))
    assert found[0] == found[1] == found[2]


def test_large_rows_are_held_one_by_one(spark, tmp_path):
    """Rows of 8 MB in one file: no row group, which is written and read whole, holds more than three."""
    rows = spark.range(8, numPartitions=1).selectExpr("id", "transform(sequence(1, 1000000), i -> xxhash64(id, i)) AS x")
    kept = lm._kept(rows, str(tmp_path / "rows"))
    assert kept.count() == 8
    from pathlib import Path

    import pyarrow.parquet as pq
    groups = [g for f in Path(tmp_path / "rows").glob("*.parquet") for m in [pq.ParquetFile(f).metadata] for g in
              (m.row_group(i).num_rows for i in range(m.num_row_groups))]
    assert sum(groups) == 8 and max(groups) <= 3


def test_other_dishes_change_no_seating():
    """A dish that gains or loses customers is seated alike whoever stands beside it."""
    rng = np.random.default_rng(1)
    now, want, key = rng.integers(1, 12, 40), rng.integers(1, 12, 40), rng.integers(-2 ** 62, 2 ** 62, 40)

    def seated(at):
        t = lm.Tables(np.ones(len(at), np.int64), now[at]).reseat(want[at], 0.5, lambda rows, n: 0.5 + 0.1 * n, key[at], 3)
        return [p.tolist() for p in np.split(t.sizes, np.cumsum(t.count)[:-1])]

    assert seated(np.arange(40)) == [seated(np.array([i]))[0] for i in range(40)]
