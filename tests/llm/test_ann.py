import numpy as np
import pytest

from tidemark.llm import ann

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, queries, k):
    ids, v = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float32).astype(float)
    out = {}
    for q, x in queries:
        s = v @ np.array(x, np.float32).astype(float)
        out[q] = [int(ids[i]) for i in np.lexsort((ids, -s)) if ids[i] != q][:k]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append(r.vec_id)
    return out


def clustered(n=3000, dim=24, seed=1):
    r = np.random.default_rng(seed)
    centres = r.standard_normal((40, dim)) * 2
    v = centres[r.integers(0, 40, n)] + r.standard_normal((n, dim)) * 0.5
    v[: n // 2] *= r.uniform(0.5, 2, (n // 2, 1))  # lengths differ
    return [(i, x.tolist()) for i, x in enumerate(v)]


@pytest.mark.parametrize("cell_rows", [100_000, 300])
def test_recall_against_brute_force(spark, cell_rows):
    rows = clustered()
    queries = [x for x in rows if x[0] % 50 == 0]
    got = answers(ann.search(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(queries, SCHEMA), 20, cell_rows=cell_rows))
    want = brute(rows, queries, 20)
    assert set(got) == set(want)
    assert np.mean([len(set(got[q]) & set(want[q])) / 20 for q in want]) >= 0.95


def test_query_recall(spark):
    from tidemark.llm.queries import op9_ann
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute(rows, [r for r in rows if r[0] % 20 == 0], 20)
    got = answers(op9_ann(spark, sf))
    assert np.mean([len(set(got[q]) & set(want[q])) / 20 for q in want]) >= 0.9


def test_one_very_common_vector(spark):
    rows = [(i, [1.0, 0.0, 2.0]) for i in range(2000)] + [(5000 + i, [float(i), 1.0, -1.0]) for i in range(50)]
    queries = [x for x in rows if x[0] % 20 == 0]
    got = answers(ann.search(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(queries, SCHEMA), 20, cell_rows=20))
    want = brute(rows, queries, 20)
    assert got[0] == want[0] and got[40] == want[40]
    assert sum(got[q] == want[q] for q in want) >= 0.9 * len(want)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [1.0, inf]), (6, [None, 1.0]), (7, []),
            (None, [1.0, 1.0]), (8, [1.0, 2.0]), (8, [1.0, 2.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in ann.search(df, df, 20).collect()}
    assert got == {(0, 1): (8, 5.0), (0, 2): (1, 4.0), (1, 1): (0, 4.0), (1, 2): (8, 4.0), (8, 1): (0, 5.0), (8, 2): (1, 4.0)}
    assert ann.search(df.limit(0), df, 5).count() == 0
    assert ann.search(df, df.limit(0), 5).count() == 0


def test_chi_square():
    assert abs(ann.chi_square(np.array([7.344]))[0] - 0.5) < 1e-3  # median for 8 degrees of freedom
    assert abs(ann.stop_ratio(0.95) - 15.507) < 1e-2


def test_other_lengths_take_no_part(spark):
    rows = [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (2, [1.0]), (3, [1.0, 2.0, 3.0]), (4, [0.5, 0.5])]
    got = answers(ann.search(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(rows, SCHEMA), 20))
    assert got == {0: [1, 4], 1: [0, 4], 4: [0, 1]}


def test_only_busy_cells_are_copied(spark, monkeypatch):
    rows = clustered(1200)
    near = [(10_000 + i, rows[0][1]) for i in range(3)] + [(20_000 + i, (np.array(rows[7][1]) + i * 1e-3).tolist()) for i in range(200)]
    monkeypatch.setattr(ann, "BLOCK", 4)
    got = answers(ann.search(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(near, SCHEMA), 10, cell_rows=150))
    want = brute(rows, near, 10)
    assert np.mean([len(set(got[q]) & set(want[q])) / 10 for q in want]) >= 0.95
