import hashlib

import numpy as np
import pytest

from tidemark.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, cluster string"


def brute(rows, k, rounds, dim):
    """The contract in plain Python integers."""
    kept = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v, _ in rows
            if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    cs = [v for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(cs))

    for _ in range(rounds):
        found = [near(v)[1] for _, v in kept]
        for j in range(len(cs)):
            own = [v for (_, v), f in zip(kept, found) if f == j]
            if own:
                cs[j] = [sum(x) // len(own) for x in zip(*own)]
    return sorted(((i if i is not None else -1), near(v)[1], near(v)[0]) for i, v in kept), cs


def check(spark, rows, k=8, rounds=10, dim=4):
    df = spark.createDataFrame(rows, SCHEMA)
    got = centroids.cluster(df, k=k, rounds=rounds, dim=dim).collect()
    want, cs = brute(rows, k, rounds, dim)
    assert sorted((r.vec_id if r.vec_id is not None else -1, r["cluster"], r.distance) for r in got) == want
    for r in got:
        assert r.centroid == cs[r["cluster"]]
        assert r.cluster_inertia == sum(d for _, c, d in want if c == r["cluster"])
        assert r.inertia == sum(d for _, _, d in want)
    return got


def test_rounds_against_brute_force(spark):
    r = np.random.default_rng(4)
    check(spark, [(i, (r.standard_normal(4) * 3).tolist(), "x") for i in range(300)])


def test_a_third_of_all_rows_equal_and_ties(spark):
    rows = [(i, [0.5, 0.5, 0.5, 0.5], None) for i in range(100)]
    rows += [(1000 + i, [float(i % 3), float(i % 2), 0.0, 1.0], "y") for i in range(200)]
    check(spark, rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0, 3.0, 4.0], "a"), (1, None, "a"), (2, [1.0, None, 3.0, 4.0], "a"), (3, [nan, 2.0, 3.0, 4.0], "a"),
            (4, [1.0, 2.0, 3.0], "a"), (5, [], "a"), (6, [-inf, 2.0, 3.0, 4.0], "a"), (None, [9.0, 9.0, 9.0, 9.0], None),
            (7, [-1.0, -2.0, -0.3, 0.0], None), (7, [-1.0, -2.0, -0.3, 0.0], None)]
    assert len(check(spark, rows)) == 4
    assert centroids.cluster(spark.createDataFrame(rows[1:7], SCHEMA), dim=4).count() == 0
    assert centroids.cluster(spark.createDataFrame([], SCHEMA)).columns == [
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]


def test_beyond_the_exact_range_is_an_error(spark):
    with pytest.raises(Exception, match="beyond"):
        centroids.cluster(spark.createDataFrame([(0, [1e9, 0.0, 0.0, 0.0], "a")], SCHEMA), dim=4).collect()


@pytest.mark.parametrize("spread", [10, 1 << 25])
def test_tournament_winner_is_the_nearest(spread):
    r = np.random.default_rng(1)
    cs = r.integers(-spread, spread, (9, 6))
    cs[4] = cs[2]
    v = np.concatenate([r.integers(-spread, spread, (2000, 6)), cs, (cs[:1] + cs[1:2]) // 2])
    told = centroids.Tournament(cs)
    far = ((v[:, None].astype(object) - cs[None].astype(object)) ** 2).sum(2)
    assert told.winners(v).tolist() == [min(range(9), key=lambda j: (row[j], j)) for row in far]
    assert told.distances(v, told.winners(v)).tolist() == [min(row) for row in far]
