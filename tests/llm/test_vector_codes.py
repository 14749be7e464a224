import numpy as np
import pytest

from tidemark.llm import vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string"


def brute(rows, parts, entries, rounds):
    kept = [(i, [int(np.floor(256 * float(np.float32(x)))) for x in v], y) for i, v, y, _ in rows
            if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted((i, v) for i, v, _ in kept if i is not None)
    width = len(first[0][1]) // parts
    kept = [x for x in kept if len(x[1]) == width * parts]
    cut = lambda v: [v[p * width:(p + 1) * width] for p in range(parts)]
    first = [(i, v) for i, v in first if len(v) == width * parts]
    books = [[cut(v)[p] for _, v in first[:entries]] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, y)), i) for i, y in enumerate(books[p]))

    for _ in range(rounds):
        found = [[near(p, x)[1] for p, x in enumerate(cut(v))] for _, v, _ in kept]
        for p in range(parts):
            for i in range(len(books[p])):
                own = [cut(v)[p] for (_, v, _), f in zip(kept, found) if f[p] == i]
                if own:
                    books[p][i] = [sum(x) // len(own) for x in zip(*own)]
    coded = [(i, [near(p, x) for p, x in enumerate(cut(v))], y) for i, v, y in kept]
    errors = {}
    for _, c, y in coded:
        errors[y] = errors.get(y, 0) + sum(d for d, _ in c)
    key = lambda x: (-1 if x is None else x)
    return sorted((key(i), "".join(f"{j:02x}" for _, j in c), sum(d for d, _ in c), errors[y]) for i, c, y in coded), books


def check(spark, rows, parts=4, entries=8, rounds=2):
    got, books = vector_codes.compress(spark.createDataFrame(rows, SCHEMA), parts, entries, rounds)
    want, own = brute(rows, parts, entries, rounds)
    key = lambda x: (-1 if x is None else x)
    assert sorted((key(r.vec_id), r.code, r.error, r.label_error) for r in got.collect() if r.code is not None) == want
    assert books.tolist() == own
    return got


def test_rounds_against_brute_force(spark):
    r = np.random.default_rng(2)
    check(spark, [(i, r.standard_normal(8).tolist(), int(i % 5) if i % 7 else None, "c") for i in range(200)])


def test_one_vector_and_one_label_hold_a_third(spark):
    rows = [(i, [0.5] * 8, 1, None) for i in range(100)] + [(500 + i, [float(i % 4), 1.0, -1.0, 0.0] * 2, i % 2, "") for i in range(200)]
    check(spark, rows)


def test_edges(spark):
    nan = float("nan")
    rows = [(3, [1.0] * 8, None, "a"), (1, None, 1, "a"), (2, [1.0, None] * 4, 1, "a"), (4, [nan] * 8, 1, "a"),
            (None, [-0.01, 2.0] * 4, None, "a"), (9, [4.0, 4.5] * 4, 7, None), (9, [4.0, 4.5] * 4, 7, None)]
    assert check(spark, rows).count() == 4
    # another length: kept, without code, adding nothing to its label's error
    odd = vector_codes.compress(spark.createDataFrame([*rows, (20, [1.0] * 4, 7, ""), (21, [], 3, "")], SCHEMA), 4, 8, 2)[0]
    assert {r.vec_id: (r.code, r.error, r.label_error) for r in odd.collect() if r.vec_id in (20, 21)} == {
        20: (None, None, 0), 21: (None, None, None)}
    none, books = vector_codes.compress(spark.createDataFrame(rows[1:4], SCHEMA), 4, 8, 2)
    assert none.count() == 0 and books.size == 0 and none.columns == ["vec_id", "code", "error", "label_error"]
    with pytest.raises(ValueError, match="equal parts"):
        vector_codes.compress(spark.createDataFrame([(0, [1.0] * 6, 1, "")], SCHEMA), 4, 8, 2)


def test_equal_average_search_is_exact():
    r = np.random.default_rng(3)
    books = r.integers(-20, 20, (3, 40, 4))
    books[:, 17] = books[:, 5]  # equal entries: the lower index wins
    books[1, :, 0] -= books[1].sum(1)  # all sums equal: nothing can be left out
    v = r.integers(-25, 25, (3000, 12))
    index, far = vector_codes.Codebooks(books).nearest(v)
    d = ((v.reshape(-1, 3, 1, 4) - books[None]) ** 2).sum(3)
    assert (index == d.argmin(2)).all() and (far == d.min(2)).all()
