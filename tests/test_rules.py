"""Golden micro-tables for order- and quirk-sensitive rules."""

from pyspark.sql import functions as F

from tidemark.functions import scalar as X
from tidemark.operators import clean as C
from tidemark.operators.bins import user_time_bins
from tidemark.operators.profile import classify_categoricals
from tidemark.operators.rank import topk_classes

DAY = 86_400_000


def test_churn_min(spark):
    rows = [  # user, ts, registration, page, level, gender, session, artist, song
        ("u1", 0 * DAY, 0, "NextSong", "free", "M", 1, "a", "s1"),
        ("u1", 1 * DAY, 0, "Submit Downgrade", "paid", "M", 1, None, None),
        ("u1", 2 * DAY, 0, "Submit Downgrade", "paid", "M", 2, None, None),
        ("u1", 30 * DAY, 0, "NextSong", "free", "M", 3, "b", "s2"),      # bin 2 (bin 1 missing)
        ("u1", 31 * DAY, 0, "Cancellation Confirmation", "free", "M", 3, None, None),
        ("u2", -3 * DAY, 0, "NextSong", "free", "F", 9, "a", "s1"),      # before registration
        ("", 0, 0, "NextSong", "free", "F", 9, "a", "s1"),               # empty key
        (None, 0, 0, "NextSong", "free", "F", 9, "a", "s1"),             # null key
    ]
    df = spark.createDataFrame(rows, "userId string, ts long, registration long, page string, level string, "
                                     "gender string, sessionId long, artist string, song string")
    out = {(r.UserId, r.UserTimeBin): r for r in user_time_bins(df, 14, pages=["NextSong"]).collect()}
    assert set(out) == {("u1", 0), ("u1", 2), ("u2", 0)}          # one row per (user, bin)
    assert out[("u1", 0)].PreviouslyDowngraded == 0 and out[("u1", 2)].PreviouslyDowngraded == 1
    assert out[("u1", 0)].WillChurnInNextBin == 0                # bin 1 is missing: not "next"
    assert out[("u1", 2)].WillChurnSoon == 1 and out[("u1", 2)].ChurnedInTimeBin == 1
    assert out[("u2", 0)].DaysRegisteredAtTimeBin == -3           # truncation toward zero
    assert out[("u1", 0)].ArtistsInTimeBin == 1                   # null artist not counted


def test_dense_rows_boundary(spark):
    df = spark.createDataFrame([(1, None, None), (2, 1.0, None), (3, float("nan"), 1.0)], "a int, b double, c double")
    assert sorted(r.a for r in C.keep_dense_rows(df, 1).collect()) == [2, 3]
    assert sorted(r.a for r in C.sparse_rows(df, 1).collect()) == [1]


def test_levels_with_null(spark):
    df = spark.createDataFrame([("x", 1, None), ("y", 2, None), (None, 1, "k")], "t string, n int, c string")
    r = {x.column_name: x for x in classify_categoricals(df, ["t", "n", "c"]).collect()}
    assert r["t"].n_levels == 3 and r["t"].kind == "multi"
    assert r["n"].kind == "binary_numeric" and r["c"].kind == "binary_text"


def test_code_digits_and_bins(spark):
    df = spark.createDataFrame([("14",), ("XX",), ("1X",), (None,)], "c string")
    got = [(r.w, r.l) for r in df.select(X.tens_digit("c").alias("w"), X.ones_digit("c").alias("l")).collect()]
    assert got == [(1, 4), (None, None), (None, None), (None, None)]
    b = spark.createDataFrame([(-1,), (-DAY * 15,), (DAY * 15,)], "d long").select(
        X.fixed_width_bin(F.col("d"), F.lit(0), 14).alias("b")).collect()
    assert [r.b for r in b] == [0, -1, 1]


def test_topk_ties_and_large_k(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],)], "s array<double>")
    r = df.select(topk_classes("s", 5).alias("t")).first().t
    assert [x.cls for x in r] == [2, 1, 0]
    assert abs(sum(x.prob for x in r) - 1.0) < 1e-12


def test_codes_to_null(spark):
    df = spark.createDataFrame([(1.0, "X"), (-1.0, "A"), (0.0, "")], "a double, b string")
    out = C.codes_to_null(df, {"a": C.parse_code_list_py("[-1,0]"), "b": C.parse_code_list_py("[X]")}).collect()
    assert [(r.a, r.b) for r in out] == [(1.0, None), (None, "A"), (None, "")]
    assert C.parse_code_list_py("[]") == [""]


def test_rename_header_and_carry_forward(spark):
    from tidemark.operators.state import carry_forward
    df = spark.createDataFrame([(1, "a", None), (2, "a", 5), (3, "a", None), (1, "b", None)], "t int, k string, v int")
    assert C.set_header(df, ["x", "y", "z"]).columns == ["x", "y", "z"]
    assert C.rename(df, {"v": "value"}).columns == ["t", "k", "value"]
    out = {(r.k, r.t): r.last_v for r in carry_forward(df, ["k"], ["t"], "v", "last_v").collect()}
    assert out == {("a", 1): None, ("a", 2): 5, ("a", 3): 5, ("b", 1): None}
    try:
        C.drop_columns(df, ["nope"])
        raise AssertionError("absent column must raise")
    except KeyError:
        pass


def test_label_name_check_and_expand(spark):
    from tidemark.plans.q_encode import expand_labels, label_name_check
    cats = spark.createDataFrame([(1, "related-1;request-0"), (2, "request-1;related-0"),
                                  (3, "related-2;request-1"), (3, "related-2;request-1")], "id long, categories string")
    r = label_name_check(cats, ["related", "request"]).first()
    assert (r.n_rows, r.n_mismatched) == (4, 1)
    msgs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "id long, message string")
    out = {x.id: (x.related, x.request) for x in expand_labels(msgs, cats).collect()}
    assert out == {1: (1, 0), 2: (1, 0), 3: (2, 1)}  # duplicate id-3 rows collapse; id 4 has no labels


def test_map_and_struct_lookup(spark):
    from tidemark.operators.lookup import map_lookup, struct_lookup
    df = spark.createDataFrame([(1,), (15,), (99,), (None,)], "c int")
    out = df.select(map_lookup("c", {1: "one", 15: "fifteen"}, "Unknown").alias("n"),
                    struct_lookup("c", {1: (40, 0), 15: (90, 1)}, ["decade", "movement"]).alias("s")).collect()
    assert [r.n for r in out] == ["one", "fifteen", "Unknown", "Unknown"]
    assert [(r.s.decade, r.s.movement) if r.s else None for r in out] == [(40, 0), (90, 1), None, None]
