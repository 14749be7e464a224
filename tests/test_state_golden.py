"""The window/carry-in form equals a brute-force sequential walk
written from the stated rules, on hand-made edge cases and random tables,
for any bucket width."""

import random

import pytest

from tidemark.operators.state import LOCK, SCREENSAVER, STARTUP, time_since_state

CH = {"startup": STARTUP, "locked": LOCK, "screensaver": SCREENSAVER}
SCHEMA = "seq long, Time long, LogHost string, Source string, UserName string, EventID int"


def brute(rows):
    """Rows in (Time, seq) order; per channel a dict host -> time that a
    marker sets and an off row clears; lookups by host, source, user[:-1]."""
    out = {}
    for ch, spec in CH.items():
        state = {}
        for r in sorted(rows, key=lambda r: (r[1], r[0])):
            seq, t, host, src, user, eid = r
            if eid in spec.on:
                v = t
                if host is not None:
                    state[host] = t
            elif eid in spec.off:
                v = None
                state.pop(host, None)
            else:
                v = None
                for k in (host, src, user[:-1] if isinstance(user, str) else None):
                    if k is not None and k in state:
                        v = t - state[k]
                        break
            out.setdefault(seq, {})[ch] = v
    return out


EDGE = [
    # same second: marker before the event (seq order) and after it
    (1, 100, "H1", None, None, 4800), (2, 100, "H1", None, None, 4688),
    (3, 200, "H2", None, None, 4688), (4, 200, "H2", None, None, 4800),
    # unlock without lock, lock twice then unlock
    (5, 300, "H3", None, None, 4801), (6, 310, "H3", None, None, 4800),
    (7, 320, "H3", None, None, 4800), (8, 330, "H3", None, None, 4688),
    (9, 340, "H3", None, None, 4801), (10, 350, "H3", None, None, 4688),
    # hit by second key only / third key only / null user
    (11, 400, "X1", "H1", None, 4688), (12, 410, "X2", None, "H1$", 4688),
    (13, 420, "X3", None, None, 4688), (14, 430, "X4", "nope", "Z", 4688),
    # host known (older) but Source more recent: host wins
    (15, 500, "H4", None, None, 4608), (16, 600, "H5", None, None, 4608),
    (17, 700, "H4", "H5", None, 4688),
    # screensaver on/off and a start-up much later (other buckets)
    (18, 800, "H6", None, None, 4802), (19, 90000, "H6", None, None, 4688),
    (20, 90010, "H6", None, None, 4803), (21, 90020, "H6", None, None, 4688),
    (22, 200000, "H6", "H4", "H1x", 4688),
]


def _check(spark, rows, bucket):
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["seq"]: r for r in time_since_state(df, CH, bucket_seconds=bucket).collect()}
    exp = brute(rows)
    for seq, e in exp.items():
        for ch, v in e.items():
            assert got[seq][f"time_since_{ch}"] == v, (seq, ch, got[seq], v)


@pytest.mark.parametrize("bucket", [1, 60, 3600, 10 ** 9])
def test_edge_cases(spark, bucket):
    _check(spark, EDGE, bucket)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_tables(spark, seed):
    rnd = random.Random(seed)
    hosts = [f"H{i}" for i in range(6)]
    rows = []
    for seq in range(600):
        eid = rnd.choice([4608, 4800, 4801, 4802, 4803, 4688, 4688, 4688, 4624])
        user = rnd.choice([None, rnd.choice(hosts) + "$", "U1"])
        rows.append((seq, rnd.randrange(0, 5000, 7), rnd.choice(hosts + [None]),
                     rnd.choice(hosts + [None, "S"]), user, eid))
    rows = [r for r in rows if r[2] is not None or r[5] == 4688]
    _check(spark, rows, rnd.choice([13, 500, 10 ** 6]))


def test_hot_host_third_of_rows(spark):
    """One host holds a third of all rows (the stand-in event log with every
    third user folded into one host): results equal the sequential walk,
    and the hot host is spread over many (key, hour) slices."""
    from pyspark.sql import functions as F
    from tests.conftest import SF001
    from tidemark.sources import testdata as td
    ev = td.win_events(spark, SF001).withColumn(
        "LogHost", F.when(F.col("seq") % 3 == 0, F.lit("HOT")).otherwise(F.col("LogHost")))
    rows = [tuple(r) for r in ev.select("seq", "Time", "LogHost", "Source", "UserName", "EventID").collect()]
    n = len(rows)
    hot = sum(1 for r in rows if r[2] == "HOT")
    assert hot * 3 >= n - 3
    slices = {}
    for r in rows:
        if r[2] == "HOT":
            slices[r[1] // 3600] = slices.get(r[1] // 3600, 0) + 1
    assert max(slices.values()) < 0.01 * n  # no slice near the hot key's size
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r["seq"]: r for r in time_since_state(df, CH, bucket_seconds=3600).collect()}
    exp = brute(rows)
    bad = [(s, ch) for s, e in exp.items() for ch, v in e.items() if got[s][f"time_since_{ch}"] != v]
    assert not bad, bad[:5]


def test_auto_bucket_width(spark):
    from tidemark.operators.state import choose_slices, default_keys
    df = spark.createDataFrame(EDGE, SCHEMA)
    assert choose_slices(df, default_keys(), target_rows=2)[0] < 3600
    assert choose_slices(df, default_keys()) == (3600, 0)
    a = {r.seq: tuple(r) for r in time_since_state(df, CH, bucket_seconds="auto").collect()}
    b = {r.seq: tuple(r) for r in time_since_state(df, CH, bucket_seconds=10 ** 9).collect()}
    assert a == b


def test_hot_host_within_one_second(spark):
    """All rows of a host carry one time: slices are cut on by row numbers, answers stay."""
    from tidemark.operators.state import choose_slices, default_keys
    ids = [4608, 4688, 4800, 4688, 4801, 4688, 4802, 4688, 4803, 4688]
    rows = [(i, 7200, "HOT", None, None, ids[i % 10] if i < 500 else 4688) for i in range(1000)]
    rows += [(1000 + i, 7200 + i % 3, f"H{i % 5}", "HOT", None, ids[i % 7]) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    width, step = choose_slices(df, default_keys(), target_rows=100)
    assert width == 1 and 1 <= step <= 200
    got = {r["seq"]: r for r in time_since_state(df, CH, bucket_seconds=width, seq_step=step).collect()}
    exp = brute(rows)
    assert [(s, c) for s, e in exp.items() for c, v in e.items() if got[s][f"time_since_{c}"] != v] == []


def test_wanted_rows_only(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(EDGE, SCHEMA)
    some = {r.seq: tuple(r) for r in time_since_state(df, CH, wanted=F.col("EventID") == 4688).collect()}
    every = {r.seq: tuple(r) for r in time_since_state(df, CH).collect() if r.EventID == 4688}
    assert some == every
