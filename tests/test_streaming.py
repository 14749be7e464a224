"""Streaming: host state carried across micro-batches equals the batch
answer; a row older than the watermark is dropped."""

import os
import tempfile

from tests.conftest import SF0001
from tidemark.sources import testdata as td
from tidemark.streaming.stream import file_stream, run_to_files


def test_stopped_stream_resumes_by_name(spark):
    """One batch, a stop, more input, the same name: the run goes on from its state and
    gives the batch answer; only the last two state versions stay."""
    import uuid

    from tidemark.operators.state import time_since_state
    from tidemark.plans.q_state import CHANNELS
    from tidemark.streaming.stream import host_state_batches, stream_folder
    ev = td.win_events(spark, SF0001)
    pdf = ev.toPandas().sort_values(["Time", "seq"])
    d = tempfile.mkdtemp(prefix="tidemark-stream-resume-")
    name, cuts = f"resumed-{uuid.uuid4().hex}", [int(len(pdf) * i / 4) for i in range(5)]
    for k in range(4):
        pdf.iloc[cuts[k]:cuts[k + 1]].to_parquet(os.path.join(d, f"part-{k}.parquet"), index=False)
        folder = host_state_batches(file_stream(spark, d, ev.schema), CHANNELS, name=name)
    out = spark.read.parquet(folder)
    assert out.where("batch >= 0").select("batch").distinct().count() == 4
    got = {r["seq"]: r for r in out.collect()}
    exp = {r["seq"]: r for r in time_since_state(ev, CHANNELS).collect()}
    assert set(got) == set(exp)
    assert not [s for s in exp if any(got[s][f"time_since_{c}"] != exp[s][f"time_since_{c}"] for c in CHANNELS)]
    assert sorted(os.listdir(stream_folder(spark, name).replace("file:", "") + "/state")) == ["v=000000000002", "v=000000000003"]


def test_all_keys_across_batches_equals_batch(spark):
    from tidemark.operators.state import time_since_state
    from tidemark.plans.q_state import CHANNELS
    from tidemark.streaming.stream import host_state_batches, stream_facts
    ev = td.win_events(spark, SF0001)
    pdf = ev.toPandas().sort_values(["Time", "seq"])
    d = tempfile.mkdtemp(prefix="tidemark-stream-all-")
    cuts = [0, int(len(pdf) * 0.3), int(len(pdf) * 0.7), len(pdf)]
    for k in range(3):
        pdf.iloc[cuts[k]:cuts[k + 1]].to_parquet(os.path.join(d, f"part-{k}.parquet"), index=False)
    late = pdf.iloc[[5]].copy()
    late["seq"] = 10 ** 9
    late["Time"] = int(pdf["Time"].max()) - 10 * 3600
    import pyarrow as pa
    import pyarrow.parquet as pq
    schema = pq.read_schema(os.path.join(d, "part-0.parquet")).remove_metadata()
    pq.write_table(pa.Table.from_pandas(late, schema=schema, preserve_index=False),
                   os.path.join(d, "part-3.parquet"))
    out = spark.read.parquet(host_state_batches(file_stream(spark, d, ev.schema), CHANNELS, name=os.path.basename(d),
                                                bucket_seconds=7200))
    assert 10 ** 9 not in {r["seq"] for r in out.collect()} and stream_facts(spark, os.path.basename(d)).first()["late_rows"] == 1
    got = {r["seq"]: r for r in out.collect()}
    assert 10 ** 9 not in got
    exp = {r["seq"]: r for r in time_since_state(ev, CHANNELS).collect()}
    assert set(got) == set(exp)
    cols = [f"time_since_{c}" for c in CHANNELS]
    bad = [s for s in exp if any(got[s][c] != exp[s][c] for c in cols)]
    assert not bad, bad[:5]


SMALL = "seq long, Time long, EventID int, LogHost string, Source string, UserName string"


def _feed(spark, rows, batches, name, delay, stop=True):
    """Host state of ``rows`` (seq, Time, EventID, host) written in ``batches`` (lists of positions); a run for each if ``stop``."""
    from tidemark.plans.q_state import CHANNELS
    from tidemark.streaming.stream import host_state_batches
    d = tempfile.mkdtemp(prefix="tidemark-stream-shuffled-")
    df = lambda part: spark.createDataFrame([(s, t, e, h, None, None) for s, t, e, h in part], SMALL)
    for b in batches:
        df([rows[i] for i in b]).coalesce(1).write.mode("append").parquet(d)
        if stop:
            folder = host_state_batches(file_stream(spark, d, df([]).schema), CHANNELS, name=name, delay_seconds=delay)
    if not stop:
        folder = host_state_batches(file_stream(spark, d, df([]).schema), CHANNELS, name=name, delay_seconds=delay)
    want = time_since(spark, df(rows))
    return {r.seq: r for r in spark.read.parquet(folder).collect()}, want, folder


def time_since(spark, df):
    from tidemark.operators.state import time_since_state
    from tidemark.plans.q_state import CHANNELS
    return {r.seq: r for r in time_since_state(df, CHANNELS).collect()}


def _same(got, want):
    return set(got) == set(want) and not [s for s in want for c in ("startup", "locked", "screensaver")
                                          if got[s][f"time_since_{c}"] != want[s][f"time_since_{c}"]]


def test_a_row_before_a_lock_that_arrived_earlier_has_no_negative_time(spark):
    rows = [(0, 5000, 4800, "h"), (1, 3000, 4688, "h"), (2, 5600, 4688, "h")]
    got, want, _ = _feed(spark, rows, [[0], [1], [2]], f"negative-{os.urandom(4).hex()}", 3600)
    assert _same(got, want) and got[1].time_since_locked is None and got[2].time_since_locked == 600


def test_shuffled_arrival_inside_the_delay_equals_batch_across_restarts(spark):
    import random
    r = random.Random(8)
    rows = [(i, i * 40 + r.randint(0, 39), r.choice([4608, 4800, 4801, 4802, 4803, 4688, 4688, 4688]), r.choice(["a", "a", "b", "c"]))
            for i in range(240)]
    order = sorted(range(240), key=lambda i: rows[i][1] + r.randint(0, 1999))
    batches = [order[k:k + 40] for k in range(0, 240, 40)]
    for stop in (True, False):
        got, want, folder = _feed(spark, rows, batches, f"shuffled-{os.urandom(4).hex()}", 2000, stop)
        assert _same(got, want)
    per = spark.read.parquet(folder).groupBy("batch").agg({"Time": "max"}).collect()
    assert len(per) > 3 and any(x.batch == -1 for x in per)


def test_open_rows_are_answered_again_and_late_rows_counted(spark):
    from tidemark.streaming.stream import stream_facts
    name = f"open-{os.urandom(4).hex()}"
    rows = [(0, 1000, 4688, "h"), (1, 900, 4800, "h"), (2, 9000, 4688, "h"), (3, 100, 4688, "h")]
    got, want, _ = _feed(spark, rows, [[0], [1], [2], [3]], name, 3600)
    del want[3]  # 100 is below the watermark 5400
    assert _same(got, want) and got[0].time_since_locked == 100
    assert stream_facts(spark, name).first()["late_rows"] == 1


def test_windowed_counts_drop_late_rows(spark):
    from pyspark.sql import functions as F
    from tidemark.streaming.stream import windowed_counts
    ev = spark.read.parquet(f"{SF0001}/events.parquet")
    import pyarrow as pa
    import pyarrow.parquet as pq
    schema = pq.read_schema(f"{SF0001}/events.parquet").remove_metadata()

    def write(frame, name):
        pq.write_table(pa.Table.from_pandas(frame, schema=schema, preserve_index=False), os.path.join(d, name))

    pdf = pq.read_table(f"{SF0001}/events.parquet").to_pandas().sort_values(["ts", "event_id"])
    d = tempfile.mkdtemp(prefix="tidemark-stream-win-")
    half = len(pdf) // 2
    write(pdf.iloc[:half], "part-0.parquet")
    write(pdf.iloc[half:], "part-1.parquet")
    late = pdf.iloc[[0]].copy()
    late["event_id"] = 10 ** 9  # same user and early timestamp, arriving last
    write(late, "part-2.parquet")
    out = spark.read.parquet(run_to_files(windowed_counts(file_stream(spark, d, ev.schema), "ts", ["user_id"],
                                                          "1 day", "1 hour"), os.path.basename(d)))
    got = {(r.window_start_s, r.user_id): r.n for r in out.collect()}
    # batch answer over the in-order rows, windows closed by the final watermark
    b = (ev.withColumn("d", F.floor(F.unix_timestamp("ts") / 86400) * 86400)
         .groupBy("d", "user_id").count().collect())
    wm = int(pdf["ts"].max().timestamp()) - 3600
    exp = {(r.d, r.user_id): r["count"] for r in b if r.d + 86400 <= wm}
    assert got == exp
