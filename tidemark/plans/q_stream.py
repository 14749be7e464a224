"""Streaming queries (G01-G03), run with an available-now trigger into file
sinks under the shared checkpoint folder and read back as DataFrames."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline
from pyspark.sql import functions as F
from pyspark.ml.feature import VectorAssembler

from tidemark.operators import encode as E
from tidemark.operators import model as ML
from tidemark.functions.scalar import contains_flag, log1p
from tidemark.operators.sample import hash_split
from tidemark.plans.registry import register
from tidemark.sources import testdata as td
from tidemark.plans.q_state import CHANNELS, HOST_STATE_SQL
from tidemark.session import scratch_table_path
from tidemark.streaming.stream import file_stream, host_state_batches, run_to_files, score_stream, windowed_counts

#: Time slices that the events are written in, and files of a slice.
SLICES, FILES = 4, 2


def _events_stream(spark, sf_dir, jitter_seconds: int = 0):
    """The events as they would arrive: slices of time, written one after the other, each a micro-batch. With
    jitter an event arrives up to so much later than it happened, and the slices overlap in event time."""
    events = td.table(spark, sf_dir, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    if jitter_seconds:
        micros = micros + F.pmod(F.xxhash64("event_id"), F.lit(jitter_seconds)) * 1_000_000
    cuts = events.agg(F.percentile_approx(micros, [i / SLICES for i in range(1, SLICES)]).alias("c")).first()["c"]
    path = scratch_table_path(spark, f"streams/events-{uuid.uuid4().hex}")
    for low, high in zip([None, *cuts], [*cuts, None]):
        part = events
        if low is not None:
            part = part.where(micros >= low)
        if high is not None:
            part = part.where(micros < high)
        part.repartition(FILES).write.mode("append").parquet(path)
    return file_stream(spark, path, events.schema, max_files_per_trigger=FILES)


def _run(name: str) -> str:
    """A query computes its answer from the tables as they are now: each run is a stream of its own."""
    return f"{name}-{uuid.uuid4().hex}"


@register("stream_window_counts", """
WITH w AS (SELECT date_trunc('day', ts) AS window_start, user_id FROM events)
SELECT CAST(epoch(window_start) AS BIGINT) AS window_start_s,
       CAST(epoch(window_start + INTERVAL 1 day) AS BIGINT) AS window_end_s, user_id, count(*) AS n FROM w
GROUP BY ALL
HAVING window_start + INTERVAL 1 day <= (SELECT max(ts) - INTERVAL 1 hour FROM events)
""")
def q_stream_window_counts(spark, sf_dir):
    """Events per user per day, watermark 1 hour, append mode (a window
    is emitted once the watermark passes its end)."""
    s = windowed_counts(_events_stream(spark, sf_dir), "ts", ["user_id"], "1 day", "1 hour")
    return spark.read.parquet(run_to_files(s, _run("window_counts")))


@register("stream_host_state", f"""
WITH {td.WIN_SQL},
su AS (SELECT LogHost AS k, seq AS s, Time AS t FROM win WHERE EventID = 4608),
lk AS (SELECT LogHost AS k, seq AS s, Time AS t, EventID = 4800 AS on_ FROM win WHERE EventID IN (4800, 4801)),
sv AS (SELECT LogHost AS k, seq AS s, Time AS t, EventID = 4802 AS on_ FROM win WHERE EventID IN (4802, 4803)),
j AS (SELECT e.*, a.t AS a, b.t AS b, b.on_ AS bon, c.t AS c, c.on_ AS con FROM win e
      ASOF LEFT JOIN su a ON e.LogHost = a.k AND e.seq > a.s
      ASOF LEFT JOIN lk b ON e.LogHost = b.k AND e.seq > b.s
      ASOF LEFT JOIN sv c ON e.LogHost = c.k AND e.seq > c.s)
SELECT seq, LogHost, Time, EventID,
  CASE WHEN EventID = 4608 THEN Time WHEN a IS NOT NULL THEN Time - a END AS time_since_startup,
  CASE WHEN EventID = 4800 THEN Time WHEN EventID = 4801 THEN NULL WHEN bon THEN Time - b END AS time_since_locked,
  CASE WHEN EventID = 4802 THEN Time WHEN EventID = 4803 THEN NULL WHEN con THEN Time - c END AS time_since_screensaver
FROM j
""")
def q_stream_host_state(spark, sf_dir):
    """Host state carried across micro-batches (primary key only)."""
    w = td.win_events_from(_events_stream(spark, sf_dir))
    out = spark.read.parquet(host_state_batches(w, CHANNELS, keys=[F.col("LogHost")], name=_run("host_state")))
    return out.select("seq", "LogHost", "Time", "EventID", "time_since_startup", "time_since_locked", "time_since_screensaver")


@register("stream_scored_orders", f"""
WITH {td.CENSUS_SQL}
SELECT o_orderkey, CAST(contains(income, '>50K') AS DOUBLE) AS label, 0 AS differs FROM census
""")
def q_stream_scored_orders(spark, sf_dir):
    """A pipeline fitted on batch rows (scaling and levels fitted there
    too) scores the orders stream joined with the static customers: every
    order, its label, and whether its streamed prediction or probability
    differs from the batch one (or is missing)."""
    cust = td.table(spark, sf_dir, "customer")
    batch = td.census(spark, sf_dir)
    logged = batch.withColumns({c: log1p(c) for c in td.CENSUS_SKEWED})
    mm = E.fit_min_max(logged, td.CENSUS_NUMERIC)
    levels = E.fit_levels(batch, td.CENSUS_CATEGORICAL)

    def prep(df):
        x = df.withColumns({c: log1p(c) for c in td.CENSUS_SKEWED})
        x = E.one_hot(E.min_max(x, td.CENSUS_NUMERIC, mm), td.CENSUS_CATEGORICAL, levels)
        return x.withColumn("label", contains_flag("income", ">50K").cast("double"))

    train = hash_split(prep(batch), "o_orderkey", 0.2, 0).filter("split = 'train'")
    feats = [c for c in prep(batch).columns if c not in ("o_orderkey", "income", "label")]
    model = Pipeline(stages=[VectorAssembler(inputCols=feats, outputCol="features"),
                             ML.make_classifier("lr", maxIter=20)]).fit(train)
    orders = file_stream(spark, f"{sf_dir.rstrip('/')}/orders.parquet", td.table(spark, sf_dir, "orders").schema)
    scored = score_stream(model, prep(td.census_from(orders, cust))).select("o_orderkey", "label", "prediction", "probability")
    out = spark.read.parquet(run_to_files(scored, _run("scored_orders")))
    again = model.transform(prep(batch)).select("o_orderkey", F.struct("prediction", ML.to_array("probability").alias("p")).alias("batch"))
    same = F.struct("prediction", ML.to_array("probability").alias("p")).eqNullSafe(F.col("batch"))
    return out.join(again, "o_orderkey", "left").select("o_orderkey", "label", (~same).cast("int").alias("differs"))


@register("stream_host_state_all_keys", HOST_STATE_SQL)
def q_stream_host_state_all_keys(spark, sf_dir):
    """G03 with the three-key priority: micro-batches of the batch operator
    seeded with the previous batch's per-host state (same answer as the
    batch query for in-order input)."""
    from tidemark.functions.scalar import flag
    w = td.win_events_from(_events_stream(spark, sf_dir))
    out = spark.read.parquet(host_state_batches(w, CHANNELS, name=_run("host_state_all_keys")))
    return out.select(
        "seq", "Time", "EventID", "LogHost", "Source", "UserName", "ProcessName", "ParentProcessName",
        "time_since_startup", "time_since_locked", "time_since_screensaver",
        flag(F.col("time_since_startup") <= 60).alias("near_startup"),
        flag(F.col("time_since_locked") > 0).alias("is_locked"),
        flag(F.col("time_since_screensaver") > 0).alias("is_screensaver"))


#: Largest delay of an event's arrival in the shuffled stream.
JITTER_S = 2 * 86400


@register("stream_host_state_shuffled", HOST_STATE_SQL)
def q_stream_host_state_shuffled(spark, sf_dir):
    """G03 for events out of order: batches overlap in event time by up to two days, rows are held
    back until the watermark has passed them, and the stream is stopped and resumed by name between
    two runs; the answer is the batch one."""
    from tidemark.functions.scalar import flag
    name = _run("host_state_shuffled")
    w = td.win_events_from(_events_stream(spark, sf_dir, JITTER_S))
    for _ in range(2):  # the second run resumes: nothing is read again, open rows stay as they are
        folder = host_state_batches(w, CHANNELS, delay_seconds=JITTER_S, name=name)
    out = spark.read.parquet(folder)
    return out.select(
        "seq", "Time", "EventID", "LogHost", "Source", "UserName", "ProcessName", "ParentProcessName",
        "time_since_startup", "time_since_locked", "time_since_screensaver",
        flag(F.col("time_since_startup") <= 60).alias("near_startup"),
        flag(F.col("time_since_locked") > 0).alias("is_locked"),
        flag(F.col("time_since_screensaver") > 0).alias("is_screensaver"))
