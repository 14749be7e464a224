"""Structured Streaming forms of the batch operators.

The reference has no streaming; these are the natural streaming shapes of
its batch work: scoring new rows with a fitted pipeline (G01), per-entity
counts in tumbling event-time windows with a watermark (G02), and the
host start-up / lock / screensaver state carried across micro-batches (G03:
``host_state_batches``, the batch state join as Spark jobs per micro-batch).
Sinks are files under the shared checkpoint folder, in a folder of the stream's
name: a run with the same name (and the same shared folder) goes on where the
last one stopped, and executors can be lost at any time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalar import epoch_micros
from tidemark.session import checkpoint_dir


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int = 1) -> DataFrame:
    """A file source over a folder or one file. The path is given as a pattern that
    only it matches: the source refuses the name of a single file."""
    path = path.rstrip("/")
    path = path[:-1] + f"[{path[-1]}]"
    return (spark.readStream.schema(schema).format(fmt)
            .option("maxFilesPerTrigger", max_files_per_trigger).load(path))


def stream_folder(spark: SparkSession, name: str) -> str:
    """The folder of the stream ``name``: below ``spark.checkpoint.dir`` as it is set, so
    that a later session finds it; else below this session's own checkpoint folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or checkpoint_dir(spark)
    return f"{shared.rstrip('/')}/streams/{name}"


def run_to_files(df: DataFrame, name: str, mode: str = "append", fmt: str = "parquet",
                 base: str | None = None) -> str:
    """Run a stream until the input available now is consumed; files sink +
    checkpoint in the stream's folder; input that an earlier run of this name
    has consumed is not read again. Returns the output path."""
    root = base or stream_folder(df.sparkSession, name)
    out, ck = f"{root}/out", f"{root}/checkpoint"
    q = (df.writeStream.format(fmt).option("path", out).option("checkpointLocation", ck)
         .outputMode(mode).trigger(availableNow=True).start())
    q.awaitTermination()
    return out


def score_stream(model, stream: DataFrame) -> DataFrame:
    """The same fitted PipelineModel scores batch and stream input."""
    return model.transform(stream)


def windowed_counts(stream: DataFrame, ts: str, keys: list[str], window: str, delay: str) -> DataFrame:
    """Rows per key per tumbling window; rows later than the watermark
    are dropped and a window is emitted once the watermark passes its end.

    A TIMESTAMP_NTZ event time is turned into an instant from its epoch
    micros (no session zone involved); window bounds are reported as epoch
    seconds."""
    et = stream.schema[ts].dataType
    col = F.timestamp_micros(epoch_micros(ts)) if isinstance(et, T.TimestampNTZType) else F.col(ts)
    return (stream.withColumn("_et", col).withWatermark("_et", delay)
            .groupBy(F.window("_et", window), *keys).agg(F.count(F.lit(1)).alias("n"))
            .select(F.unix_seconds(F.col("window.start")).alias("window_start_s"),
                    F.unix_seconds(F.col("window.end")).alias("window_end_s"), *keys, "n"))


# ------------------------------------------------------------------ G03

#: Partition of the answers to rows that are still inside the delay; every run writes it anew.
OPEN_BATCH = -1


def host_state_batches(stream: DataFrame, channels, *, delay_seconds: int = 3600,
                       bucket_seconds: int | str = "auto", keys: Sequence[Column] | None = None,
                       name: str = "host_state_all_keys", base: str | None = None, close: bool = True) -> str:
    """G03 as Spark jobs per micro-batch, with the full three-key priority or the given ``keys``,
    for rows that arrive in any order inside ``delay_seconds``.

    The watermark is the latest event time seen minus the delay. Rows at or
    above it are held back in a table; once it has passed them they are released
    in event order, so a row is answered when no earlier marker can come any
    more, and rows that arrive shuffled give the batch answer. A released set is
    later in time than all that went before: the batch operator
    ``time_since_state`` runs on it, seeded with the per-host state that the
    earlier ones left (every key sees every host's state, hot hosts are split
    by time bucket as in batch). A row below the watermark of the batches
    before its own comes too late: it is dropped and counted (``stream_facts``).

    State, held rows and answers are written per batch id under the shared
    checkpoint folder with overwrite, so a retried batch rewrites the same files
    (idempotent, survives executor or driver loss together with the stream
    checkpoint). Of the versions only the last two are kept: the one a batch
    starts from and the one it leaves. With ``close`` a run ends by answering the
    rows still held, as if no more were to come, in the partition
    ``OPEN_BATCH``; they stay held, and the next run empties that partition and
    goes on. Returns the output folder (partitioned by batch)."""
    from tidemark.operators.state import state_table, time_since_state
    spark = stream.sparkSession
    root = base or stream_folder(spark, name)
    out_dir, ck = f"{root}/out", f"{root}/checkpoint"

    def answer(rows: DataFrame, state: DataFrame | None, b: int) -> None:
        res = time_since_state(rows, channels, bucket_seconds=bucket_seconds, keys=keys, initial=state)
        res.write.mode("overwrite").parquet(f"{out_dir}/batch={b:012d}" if b >= 0 else f"{out_dir}/batch={b}")

    def run(batch: DataFrame, b: int) -> None:
        held = state = seen = None
        late = 0
        if b > 0:
            old = _version(root, b - 1)
            held, state = spark.read.schema(batch.schema).parquet(f"{old}/held"), spark.read.parquet(f"{old}/state")
            facts = spark.read.parquet(f"{old}/facts").first()
            seen, late = facts["max_time"], facts["late_rows"]
        batch = batch.persist()
        try:
            new = batch.agg(F.max("Time").cast("long").alias("m"), *([] if seen is None else [
                F.sum((F.col("Time") < seen - delay_seconds).cast("long")).alias("late")])).first()
            rows = batch if seen is None else batch.where(F.col("Time") >= seen - delay_seconds)
            late += 0 if seen is None else new["late"] or 0
            seen = max((v for v in (new["m"], seen) if v is not None), default=None)
            if held is not None:
                rows = rows.unionByName(held)
            ready = F.lit(False) if seen is None else F.coalesce(F.col("Time") < seen - delay_seconds, F.lit(False))
            path = _version(root, b)
            rows.where(~ready).write.mode("overwrite").parquet(f"{path}/held")
            released = rows.where(ready).persist()
            try:
                answer(released, state, b)
                state_table(released, channels, initial=state).write.mode("overwrite").parquet(f"{path}/state")
            finally:
                released.unpersist()
            spark.createDataFrame([(b, seen, late)], "batch long, max_time long, late_rows long").write.mode("overwrite").parquet(f"{path}/facts")
            if b >= 2:
                _forget(spark, _version(root, b - 2))
        finally:
            batch.unpersist()

    last = _last_version(spark, root)
    if last is not None:  # answers to open rows of an earlier run are not final
        held = spark.read.schema(stream.schema).parquet(f"{_version(root, last)}/held")
        answer(held.limit(0), None, OPEN_BATCH)
    q = (stream.writeStream.foreachBatch(run).option("checkpointLocation", ck)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    last = _last_version(spark, root)
    if close and last is not None:
        path = _version(root, last)
        answer(spark.read.schema(stream.schema).parquet(f"{path}/held"), spark.read.parquet(f"{path}/state"), OPEN_BATCH)
    return out_dir


def stream_facts(spark: SparkSession, name: str, base: str | None = None) -> DataFrame:
    """Latest batch, latest event time and dropped late rows of a ``host_state_batches`` stream."""
    root = base or stream_folder(spark, name)
    last = _last_version(spark, root)
    if last is None:
        return spark.createDataFrame([], "batch long, max_time long, late_rows long")
    return spark.read.parquet(f"{_version(root, last)}/facts")


def _version(root: str, b: int) -> str:
    return f"{root}/state/v={b:012d}"


def _last_version(spark: SparkSession, root: str) -> int | None:
    """The latest batch whose version is written whole (its facts come last)."""
    found = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/state/v=*/facts/_SUCCESS")
    hits = found.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(found)
    return max((int(h.getPath().getParent().getParent().getName()[2:]) for h in hits or []), default=None)


def _forget(spark: SparkSession, path: str) -> None:
    old = spark._jvm.org.apache.hadoop.fs.Path(path)
    old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
