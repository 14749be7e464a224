"""Host state carried across an event stream (J09, J10, W03, F16 parts).

The reference walks the rows in file order with a mutable dict per marker
kind: a start-up (or lock / screensaver-on) row stores its time under its
``LogHost``, an off row removes it, and every other row asks, in priority
order, whether its ``LogHost``, its ``Source`` or its ``UserName`` minus the
last character currently has a stored time (``time - stored``). Marker rows
return their own absolute time, off rows null.

Spark form (no UDF, no per-row Python, no cross join):

1. every row becomes up to three *lookup* rows ``(key, rank)`` (one per
   non-null key); marker rows become one *marker* row keyed by ``LogHost``
   carrying, per channel, one long (marker time if it turns the state on, a
   sentinel if it clears it) - state is keyed by host name only, so all
   three ranks look into the same namespace;
2. lookups of hosts that have a marker, and markers, are unioned and cut into ``(key, time bucket)``
   slices; one Window operator ordered by ``(t, seq)`` gives, per row, the
   last marker strictly before it in the slice;
3. the state entering each slice (the carry-in) comes from a window over
   the small ``(key, bucket) -> final marker state`` table (markers only,
   plus the slices the lookups touch) ordered by bucket;
4. per original row the lowest rank whose state is *on* wins (``min_by``),
   and the answer is joined back on the row id.

A host holding a third of all rows is split across its time buckets, so no
single task gets the hot key; the carry-in table has at most one row per
(key, bucket) present in the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalar import all_but_last


@dataclass(frozen=True)
class Channel:
    """A marker kind: rows with ``on`` ids set the state, ``off`` ids clear it."""
    on: Sequence[int]
    off: Sequence[int] = ()


# Marker event ids of the three states the reference tracks.
STARTUP = Channel(on=(4608,))
LOCK = Channel(on=(4800,), off=(4801,))
SCREENSAVER = Channel(on=(4802,), off=(4803,))


def default_keys(host: str = "LogHost", source: str = "Source", user: str = "UserName") -> list[Column]:
    """Lookup keys in priority order: host, source, user name minus its last
    character."""
    return [F.col(host), F.col(source), all_but_last(F.col(user))]


CLEARED = -(2 ** 63)  # state value of an off marker (no time can equal it)


def choose_slices(events: DataFrame, keys: Sequence[Column], time: str = "Time", seq: str = "seq",
                  target_rows: int = 2_000_000, start: int = 3600) -> tuple[int, int]:
    """Slices for ``time_since_state`` so that no (key, slice) holds much more
    than ``target_rows`` rows: the width in seconds, and how many row numbers a
    slice spans where one second is still too much for it (0: not cut by them).

    One pass counts rows per (key, hour) and the widest span of row numbers in
    a second, over all lookup keys (partial aggregation map-side); only the
    maxima reach the driver. Answers do not depend on the slices."""
    arr = F.array(*[k.cast("string") for k in keys])
    looked = (events.select(F.explode(arr).alias("k"), F.floor(F.col(time) / start).alias("b"), F.col(time).alias("t"),
                            F.col(seq).alias("s")).filter(F.col("k").isNotNull()))
    second = looked.groupBy("k", "b", "t").agg(F.count(F.lit(1)).alias("n"), (F.max("s") - F.min("s") + 1).alias("span"))
    hot = second.groupBy("k", "b").agg(F.sum("n").alias("hour"), F.max("n").alias("second"), F.max("span").alias("span"))
    r = hot.agg(F.max("hour").alias("hour"), F.max("second").alias("second"), F.max("span").alias("span")).first()
    if not r["hour"] or r["hour"] <= target_rows:
        return start, 0
    if r["second"] > target_rows:
        return 1, max(1, int(r["span"] * target_rows / r["second"]))
    return max(1, int(start * target_rows / r["hour"])), 0


def time_since_state(events: DataFrame, channels: Mapping[str, Channel], *,
                     time: str = "Time", seq: str = "seq", event: str = "EventID",
                     host: str = "LogHost", keys: Sequence[Column] | None = None,
                     bucket_seconds: int | str = "auto", seq_step: int = 0, prefix: str = "time_since_",
                     initial: DataFrame | None = None, wanted: Column | None = None) -> DataFrame:
    """Add ``<prefix><channel>`` for every channel, in one pass.

    ``initial`` (optional) is a state table from earlier rows -
    ``(_key, _end_<channel>...)`` as built by ``state_table`` - that seeds
    every key before the first row here (used across micro-batches).

    ``seq`` must be unique per row and, with ``time``, give the file order
    (rows compare by ``(time, seq)``). ``bucket_seconds`` sets the slice
    width: smaller slices spread a hot host over more tasks, and at one second
    ``seq_step`` cuts on by row numbers; ``"auto"`` measures the largest
    slices first (``choose_slices``).

    Only keys that have a marker (or earlier state) are looked up. ``wanted``
    limits the rows that are looked up and returned; all rows still set states.

    A channel's state is one long per marker row: the marker time when it
    turns the state on, ``CLEARED`` when it turns it off, null on other rows.
    Longs keep every aggregate hash-based and every window primitive.
    """
    keys = list(keys) if keys is not None else default_keys(host)
    names = list(channels)
    ids = sorted({i for ch in channels.values() for i in (*ch.on, *ch.off)})
    asked = events if wanted is None else events.filter(wanted)
    if bucket_seconds == "auto":
        bucket_seconds, seq_step = choose_slices(asked, keys, time, seq)
    if seq_step and bucket_seconds != 1:
        raise ValueError("seq_step needs slices of one second")

    def marker_state(ch: Channel) -> Column:
        st = F.when(F.col(event).isin(list(ch.on)), F.col(time).cast("long"))
        if ch.off:
            st = st.when(F.col(event).isin(list(ch.off)), F.lit(CLEARED))
        return st

    markers = (events.filter(F.col(event).isin(ids) & F.col(host).isNotNull())
               .select(F.col(host).cast("string").alias("_key"), F.col(time).cast("long").alias("_t"),
                       F.col(seq).alias("_seq"), F.lit(1).alias("_is_marker"),
                       F.lit(None).cast("int").alias("_rank"),
                       *[marker_state(channels[n]).alias(f"_m_{n}") for n in names]))

    key_arr = F.array(*[F.struct(F.lit(i + 1).alias("rank"), k.cast("string").alias("key"))
                        for i, k in enumerate(keys)])
    held = markers.select(F.col("_key").alias("_held"))
    if initial is not None:
        held = held.unionByName(initial.select(F.col("_key").cast("string").alias("_held")))
    lookups = (asked.select(F.col(time).cast("long").alias("_t"), F.col(seq).alias("_seq"),
                            F.explode(key_arr).alias("_k"))
               .join(held.distinct(), F.col("_k.key") == F.col("_held"), "left_semi")
               .select(F.col("_k.key").alias("_key"), "_t", "_seq", F.lit(0).alias("_is_marker"),
                       F.col("_k.rank").alias("_rank"),
                       *[F.lit(None).cast("long").alias(f"_m_{n}") for n in names]))

    second = F.floor(F.col("_t") / bucket_seconds).cast("long")
    part = F.floor(F.col("_seq") / seq_step).cast("long") if seq_step else F.lit(0).cast("long")
    bucket = F.struct(second.alias("s"), part.alias("p"))  # grows with (time, seq)
    markers = markers.withColumn("_bucket", bucket)
    lookups = lookups.withColumn("_bucket", bucket)
    u = markers.unionByName(lookups)

    # One Window operator per (key, bucket) slice, ordered by (t, seq);
    # lookups sort before a marker with the same (t, seq), so a row never
    # sees itself: the state set inside the slice strictly before the row.
    before = (Window.partitionBy("_key", "_bucket").orderBy("_t", "_seq", "_is_marker")
              .rowsBetween(Window.unboundedPreceding, -1))
    u = u.select("*", *[F.last(f"_m_{n}", ignorenulls=True).over(before).alias(f"_in_{n}") for n in names])

    # State entering each slice. Slice-final states come from the marker
    # rows alone (a small share of the rows); the slices looked at come from
    # a hash distinct over the lookups. Both are at most one row per
    # (key, bucket); a window per key over them carries the last known
    # state forward to every later slice.
    order = F.struct("_t", "_seq")
    ends = markers.groupBy("_key", "_bucket").agg(*[
        F.max_by(f"_m_{n}", F.when(F.col(f"_m_{n}").isNotNull(), order)).alias(f"_end_{n}") for n in names])
    slices = lookups.select("_key", "_bucket").distinct()
    grid = slices.join(ends, ["_key", "_bucket"], "full")
    if initial is not None:  # earlier state sorts before every bucket
        grid = grid.unionByName(initial.select(
            F.col("_key").cast("string"),
            F.struct(F.lit(-(2 ** 63)).cast("long").alias("s"), F.lit(-(2 ** 63)).cast("long").alias("p")).alias("_bucket"),
            *[F.col(f"_end_{n}").cast("long") for n in names]))
    w_carry = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = grid.select("_key", "_bucket", *[
        F.last(f"_end_{n}", ignorenulls=True).over(w_carry).alias(f"_carry_{n}") for n in names])

    looked = (u.filter(F.col("_is_marker") == 0).join(carry, ["_key", "_bucket"], "left")
              .select("_seq", "_rank", "_t", *[
                  F.coalesce(F.col(f"_in_{n}"), F.col(f"_carry_{n}")).alias(f"_s_{n}") for n in names]))

    def pick(n: str) -> Column:
        st = F.col(f"_s_{n}")
        on = st.isNotNull() & (st != F.lit(CLEARED))
        return F.min_by(F.when(on, F.col("_t") - st), F.when(on, F.col("_rank"))).alias(f"_v_{n}")

    per_row = looked.groupBy("_seq").agg(*[pick(n) for n in names])

    out = asked.join(per_row, asked[seq] == per_row["_seq"], "left")
    cols = []
    for n in names:
        ch = channels[n]
        v = F.when(F.col(event).isin(list(ch.on)), F.col(time).cast("long"))
        if ch.off:
            v = v.when(F.col(event).isin(list(ch.off)), F.lit(None).cast("long"))
        cols.append(v.otherwise(F.col(f"_v_{n}")).alias(f"{prefix}{n}"))
    return out.select(*events.columns, *cols)


def state_table(events: DataFrame, channels: Mapping[str, Channel], *, time: str = "Time",
                seq: str = "seq", event: str = "EventID", host: str = "LogHost",
                initial: DataFrame | None = None) -> DataFrame:
    """Per host, the state each channel is left in after ``events`` (marker
    time, ``CLEARED`` or null), merged over an ``initial`` table: one row
    per host, one hash aggregate over the marker rows only."""
    names = list(channels)
    ids = sorted({i for ch in channels.values() for i in (*ch.on, *ch.off)})
    cols = []
    for n in names:
        ch = channels[n]
        st = F.when(F.col(event).isin(list(ch.on)), F.col(time).cast("long"))
        if ch.off:
            st = st.when(F.col(event).isin(list(ch.off)), F.lit(CLEARED))
        cols.append(st.alias(f"_m_{n}"))
    m = (events.filter(F.col(event).isin(ids) & F.col(host).isNotNull())
         .select(F.col(host).cast("string").alias("_key"), F.col(time).cast("long").alias("_t"),
                 F.col(seq).alias("_seq"), *cols))
    order = F.struct("_t", "_seq")
    last = m.groupBy("_key").agg(*[
        F.max_by(f"_m_{n}", F.when(F.col(f"_m_{n}").isNotNull(), order)).alias(f"_end_{n}") for n in names])
    if initial is None:
        return last
    i = initial.select("_key", *[F.col(f"_end_{n}").alias(f"_i_{n}") for n in names])
    return i.join(last, "_key", "full").select(
        "_key", *[F.coalesce(F.col(f"_end_{n}"), F.col(f"_i_{n}")).alias(f"_end_{n}") for n in names])


def carry_forward(df: DataFrame, partition: Sequence[str], order: Sequence[str],
                  value: str, out: str) -> DataFrame:
    """Last non-null ``value`` at or before each row within a partition.

    Plain form for keys of bounded size; the bucketed form above is the one
    to use when a key can be hot."""
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.last(value, ignorenulls=True).over(w))
