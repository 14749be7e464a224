"""Event-log project: host state features and the process-start context table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import flag as threshold_flag_int
from tidemark.functions.scalar import pattern_class, remove_digits
from tidemark.operators.encode import one_hot
from tidemark.operators.lookup import lookup_join
from tidemark.operators.state import LOCK, SCREENSAVER, STARTUP, time_since_state
from tidemark.plans.registry import register
from tidemark.sources import testdata as td

NEAR_STARTUP_S = 60
CHANNELS = {"startup": STARTUP, "locked": LOCK, "screensaver": SCREENSAVER}


def host_state(events: DataFrame, bucket_seconds: int | str = "auto", wanted=None) -> DataFrame:
    """J09 + J10 x2 + P10 flags (of the ``wanted`` rows, or all)."""
    s = time_since_state(events, CHANNELS, bucket_seconds=bucket_seconds, wanted=wanted)
    return s.withColumns({
        "near_startup": threshold_flag_int(F.col("time_since_startup") <= NEAR_STARTUP_S),
        "is_locked": threshold_flag_int(F.col("time_since_locked") > 0),
        "is_screensaver": threshold_flag_int(F.col("time_since_screensaver") > 0),
    })


def process_context(spark, events: DataFrame, start_time: int = 0, levels=None,
                    bucket_seconds: int | str = "auto") -> DataFrame:
    """F16: time bins, description, host class, after-hours, the three state
    features, user-name class and parent flag; process-start rows only;
    host class and user-name class one-hot encoded."""
    t = F.col("Time") - F.lit(start_time)
    df = events.withColumns({
        "minute": F.floor(t / 60).cast("long"), "5_minutes": F.floor(t / 300).cast("long"),
        "30_minutes": F.floor(t / 1800).cast("long"), "hour": F.floor(t / 3600).cast("long"),
        "recorded_by": remove_digits("LogHost"),
        "UserName_type": pattern_class("UserName"),
        "has_parent_process": F.col("ParentProcessName").isNotNull().cast("int"),
    })
    hod = F.pmod(F.col("hour"), F.lit(24))
    df = df.withColumn("after_hours", ((hod < 7) | (hod > 17)).cast("int"))
    df = lookup_join(df, td.event_types(spark), "EventID", "left")
    proc = host_state(df, bucket_seconds, F.col("EventID") == 4688).select(
        "seq", "Time", "minute", "5_minutes", "30_minutes", "hour", "Description",
        "recorded_by", "ParentProcessName", "ProcessName", "has_parent_process", "UserName_type",
        "after_hours", "near_startup", "is_locked", "is_screensaver")
    return one_hot(proc, ["recorded_by", "UserName_type"], levels)


STATE_SQL_CTES = f"""
{td.WIN_SQL},
su AS (SELECT LogHost AS k, seq AS s, Time AS t FROM win WHERE EventID = 4608 AND LogHost IS NOT NULL),
lk AS (SELECT LogHost AS k, seq AS s, Time AS t, EventID = 4800 AS on_ FROM win
       WHERE EventID IN (4800, 4801) AND LogHost IS NOT NULL),
sv AS (SELECT LogHost AS k, seq AS s, Time AS t, EventID = 4802 AS on_ FROM win
       WHERE EventID IN (4802, 4803) AND LogHost IS NOT NULL),
e AS (SELECT *, substr(UserName, 1, length(UserName) - 1) AS ukey FROM win),
j AS (
  SELECT e.*, a1.t AS a1, a2.t AS a2, a3.t AS a3,
         b1.t AS b1, b1.on_ AS b1on, b2.t AS b2, b2.on_ AS b2on, b3.t AS b3, b3.on_ AS b3on,
         c1.t AS c1, c1.on_ AS c1on, c2.t AS c2, c2.on_ AS c2on, c3.t AS c3, c3.on_ AS c3on
  FROM e
  ASOF LEFT JOIN su a1 ON e.LogHost = a1.k AND e.seq > a1.s
  ASOF LEFT JOIN su a2 ON e.Source = a2.k AND e.seq > a2.s
  ASOF LEFT JOIN su a3 ON e.ukey = a3.k AND e.seq > a3.s
  ASOF LEFT JOIN lk b1 ON e.LogHost = b1.k AND e.seq > b1.s
  ASOF LEFT JOIN lk b2 ON e.Source = b2.k AND e.seq > b2.s
  ASOF LEFT JOIN lk b3 ON e.ukey = b3.k AND e.seq > b3.s
  ASOF LEFT JOIN sv c1 ON e.LogHost = c1.k AND e.seq > c1.s
  ASOF LEFT JOIN sv c2 ON e.Source = c2.k AND e.seq > c2.s
  ASOF LEFT JOIN sv c3 ON e.ukey = c3.k AND e.seq > c3.s),
st AS (
  SELECT *,
    CASE WHEN EventID = 4608 THEN Time WHEN a1 IS NOT NULL THEN Time - a1
         WHEN a2 IS NOT NULL THEN Time - a2 WHEN a3 IS NOT NULL THEN Time - a3 END AS time_since_startup,
    CASE WHEN EventID = 4800 THEN Time WHEN EventID = 4801 THEN NULL
         WHEN b1on THEN Time - b1 WHEN b2on THEN Time - b2 WHEN b3on THEN Time - b3 END AS time_since_locked,
    CASE WHEN EventID = 4802 THEN Time WHEN EventID = 4803 THEN NULL
         WHEN c1on THEN Time - c1 WHEN c2on THEN Time - c2 WHEN c3on THEN Time - c3 END AS time_since_screensaver
  FROM j),
flags AS (
  SELECT *,
    CAST(coalesce(time_since_startup <= {NEAR_STARTUP_S}, false) AS INTEGER) AS near_startup,
    CAST(coalesce(time_since_locked > 0, false) AS INTEGER) AS is_locked,
    CAST(coalesce(time_since_screensaver > 0, false) AS INTEGER) AS is_screensaver
  FROM st)
"""

HOST_STATE_SQL = f"""
WITH {STATE_SQL_CTES}
SELECT seq, Time, EventID, LogHost, Source, UserName, ProcessName, ParentProcessName,
       time_since_startup, time_since_locked, time_since_screensaver,
       near_startup, is_locked, is_screensaver
FROM flags
"""

PROCESS_CONTEXT_SQL = f"""
WITH {STATE_SQL_CTES}, {td.event_types_sql()},
p AS (
  SELECT f.*, d.Description,
    regexp_replace(LogHost, '\\d+', '', 'g') AS recorded_by,
    CASE WHEN regexp_matches(UserName, '^Comp\\d+\\$') THEN 'Computer account'
         WHEN regexp_matches(UserName, '^User\\d+') THEN 'User account' ELSE UserName END AS UserName_type
  FROM flags f LEFT JOIN event_types d USING (EventID))
SELECT seq, Time, CAST(Time // 60 AS BIGINT) AS minute, CAST(Time // 300 AS BIGINT) AS "5_minutes",
       CAST(Time // 1800 AS BIGINT) AS "30_minutes", CAST(Time // 3600 AS BIGINT) AS hour, Description,
       ParentProcessName, ProcessName,
       CAST(ParentProcessName IS NOT NULL AS INTEGER) AS has_parent_process,
       CAST((Time // 3600) % 24 < 7 OR (Time // 3600) % 24 > 17 AS INTEGER) AS after_hours,
       near_startup, is_locked, is_screensaver,
       CAST(coalesce(recorded_by = 'Comp', false) AS INTEGER) AS recorded_by_Comp,
       CAST(coalesce(UserName_type = 'Computer account', false) AS INTEGER) AS "UserName_type_Computer account",
       CAST(coalesce(UserName_type = 'User account', false) AS INTEGER) AS "UserName_type_User account"
FROM p WHERE EventID = 4688
"""


@register("host_state", HOST_STATE_SQL)
def q_host_state(spark, sf_dir):
    """J09 (time since start-up) + J10 (lock, screensaver) with three-key priority."""
    ev = td.win_events(spark, sf_dir)
    return host_state(ev).select(
        "seq", "Time", "EventID", "LogHost", "Source", "UserName", "ProcessName", "ParentProcessName",
        "time_since_startup", "time_since_locked", "time_since_screensaver",
        "near_startup", "is_locked", "is_screensaver")


PROCESS_LEVELS = {"recorded_by": ["Comp"], "UserName_type": ["Computer account", "User account"]}


@register("process_context", PROCESS_CONTEXT_SQL)
def q_process_context(spark, sf_dir):
    """F16 composed."""
    return process_context(spark, td.win_events(spark, sf_dir), levels=PROCESS_LEVELS)
