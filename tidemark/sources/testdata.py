"""Stand-ins: the reference's inputs derived from the given test tables.

The reference ships no data; its inputs are mapped onto the test tables (the
mapping is documented in README.md). Each stand-in has a Spark form and an
SQL form (``*_SQL``) that DuckDB runs as a CTE in the oracle queries; the two
must describe the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalar import epoch_millis, epoch_seconds

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k() -> F.Column:
    return F.get_json_object("props", "$.k").cast("long")


# ------------------------------------------------------- music events ----
# page values of the stand-in and the churn roles they play
MUSIC_PAGES = ["click", "error", "purchase", "signup", "view"]
CHURN_PAGE, DOWNGRADE_PAGE, UPGRADE_PAGE = "error", "purchase", "signup"


def music_events_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> music-service events without registration."""
    k = _k()
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("userId"),
        epoch_millis("ts").alias("ts"),
        F.col("event_type").alias("page"),
        F.when(F.col("value") >= 50, "paid").otherwise("free").alias("level"),
        F.when(F.col("user_id") % 2 == 0, "M").otherwise("F").alias("gender"),
        k.alias("sessionId"),
        F.when(F.col("event_type") == "view", F.concat(F.lit("a"), (k % 13).cast("string"))).alias("artist"),
        F.when(F.col("event_type") == "view", F.concat(F.lit("s"), k.cast("string"))).alias("song"),
        F.col("value").alias("length"),
        F.col("event_id"))


def music_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adds ``registration`` = first event time of the user.

    A per-user aggregate joined back (not a window over the user: one user
    may hold a third of all events; the aggregate pre-combines map-side and
    AQE splits the skewed join partition)."""
    base = music_events_raw(spark, sf_dir)
    reg = base.groupBy("userId").agg(F.min("ts").alias("registration"))
    return base.join(reg, "userId")


MUSIC_SQL = """
music_raw AS (
  SELECT CAST(user_id AS VARCHAR) AS userId, (epoch_us(ts) // 1000) AS ts, event_type AS page,
         CASE WHEN value >= 50 THEN 'paid' ELSE 'free' END AS level,
         CASE WHEN user_id % 2 = 0 THEN 'M' ELSE 'F' END AS gender,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS sessionId,
         CASE WHEN event_type = 'view'
              THEN 'a' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 13 AS VARCHAR) END AS artist,
         CASE WHEN event_type = 'view' THEN 's' || json_extract_string(props, '$.k') END AS song,
         value AS length, event_id
  FROM events),
music AS (
  SELECT m.*, r.registration FROM music_raw m
  JOIN (SELECT userId, min(ts) AS registration FROM music_raw GROUP BY userId) r USING (userId))
"""


# ------------------------------------------------- Windows event log ----
# Stand-in rules: hosts Comp<user_id>; only hosts with user_id % 3 = 0 log
# start-up / lock / screensaver markers (so the Source and UserName
# fallbacks are exercised); Time coarsened to 5 minutes so ties occur.
TIME_GRAIN_S = 300


def win_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return win_events_from(table(spark, sf_dir, "events"))


def win_events_from(events: DataFrame) -> DataFrame:
    """Windows-event stand-in from an ``events`` frame (batch or stream)."""
    k = _k()
    et = F.col("event_type")
    mh = (F.col("user_id") % 3) == 0
    eid = (F.when(et == "view", 4688)
           .when(et == "signup", F.when(mh, 4608).otherwise(4624))
           .when(et == "error", F.when(mh, 4800).otherwise(4625))
           .when(et == "click", F.when(mh, 4801).otherwise(4634))
           .when(et == "purchase", F.when(mh, F.when(F.col("event_id") % 2 == 0, 4802).otherwise(4803))
                 .otherwise(4672)))
    user = (F.when(F.col("event_id") % 3 == 1, F.concat(F.lit("User"), k.cast("string")))
            .when(F.col("event_id") % 3 == 2, F.concat(F.lit("Comp"), (k + 50).cast("string"), F.lit("$"))))
    t = F.floor(epoch_seconds("ts") / TIME_GRAIN_S) * TIME_GRAIN_S
    return events.select(
        F.col("event_id").alias("seq"),
        t.cast("long").alias("Time"),
        eid.cast("int").alias("EventID"),
        F.concat(F.lit("Comp"), F.col("user_id").cast("string")).alias("LogHost"),
        F.concat(F.lit("Comp"), k.cast("string")).alias("Source"),
        user.alias("UserName"),
        F.when(et == "view", F.concat(F.lit("proc"), (k % 7).cast("string"))).alias("ProcessName"),
        F.when((et == "view") & (k % 5 != 0), F.concat(F.lit("parent"), (k % 3).cast("string")))
        .alias("ParentProcessName"))


WIN_SQL = """
win AS (
  SELECT event_id AS seq,
         CAST((epoch_us(ts) // 1000000) // 300 * 300 AS BIGINT) AS Time,
         CAST(CASE
           WHEN event_type = 'view' THEN 4688
           WHEN event_type = 'signup' THEN CASE WHEN user_id % 3 = 0 THEN 4608 ELSE 4624 END
           WHEN event_type = 'error' THEN CASE WHEN user_id % 3 = 0 THEN 4800 ELSE 4625 END
           WHEN event_type = 'click' THEN CASE WHEN user_id % 3 = 0 THEN 4801 ELSE 4634 END
           WHEN event_type = 'purchase' THEN CASE WHEN user_id % 3 = 0
                THEN CASE WHEN event_id % 2 = 0 THEN 4802 ELSE 4803 END ELSE 4672 END
         END AS INTEGER) AS EventID,
         'Comp' || CAST(user_id AS VARCHAR) AS LogHost,
         'Comp' || json_extract_string(props, '$.k') AS Source,
         CASE WHEN event_id % 3 = 1 THEN 'User' || json_extract_string(props, '$.k')
              WHEN event_id % 3 = 2 THEN 'Comp' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) + 50 AS VARCHAR) || '$'
         END AS UserName,
         CASE WHEN event_type = 'view'
              THEN 'proc' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 7 AS VARCHAR) END AS ProcessName,
         CASE WHEN event_type = 'view' AND CAST(json_extract_string(props, '$.k') AS BIGINT) % 5 <> 0
              THEN 'parent' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 3 AS VARCHAR) END AS ParentProcessName
  FROM events)
"""


# The 20-row event dictionary (EventID, Description) exactly as
# the reference's lookup file lists it, in its order.
EVENT_TYPES = [
    (4768, "Kerberos authentication ticket was requested (TGT)"),
    (4769, "Kerberos service ticket was requested (TGS)"),
    (4770, "Kerberos service ticket was renewed"),
    (4774, "An account was mapped for logon"),
    (4776, "The domain controller attempted to validate the credentials for an account"),
    (4624, "An account was successfully logged on"),
    (4625, "An account failed to logon on"),
    (4634, "An account was logged on"),
    (4647, "User initiated logon"),
    (4648, "A logon was attempted using explicit credentials"),
    (4672, "Special privileges assigned to a new logon"),
    (4800, "The workstation was locked"),
    (4801, "The workstation was unlocked"),
    (4802, "The screensaver was invoked"),
    (4803, "The screensaver was dismissed"),
    (4688, "Process start"),
    (4689, "Process end"),
    (4608, "Windows is starting up"),
    (4609, "Windows is shutting down"),
    (1100, "Event logging service has shut down (often recorded instead of EventID 4609)"),
]


def event_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(EVENT_TYPES, "EventID int, Description string")


def event_types_sql() -> str:
    vals = ", ".join("({}, '{}')".format(i, d.replace("'", "''")) for i, d in EVENT_TYPES)
    return f"event_types AS (SELECT * FROM (VALUES {vals}) t(EventID, Description))"


# -------------------------------------------------- labelled messages ----
def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> messages(id, message, original, genre)."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"), F.col("text").alias("message"),
        F.col("lang").alias("original"), F.col("source").alias("genre"))


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """labels -> categories(id, 'quality-q;toxic-t')."""
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"),
        F.concat(F.lit("quality-"), F.col("quality").cast("string"),
                 F.lit(";toxic-"), F.col("toxic").cast("string")).alias("categories"))


MESSAGES_SQL = """
messages AS (SELECT doc_id AS id, text AS message, lang AS original, source AS genre FROM documents),
categories AS (SELECT doc_id AS id,
   'quality-' || CAST(quality AS VARCHAR) || ';toxic-' || CAST(toxic AS VARCHAR) AS categories FROM labels)
"""


# ------------------------------------------------------------- census ----
CENSUS_NUMERIC = ["o_totalprice", "c_acctbal", "c_nationkey", "order_month", "order_year"]
CENSUS_SKEWED = ["o_totalprice"]
CENSUS_CATEGORICAL = ["c_mktsegment", "o_orderstatus", "ship_mode"]


def census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders x customer -> census-like rows; label = urgent/high priority."""
    return census_from(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"))


def census_from(o: DataFrame, c: DataFrame) -> DataFrame:
    """Census stand-in from orders (batch or stream) and customers."""
    return o.join(c, o.o_custkey == c.c_custkey).select(
        "o_orderkey", "o_totalprice", "c_acctbal", "c_nationkey",
        F.month("o_orderdate").alias("order_month"), F.year("o_orderdate").alias("order_year"),
        "c_mktsegment", "o_orderstatus",
        F.when(F.col("o_orderkey") % 3 == 0, "AIR").when(F.col("o_orderkey") % 3 == 1, "RAIL")
        .otherwise("SHIP").alias("ship_mode"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), ">50K").otherwise("<=50K").alias("income"))


CENSUS_SQL = """
census AS (
  SELECT o_orderkey, o_totalprice, c_acctbal, c_nationkey,
         CAST(month(o_orderdate) AS INTEGER) AS order_month, CAST(year(o_orderdate) AS INTEGER) AS order_year,
         c_mktsegment, o_orderstatus,
         CASE WHEN o_orderkey % 3 = 0 THEN 'AIR' WHEN o_orderkey % 3 = 1 THEN 'RAIL' ELSE 'SHIP' END AS ship_mode,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN '>50K' ELSE '<=50K' END AS income
  FROM orders JOIN customer ON o_custkey = c_custkey)
"""


# ------------------------------------------------------- demographics ----
# population = part; customers = parts sold with return flag 'R'.
# Feature summary (attribute, type, missing codes) for the stand-in columns.
DEMO_META = [
    ("p_partkey", "numeric", "[]"),
    ("p_size", "ordinal", "[1,2,3]"),
    ("p_retailprice", "numeric", "[-1]"),
    ("p_type", "categorical", "[PROMO]"),
    ("p_brand", "categorical", "[]"),
    ("size_band", "categorical", "[-1,0]"),
    ("mfgr_side", "categorical", "[]"),
    ("decade_code", "mixed", "[0]"),
    ("cameo", "mixed", "[XX]"),
]


def demo_meta(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DEMO_META, "attribute string, type string, missing_or_unknown string")


def _demo_cols(df: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    return df.select(
        "p_partkey", "p_size", "p_retailprice", "p_type", "p_brand",
        (F.col("p_size") % 4).alias("size_band"),
        F.when(k % 2 == 0, "W").otherwise("O").alias("mfgr_side"),
        ((k % 16)).cast("int").alias("decade_code"),
        F.when(k % 10 == 0, "XX").otherwise(
            F.concat(((k % 5) + 1).cast("string"), ((k % 4) + 1).cast("string"))).alias("cameo"))


def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _demo_cols(table(spark, sf_dir, "part"))


def demo_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts bought in lineitems with return flag 'R' (semi join: each part once)."""
    li = table(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R")
    p = table(spark, sf_dir, "part")
    return _demo_cols(p.join(li, p.p_partkey == li.l_partkey, "left_semi"))


DEMO_SQL = """
population AS (
  SELECT p_partkey, p_size, p_retailprice, p_type, p_brand, p_size % 4 AS size_band,
         CASE WHEN p_partkey % 2 = 0 THEN 'W' ELSE 'O' END AS mfgr_side,
         CAST(p_partkey % 16 AS INTEGER) AS decade_code,
         CASE WHEN p_partkey % 10 = 0 THEN 'XX'
              ELSE CAST(p_partkey % 5 + 1 AS VARCHAR) || CAST(p_partkey % 4 + 1 AS VARCHAR) END AS cameo
  FROM part)
"""
