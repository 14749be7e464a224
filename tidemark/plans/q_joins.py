"""Join and cohort queries (J01, J02, J07, J08, J11, J12, A10, T05, X-rules)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scalar as X
from tidemark.operators.cohort import rate_per_member, semi_join, anti_join
from tidemark.operators.lookup import lookup_default, lookup_join, struct_lookup, unmapped_codes, written_with_unmapped
from tidemark.operators.rank import topk_classes
from tidemark.plans.demographics import DECADE_MOVEMENT, MIXED_LOOKUPS, split_mixed
from tidemark.plans.registry import register
from tidemark.sources import testdata as td


@register("messages_join", f"""
WITH {td.MESSAGES_SQL}
SELECT m.id, m.message, m.original, m.genre, c.categories FROM messages m JOIN categories c ON m.id = c.id
""")
def q_messages_join(spark, sf_dir):
    """Messages inner-join categories on id."""
    m, c = td.messages(spark, sf_dir), td.categories(spark, sf_dir)
    return m.join(c, "id", "inner").select("id", "message", "original", "genre", "categories")


@register("event_lookup", f"""
WITH {td.WIN_SQL}, {td.event_types_sql()}
SELECT w.seq, w.EventID, d.Description FROM win w LEFT JOIN event_types d ON w.EventID = d.EventID
""")
def q_event_lookup(spark, sf_dir):
    """Event id -> description, broadcast after a size check."""
    w = td.win_events(spark, sf_dir).select("seq", "EventID")
    return lookup_join(w, td.event_types(spark), "EventID", "left").select("seq", "EventID", "Description")


@register("plays_of_churned", f"""
WITH {td.MUSIC_SQL}
SELECT event_id, userId, ts FROM music_raw
WHERE page = 'view' AND userId IN (SELECT userId FROM music_raw WHERE page = '{td.CHURN_PAGE}')
""")
def q_plays_of_churned(spark, sf_dir):
    """Plays of users who ever churned (IN subquery -> left semi join)."""
    ev = td.music_events_raw(spark, sf_dir)
    churned = ev.filter(F.col("page") == td.CHURN_PAGE).select("userId")
    return semi_join(ev.filter(F.col("page") == "view"), churned, "userId").select("event_id", "userId", "ts")


@register("never_churned_by_level", f"""
WITH {td.MUSIC_SQL}
SELECT level, count(DISTINCT userId) AS n_users FROM music_raw
WHERE userId NOT IN (SELECT userId FROM music_raw WHERE page = '{td.DOWNGRADE_PAGE}' AND length > 300)
GROUP BY level
""")
def q_never_churned_by_level(spark, sf_dir):
    """Users who never did X, by plan level (NOT IN -> anti join; keys
    are non-null after P01 so NOT IN and NOT EXISTS agree)."""
    ev = td.music_events_raw(spark, sf_dir)
    did = ev.filter((F.col("page") == td.DOWNGRADE_PAGE) & (F.col("length") > 300)).select("userId")
    return (anti_join(ev, did, "userId").groupBy("level")
            .agg(F.count_distinct("userId").alias("n_users")))


COHORT_SQL = f"""
WITH {td.MUSIC_SQL},
u AS (SELECT userId, max(CASE WHEN page = '{td.CHURN_PAGE}' THEN 1 ELSE 0 END) AS churned,
             max(CASE WHEN page = '{td.DOWNGRADE_PAGE}' THEN 1 ELSE 0 END) AS downgraded
      FROM music_raw GROUP BY userId),
uc AS (SELECT userId, 'all' AS cohort FROM u
       UNION ALL SELECT userId, CASE WHEN churned = 1 THEN 'churned' ELSE 'stayed' END FROM u
       UNION ALL SELECT userId, CASE WHEN downgraded = 1 THEN 'downgraded' ELSE 'not_downgraded' END FROM u),
sizes AS (SELECT cohort, count(*) AS members FROM uc GROUP BY cohort),
plays AS (SELECT userId, CAST(((ts // 3600000) % 24) AS INTEGER) AS hour FROM music_raw WHERE page = 'view'),
agg AS (SELECT uc.cohort, p.hour, count(*) AS plays FROM plays p JOIN uc USING (userId) GROUP BY ALL)
SELECT agg.cohort, hour, plays, members, round(plays / members, 6) AS rate
FROM agg JOIN sizes USING (cohort)
"""


@register("cohort_hourly_rates", COHORT_SQL)
def q_cohort_hourly_rates(spark, sf_dir):
    """A10: plays per hour of day / cohort size for five cohorts in one job
    (X15 hour from epoch ms)."""
    ev = td.music_events_raw(spark, sf_dir)
    users = ev.groupBy("userId").agg(
        F.max((F.col("page") == td.CHURN_PAGE).cast("int")).alias("churned"),
        F.max((F.col("page") == td.DOWNGRADE_PAGE).cast("int")).alias("downgraded"))
    cohorts = users.select("userId", F.explode(F.array(
        F.lit("all"),
        F.when(F.col("churned") == 1, "churned").otherwise("stayed"),
        F.when(F.col("downgraded") == 1, "downgraded").otherwise("not_downgraded"))).alias("cohort"))
    plays = ev.filter(F.col("page") == "view").select("userId", X.hour_of_epoch_ms("ts").alias("hour"))
    r = rate_per_member(plays, cohorts, "userId", "cohort", ["hour"])
    return r.select("cohort", "hour", "plays", "members", F.round("rate", 6).alias("rate"))


# class code -> name for the embedding labels (a code map as the reference's
# JSON file would hold it; codes 8 and 9 are left out to exercise "Unknown")
CLASS_NAMES = {str(i): f"class {i}" for i in range(8)}


@register("topk_classes", """
WITH s AS (SELECT vec_id, r.i AS cls, CAST(embedding[r.i + 1] AS DOUBLE) AS score
           FROM (SELECT vec_id, embedding, unnest(range(0, len(embedding))) AS i FROM embeddings) r),
k AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, cls DESC) AS rank FROM s),
t AS (SELECT * FROM k WHERE rank <= 5)
SELECT vec_id, CAST(rank AS INTEGER) AS rank, CAST(cls AS INTEGER) AS cls, round(score, 6) AS score,
       round(exp(score) / sum(exp(score)) OVER (PARTITION BY vec_id), 6) AS prob,
       coalesce(CASE WHEN cls < 8 THEN 'class ' || CAST(cls AS VARCHAR) END, 'Unknown') AS name
FROM t
""")
def q_topk_classes(spark, sf_dir):
    """T05 + J11: top-5 of all scores, softmax over the kept 5,
    code -> name with 'Unknown' default."""
    emb = td.table(spark, sf_dir, "embeddings")
    top = emb.select("vec_id", F.posexplode(topk_classes("embedding", 5)).alias("pos", "t"))
    rows = top.select("vec_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("t.cls").cast("int").alias("cls"),
                      F.round("t.score", 6).alias("score"), F.round("t.prob", 6).alias("prob"))
    names = spark.createDataFrame(sorted(CLASS_NAMES.items()), "code string, name string")
    rows = rows.withColumn("code", F.col("cls").cast("string"))
    return lookup_default(rows, names, "code", "name", "name", dim_key="code").drop("code")


@register("decade_movement", f"""
WITH {td.DEMO_SQL},
m(code, decade, movement) AS (VALUES {", ".join(f"({k}, {v[0]}, {v[1]})" for k, v in DECADE_MOVEMENT.items())})
SELECT p_partkey, decade_code, decade, movement,
       CASE WHEN TRY_CAST(substr(cameo, 1, 1) AS INTEGER) IS NOT NULL AND TRY_CAST(substr(cameo, 2, 1) AS INTEGER) IS NOT NULL
            THEN TRY_CAST(substr(cameo, 1, 1) AS INTEGER) END AS wealth,
       CASE WHEN TRY_CAST(substr(cameo, 1, 1) AS INTEGER) IS NOT NULL AND TRY_CAST(substr(cameo, 2, 1) AS INTEGER) IS NOT NULL
            THEN TRY_CAST(substr(cameo, 2, 1) AS INTEGER) END AS lifestage
FROM population LEFT JOIN m ON decade_code = m.code
""")
def q_decade_movement(spark, sf_dir):
    """J12 + X08: code -> (decade, movement) through a literal map; two-digit
    code -> (tens, ones), null for both when either digit fails."""
    p = td.population(spark, sf_dir)
    dm = struct_lookup("decade_code", DECADE_MOVEMENT, ["decade", "movement"])
    return p.select("p_partkey", "decade_code", dm["decade"].alias("decade"), dm["movement"].alias("movement"),
                    X.tens_digit("cameo").alias("wealth"), X.ones_digit("cameo").alias("lifestage"))


_UNMAPPED_SQL = f"""
WITH {td.DEMO_SQL},
m(code) AS (VALUES {", ".join(f"({k})" for k in DECADE_MOVEMENT)}),
u AS (SELECT 'decade_code' AS lookup, CAST(decade_code AS VARCHAR) AS code,
             decade_code IS NOT NULL AND decade_code NOT IN (SELECT code FROM m) AS missed FROM population
      UNION ALL
      SELECT 'cameo', cameo, cameo IS NOT NULL AND NOT regexp_full_match(cameo, '[0-9][0-9].*') FROM population)
"""


@register("lookup_totals", _UNMAPPED_SQL + """
SELECT lookup, count(*) AS n_rows, count(*) FILTER (WHERE missed) AS n_unmapped FROM u GROUP BY lookup
""")
def q_lookup_totals(spark, sf_dir):
    """Rows that each lookup saw and could not map, observed by the job that writes the looked-up rows."""
    _, seen = written_with_unmapped(split_mixed(td.population(spark, sf_dir)), "split", MIXED_LOOKUPS)
    return spark.createDataFrame([(n, seen["rows"], seen[n]) for n in MIXED_LOOKUPS], "lookup string, n_rows long, n_unmapped long")


@register("unmapped_codes", _UNMAPPED_SQL + "SELECT lookup, code, count(*) AS n FROM u WHERE missed GROUP BY ALL")
def q_unmapped_codes(spark, sf_dir):
    """The codes that no map knows, for the lookups whose observed count is not 0."""
    out, seen = written_with_unmapped(split_mixed(td.population(spark, sf_dir)), "split", MIXED_LOOKUPS)
    missed = {n: c for n, c in MIXED_LOOKUPS.items() if seen[n]}
    return unmapped_codes(out, missed or MIXED_LOOKUPS)


@register("scalar_rules", f"""
WITH {td.WIN_SQL}
SELECT seq, regexp_replace(LogHost, '\\d+', '', 'g') AS host_class,
  CASE WHEN regexp_matches(UserName, '^Comp\\d+\\$') THEN 'Computer account'
       WHEN regexp_matches(UserName, '^User\\d+') THEN 'User account' ELSE UserName END AS user_class,
  substr(UserName, 1, length(UserName) - 1) AS user_key,
  CAST(contains(Source, '7') AS INTEGER) AS source_has_7,
  lower(trim('  ' || ProcessName || ' ')) AS proc_norm,
  CASE WHEN ParentProcessName IS NULL THEN NULL ELSE
    upper(substr(replace(ParentProcessName, '_', ' '), 1, 1)) || lower(substr(replace(ParentProcessName, '_', ' '), 2)) END AS parent_title,
  CAST((Time - 1704067200) // 1800 AS BIGINT) AS half_hour_bin,
  round(ln(1 + Time % 1000), 6) AS log1p_t
FROM win
""")
def q_scalar_rules(spark, sf_dir):
    """X04, X05, X06, X07, X10, X11, X14, X16 on the event log."""
    w = td.win_events(spark, sf_dir)
    return w.select(
        "seq", X.remove_digits("LogHost").alias("host_class"), X.pattern_class("UserName").alias("user_class"),
        X.all_but_last("UserName").alias("user_key"), X.contains_flag("Source", "7").alias("source_has_7"),
        X.norm_text(F.concat(F.lit("  "), F.col("ProcessName"), F.lit(" "))).alias("proc_norm"),
        X.title_label("ParentProcessName").alias("parent_title"),
        X.floor_bin("Time", 1704067200, 1800).alias("half_hour_bin"),
        F.round(X.log1p(F.col("Time") % 1000), 6).alias("log1p_t"))


@register("split_labels", f"""
WITH {td.MESSAGES_SQL},
p AS (SELECT id, split_part(categories, ';', 1) AS c0, split_part(categories, ';', 2) AS c1 FROM categories)
SELECT id, substr(c0, 1, length(c0) - 2) AS name0, TRY_CAST(right(c0, 1) AS INTEGER) AS value0,
       substr(c1, 1, length(c1) - 2) AS name1, TRY_CAST(right(c1, 1) AS INTEGER) AS value1 FROM p
""")
def q_split_labels(spark, sf_dir):
    """Split on ';', name = all but the last two characters,
    value = last character as a number."""
    c = td.categories(spark, sf_dir)
    c0, c1 = X.split_part("categories", ";", 0), X.split_part("categories", ";", 1)
    return c.select("id", X.drop_last_chars(c0, 2).alias("name0"), X.last_char_number(c0).alias("value0"),
                    X.drop_last_chars(c1, 2).alias("name1"), X.last_char_number(c1).alias("value1"))


# Per-channel means and standard deviations the reference
# normalises image tensors with (three channels).
CHANNEL_MEANS = [0.485, 0.456, 0.406]
CHANNEL_STDS = [0.229, 0.224, 0.225]


@register("embedding_normalise", f"""
WITH e AS (SELECT vec_id, embedding FROM embeddings),
u AS (SELECT vec_id, generate_subscripts(embedding, 1) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM e)
SELECT vec_id, CAST(i - 1 AS INTEGER) AS pos,
  floor((x - CAST({CHANNEL_MEANS} AS DOUBLE[])[((i - 1) % 3) + 1]) / CAST({CHANNEL_STDS} AS DOUBLE[])[((i - 1) % 3) + 1] * 1e6 + 0.5) / 1e6 AS z,
  floor(least(greatest(x * CAST({CHANNEL_STDS} AS DOUBLE[])[((i - 1) % 3) + 1] + CAST({CHANNEL_MEANS} AS DOUBLE[])[((i - 1) % 3) + 1], 0.0), 1.0)
        * 1e6 + 0.5) / 1e6 AS clipped
FROM u
""")
def q_embedding_normalise(spark, sf_dir):
    """Per-channel (x - mean) / std, and the inverse clipped to [0, 1]."""
    e = td.table(spark, sf_dir, "embeddings")
    x = e.select("vec_id", X.normalise_channels("embedding", CHANNEL_MEANS, CHANNEL_STDS).alias("z"),
                 X.denormalise_clip("embedding", CHANNEL_MEANS, CHANNEL_STDS).alias("c"))
    z = x.select("vec_id", F.posexplode(F.arrays_zip("z", "c")).alias("pos", "zc"))
    # the same IEEE operations as the SQL side (multiply, add, floor, divide),
    # so both engines agree bit for bit at the 6th decimal
    return z.select("vec_id", F.col("pos").cast("int").alias("pos"),
                    (F.floor(F.col("zc.z") * 1e6 + 0.5) / 1e6).alias("z"),
                    (F.floor(F.col("zc.c") * 1e6 + 0.5) / 1e6).alias("clipped"))
