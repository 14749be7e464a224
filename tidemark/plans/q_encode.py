"""Encoding, scaling and composed cleaning plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalar import contains_flag, last_char_number, log1p, split_part
from tidemark.operators import encode as E
from tidemark.operators.clean import dedupe, drop_columns
from tidemark.plans.demographics import CODED_SQL, DECADE_MOVEMENT, clean_demographics, coded_population
from tidemark.plans.registry import register
from tidemark.sources import testdata as td


def _r(c, d=6):
    return F.round(F.col(c), d).alias(c)


CENSUS_LEVELS = {"c_mktsegment": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
                 "o_orderstatus": ["F", "O", "P"], "ship_mode": ["AIR", "RAIL", "SHIP"]}


def _onehot_sql(levels):
    return ", ".join(f"CAST(coalesce({c} = '{lv}', false) AS INTEGER) AS {E.dummy_name(c, lv)}"
                     for c, lvs in levels.items() for lv in lvs)


@register("one_hot", f"""
WITH {td.CENSUS_SQL}
SELECT o_orderkey, {_onehot_sql(CENSUS_LEVELS)} FROM census
""")
def q_one_hot(spark, sf_dir):
    """one 0/1 column per level (levels fitted, sorted, none dropped)."""
    c = td.census(spark, sf_dir).select("o_orderkey", *td.CENSUS_CATEGORICAL)
    return E.one_hot(c, td.CENSUS_CATEGORICAL)


@register("one_hot_text", """
SELECT doc_id, CAST(coalesce(k = 'a-b', false) AS INTEGER) AS "k_a-b", CAST(coalesce(k = 'a b', false) AS INTEGER) AS "k_a b",
       CAST(coalesce(k = 'é', false) AS INTEGER) AS "k_é", CAST(coalesce(k = 'ñ', false) AS INTEGER) AS "k_ñ"
FROM (SELECT doc_id, CASE lang WHEN 'en' THEN 'a-b' WHEN 'de' THEN 'a b' WHEN 'fr' THEN 'é' WHEN 'es' THEN 'ñ' END AS k FROM documents)
""")
def q_one_hot_text(spark, sf_dir):
    """F03 with punctuated and non-ASCII levels: every level keeps its column."""
    named = {"en": "a-b", "de": "a b", "fr": "é", "es": "ñ"}
    k = F.lit(None).cast("string")
    for lang, name in named.items():
        k = F.when(F.col("lang") == lang, name).otherwise(k)
    d = td.table(spark, sf_dir, "documents").select("doc_id", k.alias("k"))
    return E.one_hot(d, ["k"], {"k": list(named.values())})


_NUM = ["o_totalprice", "c_acctbal", "c_nationkey"]


@register("min_max", f"""
WITH {td.CENSUS_SQL}
SELECT o_orderkey, {", ".join(f"round(({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()), 6) AS {c}"
                                for c in _NUM)} FROM census
""")
def q_min_max(spark, sf_dir):
    """scale to [0, 1] (one aggregation to fit, one projection)."""
    c = td.census(spark, sf_dir).select("o_orderkey", *_NUM)
    return E.min_max(c, _NUM).select("o_orderkey", *[_r(x) for x in _NUM])


@register("standardise", f"""
WITH {td.CENSUS_SQL}
SELECT o_orderkey, {", ".join(f"round(({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER (), 6) AS {c}"
                                for c in _NUM)} FROM census
""")
def q_standardise(spark, sf_dir):
    """mean 0, population std 1."""
    c = td.census(spark, sf_dir).select("o_orderkey", *_NUM)
    return E.standardise(c, _NUM).select("o_orderkey", *[_r(x) for x in _NUM])


_IMP = ["p_size", "size_band", "decade_code"]


@register("impute_mean", f"""
WITH {CODED_SQL}
SELECT p_partkey, {", ".join(f"round(coalesce(CAST({c} AS DOUBLE), avg({c}) OVER ()), 6) AS {c}" for c in _IMP)}
FROM coded
""")
def q_impute_mean(spark, sf_dir):
    """missing -> mean of the fitted frame."""
    c = coded_population(spark, sf_dir).select("p_partkey", *_IMP)
    return E.impute_mean(c, _IMP).select("p_partkey", *[_r(x) for x in _IMP])


@register("frequency_index", """
WITH v AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang),
r AS (SELECT lang, CAST(row_number() OVER (ORDER BY n DESC, lang) - 1 AS DOUBLE) AS lang_index FROM v)
SELECT doc_id, lang, lang_index FROM documents JOIN r USING (lang)
""")
def q_frequency_index(spark, sf_dir):
    """label -> index by frequency (StringIndexer's frequencyDesc)."""
    d = td.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return E.frequency_index(d, "lang", "lang_index").select("doc_id", "lang", "lang_index")


def prepare_census(df: DataFrame, numeric, skewed, categorical, label="income", positive=">50K",
                   minmax=None, levels=None) -> DataFrame:
    """log1p on skewed columns -> min-max on numeric -> one-hot on
    categoricals -> 0/1 label. ``minmax``/``levels`` are the fitted parts."""
    x = df.withColumns({c: log1p(c) for c in skewed})
    x = E.min_max(x, numeric, minmax)
    x = E.one_hot(x, categorical, levels)
    return x.withColumn(label, contains_flag(label, positive))


@register("prepare_census", f"""
WITH {td.CENSUS_SQL},
l AS (SELECT *, ln(1 + o_totalprice) AS lp FROM census)
SELECT o_orderkey,
  round((lp - min(lp) OVER ()) / (max(lp) OVER () - min(lp) OVER ()), 6) AS o_totalprice,
  {", ".join(f"round(({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()), 6) AS {c}"
             for c in td.CENSUS_NUMERIC if c != "o_totalprice")},
  {_onehot_sql(CENSUS_LEVELS)},
  CAST(contains(income, '>50K') AS INTEGER) AS income
FROM l
""")
def q_prepare_census(spark, sf_dir):
    """F19 composed."""
    c = td.census(spark, sf_dir)
    out = prepare_census(c, td.CENSUS_NUMERIC, td.CENSUS_SKEWED, td.CENSUS_CATEGORICAL)
    return out.select(*[_r(x) if x in td.CENSUS_NUMERIC else F.col(x) for x in out.columns])


def expand_labels(messages: DataFrame, categories: DataFrame, names=None) -> DataFrame:
    """J01 -> split categories into one int column per name
    -> drop the raw column (P02) -> drop duplicate rows (P18).

    Names come from the row with the smallest id (the reference: the first
    row); only that one row is brought to the driver."""
    df = messages.join(categories, "id", "inner")
    if names is None:
        first = categories.orderBy("id").select("categories").first()[0]
        names = [p[:-2] for p in first.split(";")]
    cols = {n: last_char_number(split_part("categories", ";", i)) for i, n in enumerate(names)}
    return dedupe(drop_columns(df.withColumns(cols), ["categories"]))


def label_name_check(categories: DataFrame, names) -> DataFrame:
    """Q13: rows whose category names (in order) differ from ``names``; the
    reference assumed every row has the first row's order."""
    pieces = F.split(F.col("categories"), ";")
    row_names = F.transform(pieces, lambda p: F.substring(p, F.lit(1), F.greatest(F.length(p) - 2, F.lit(0))))
    expected = F.array(*[F.lit(n) for n in names])
    return categories.agg(F.count(F.lit(1)).alias("n_rows"),
                          F.count(F.when(row_names != expected, 1)).alias("n_mismatched"))


@register("label_name_check", f"""
WITH {td.MESSAGES_SQL},
f AS (SELECT categories AS c0 FROM categories ORDER BY id LIMIT 1),
n AS (SELECT list_transform(string_split(categories, ';'), lambda p: substr(p, 1, length(p) - 2)) AS names,
             (SELECT list_transform(string_split(c0, ';'), lambda p: substr(p, 1, length(p) - 2)) FROM f) AS first
      FROM categories)
SELECT count(*) AS n_rows, count(*) FILTER (WHERE names <> first) AS n_mismatched FROM n
""")
def q_label_name_check(spark, sf_dir):
    """Q13: category names verified on every row against the first row's."""
    c = td.categories(spark, sf_dir)
    first = c.orderBy("id").select("categories").first()[0]
    return label_name_check(c, [p[:-2] for p in first.split(";")])


@register("expand_labels", f"""
WITH {td.MESSAGES_SQL}
SELECT DISTINCT m.id, m.message, m.original, m.genre,
  TRY_CAST(right(split_part(c.categories, ';', 1), 1) AS INTEGER) AS quality,
  TRY_CAST(right(split_part(c.categories, ';', 2), 1) AS INTEGER) AS toxic
FROM messages m JOIN categories c ON m.id = c.id
""")
def q_expand_labels(spark, sf_dir):
    """messages with one 0/1 column per category."""
    return expand_labels(td.messages(spark, sf_dir), td.categories(spark, sf_dir))


@register("clean_demographics", f"""
WITH {CODED_SQL},
d AS (SELECT * FROM coded WHERE {" + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in
      ["p_size", "p_retailprice", "p_type", "p_brand", "size_band", "mfgr_side", "decade_code", "cameo"])} <= 1),
top AS (SELECT mfgr_side AS lv0 FROM d GROUP BY mfgr_side ORDER BY count(*) DESC, mfgr_side NULLS FIRST LIMIT 1),
m(code, decade, movement) AS (VALUES {", ".join(f"({k}, {v[0]}, {v[1]})" for k, v in
                                                  DECADE_MOVEMENT.items())})
SELECT p_size, p_retailprice,
  CASE WHEN mfgr_side IS NULL THEN NULL WHEN mfgr_side = top.lv0 THEN 0 ELSE 1 END AS mfgr_side,
  m.decade, m.movement,
  CASE WHEN TRY_CAST(substr(cameo, 1, 1) AS INTEGER) IS NOT NULL AND TRY_CAST(substr(cameo, 2, 1) AS INTEGER) IS NOT NULL
       THEN TRY_CAST(substr(cameo, 1, 1) AS INTEGER) END AS wealth,
  CASE WHEN TRY_CAST(substr(cameo, 1, 1) AS INTEGER) IS NOT NULL AND TRY_CAST(substr(cameo, 2, 1) AS INTEGER) IS NOT NULL
       THEN TRY_CAST(substr(cameo, 2, 1) AS INTEGER) END AS lifestage
FROM d CROSS JOIN top LEFT JOIN m ON d.decade_code = m.code
""")
def q_clean_demographics(spark, sf_dir):
    """F17 composed: codes -> fixed drops -> dense rows -> binary re-encode /
    drop multi-level -> split mixed columns -> drop mixed."""
    out = clean_demographics(td.population(spark, sf_dir), td.demo_meta(spark))
    return out.withColumn("mfgr_side", F.col("mfgr_side").cast("int"))
