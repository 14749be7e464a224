"""Source and sink rows (S01-S06, S08, S09, S12, S13): a given table is written in the
format below the shared folder and read back with the operator."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans.registry import register
from tidemark.session import scratch_table_path
from tidemark.sources import files as S
from tidemark.sources import testdata as td


def _path(spark, name):
    return scratch_table_path(spark, f"sources/{name}-{uuid.uuid4().hex}")


_EVENT = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                       T.StructField("event_type", T.StringType()), T.StructField("value", T.DoubleType()),
                       T.StructField("absent", T.StringType())])
_EVENT_SQL = "SELECT event_id, user_id, event_type, value, CAST(NULL AS VARCHAR) AS absent FROM events"


def _events(spark, sf_dir):
    return td.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")


@register("read_events_json", _EVENT_SQL)
def q_read_events_json(spark, sf_dir):
    """JSON lines with an explicit schema; a field that no line has is null."""
    path = _path(spark, "json")
    _events(spark, sf_dir).write.json(path)
    return S.read_events(spark, path, _EVENT)


@register("read_events_bz2", _EVENT_SQL)
def q_read_events_bz2(spark, sf_dir):
    """The same, compressed."""
    path = _path(spark, "json-bz2")
    _events(spark, sf_dir).write.option("compression", "bzip2").json(path)
    return S.read_events(spark, path, _EVENT)


_ORDER = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                       T.StructField("o_orderstatus", T.StringType()), T.StructField("o_orderpriority", T.StringType())])
_ORDER_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders"


def _csv(spark, sf_dir, sep):
    path = _path(spark, "csv")
    S.write_csv(td.table(spark, sf_dir, "orders").select(*_ORDER.names), path, sep=sep)
    return S.read_csv(spark, path, _ORDER, sep=sep)


@register("csv_comma", _ORDER_SQL)
def q_csv_comma(spark, sf_dir):
    """S02 + S09: CSV with header, written and read with commas."""
    return _csv(spark, sf_dir, ",")


@register("csv_semicolon", _ORDER_SQL)
def q_csv_semicolon(spark, sf_dir):
    """S03 + S09: the same with semicolons."""
    return _csv(spark, sf_dir, ";")


def _literal(c):
    """A string column as a Python literal."""
    quoted = F.replace(F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'")),
                                 F.lit("\n"), F.lit("\\n")), F.lit("\t"), F.lit("\\t"))
    return F.concat(F.lit("'"), quoted, F.lit("'"))


@register("dict_lines", """
SELECT doc_id, 'None of "these" is True, it''s \\' || text AS msg, n_chars % 2 = 0 AS even,
       CASE WHEN doc_id % 3 <> 0 THEN lang END AS lang, CAST(NULL AS VARCHAR) AS _corrupt_record FROM documents
""")
def q_dict_lines(spark, sf_dir):
    """A Python dict per line; literals are rewritten outside strings only, one key is ragged."""
    d = td.table(spark, sf_dir, "documents")
    msg = F.concat(F.lit("None of \"these\" is True, it's \\"), F.col("text"))
    line = F.concat(
        F.lit("{'doc_id': "), F.col("doc_id").cast("string"), F.lit(", 'msg': "), _literal(msg), F.lit(", 'even': "),
        F.when(F.col("n_chars") % 2 == 0, "True").otherwise("False"),
        F.when(F.col("doc_id") % 3 != 0, F.concat(F.lit(", 'lang': "), _literal(F.col("lang"))))
        .otherwise(F.when(F.col("doc_id") % 2 == 0, F.lit(", 'lang': None")).otherwise("")), F.lit("}"))
    path = _path(spark, "dicts")
    d.select(line.alias("value")).write.text(path)
    return S.read_dict_lines(spark, path, T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("msg", T.StringType()),
        T.StructField("even", T.BooleanType()), T.StructField("lang", T.StringType())]))


@register("lines_of_files", "SELECT count(*) AS n_lines FROM events")
def q_lines_of_files(spark, sf_dir):
    """Number of lines of written text."""
    path = _path(spark, "lines")
    _events(spark, sf_dir).select(F.to_json(F.struct("*")).alias("value")).write.text(path)
    return spark.range(1).select(F.lit(S.line_count(spark, path)).cast("long").alias("n_lines"))


@register("catalog_table", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def q_catalog_table(spark, sf_dir):
    """S07 + S08: saved as a catalog table (an existing one is an error) and read whole."""
    name = f"customers_{uuid.uuid4().hex}"
    S.save_table(td.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal"), name)
    return S.read_table(spark, name)


@register("labelled_files", """
SELECT CASE WHEN doc_id % 5 = 0 THEN 'split=test' ELSE 'split=train' END AS split, 'class=' || lang AS label, count(*) AS n_lines
FROM documents GROUP BY ALL
""")
def q_labelled_files(spark, sf_dir):
    """root/split/class/file, label and split from the path."""
    path = _path(spark, "labelled")
    d = td.table(spark, sf_dir, "documents").select(
        F.when(F.col("doc_id") % 5 == 0, "test").otherwise("train").alias("split"), F.col("lang").alias("class"),
        F.col("doc_id").cast("string").alias("value"))
    d.write.partitionBy("split", "class").text(path)
    f = S.scan_labelled_files(spark, path, "*.txt")
    lines = F.size(F.split(F.col("content").cast("string"), "\n")) - 1
    return f.groupBy("split", "label").agg(F.sum(lines).cast("long").alias("n_lines"))


@register("code_map", "SELECT CAST(n_nationkey AS VARCHAR) AS code, n_name AS name FROM nation")
def q_code_map(spark, sf_dir):
    """One JSON object {code: name} as a whole file -> rows."""
    path = _path(spark, "codes")
    pairs = F.collect_list(F.struct(F.col("n_nationkey").cast("string").alias("k"), F.col("n_name").alias("v")))
    td.table(spark, sf_dir, "nation").agg(F.to_json(F.map_from_entries(pairs)).alias("value")).write.text(path)
    return S.read_code_map(spark, f"{path}/*.txt")
