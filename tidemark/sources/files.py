"""Readers and writers.

Every reader takes an explicit schema (no inference job, stable columns);
writers state their save mode. Paths may be local, HDFS or object-store URIs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Music-event schema (JSON lines, 18 columns).
MUSIC_EVENT_SCHEMA = T.StructType([
    T.StructField("artist", T.StringType()), T.StructField("auth", T.StringType()),
    T.StructField("firstName", T.StringType()), T.StructField("gender", T.StringType()),
    T.StructField("itemInSession", T.LongType()), T.StructField("lastName", T.StringType()),
    T.StructField("length", T.DoubleType()), T.StructField("level", T.StringType()),
    T.StructField("location", T.StringType()), T.StructField("method", T.StringType()),
    T.StructField("page", T.StringType()), T.StructField("registration", T.LongType()),
    T.StructField("sessionId", T.LongType()), T.StructField("song", T.StringType()),
    T.StructField("status", T.LongType()), T.StructField("ts", T.LongType()),
    T.StructField("userAgent", T.StringType()), T.StructField("userId", T.StringType()),
])


def read_events(spark: SparkSession, path: str, schema: T.StructType = MUSIC_EVENT_SCHEMA,
                fmt: str = "json") -> DataFrame:
    """JSON lines (or parquet) with an explicit schema. ``.bz2``/``.gz``
    inputs are read directly (S06); bzip2 stays splittable."""
    r = spark.read.schema(schema)
    return r.json(path) if fmt == "json" else r.format(fmt).load(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",",
             header: bool = True) -> DataFrame:
    """Delimited text with header and explicit schema."""
    return (spark.read.schema(schema).option("header", header).option("sep", sep)
            .option("mode", "PERMISSIVE").csv(path))


def read_dict_lines(spark: SparkSession, path: str, schema: T.StructType,
                    corrupt_col: str = "_corrupt_record") -> DataFrame:
    """One Python-literal dict per line with ragged keys.

    Lines are read as text. Escaped backslashes and quotes are set aside (as
    control characters, which a literal never holds raw), so the line falls
    into quoted strings and what lies between. Outside strings the Python
    literals ``None/True/False`` are rewritten to JSON; strings become JSON
    strings of the same text. ``from_json`` parses with the explicit schema;
    keys absent on a line come out null, lines that do not parse keep their
    text in ``corrupt_col``."""
    txt = spark.read.text(path)
    aside = F.col("value")
    for escape, mark in (("\\\\", "\u0001"), ("\\'", "\u0002"), ('\\"', "\u0003")):
        aside = F.replace(aside, F.lit(escape), F.lit(mark))

    def rewritten(x):
        literal = F.regexp_replace(F.regexp_replace(F.regexp_replace(
            x, r"\bNone\b", "null"), r"\bTrue\b", "true"), r"\bFalse\b", "false")
        single = F.concat(F.lit('"'), F.replace(F.substr(x, F.lit(2), F.length(x) - 2), F.lit('"'), F.lit('\\"')), F.lit('"'))
        return F.when(F.startswith(x, F.lit("'")) & (F.length(x) > 1), single).when(
            F.startswith(x, F.lit('"')), x).otherwise(literal)

    pieces = F.regexp_extract_all(aside, F.lit(r"""'[^']*+'|"[^"]*+"|[^'"]++|['"]"""), F.lit(0))
    fixed = F.concat_ws("", F.transform(pieces, rewritten))
    for mark, escape in (("\u0001", "\\\\"), ("\u0002", "'"), ("\u0003", '\\"')):
        fixed = F.replace(fixed, F.lit(mark), F.lit(escape))
    with_bad = T.StructType(schema.fields + [T.StructField("__bad", T.StringType())])
    parsed = F.from_json(fixed, with_bad, {"allowSingleQuotes": "true", "mode": "PERMISSIVE",
                                           "columnNameOfCorruptRecord": "__bad"})
    r = txt.select(parsed.alias("r"), F.col("value").alias("_line"))
    return r.select(*[F.col(f"r.{f.name}") for f in schema.fields],
                    F.when(F.col("r.__bad").isNotNull(), F.col("_line")).alias(corrupt_col))


def line_count(spark: SparkSession, path: str) -> int:
    """Number of lines (distributed count, no driver read)."""
    return spark.read.text(path).count()


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A whole catalog table."""
    return spark.table(name)


def save_table(df: DataFrame, name: str, mode: str = "errorifexists", fmt: str = "parquet") -> None:
    """Write a managed table; like the reference it fails if the table
    exists unless ``mode`` says otherwise."""
    df.write.mode(mode).format(fmt).saveAsTable(name)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", sep: str = ",") -> None:
    """CSV with header and no index column."""
    df.write.mode(mode).option("header", True).option("sep", sep).csv(path)


def read_code_map(spark: SparkSession, path: str) -> DataFrame:
    """A whole-file JSON object ``{code: name}`` -> (code, name) rows."""
    txt = spark.read.option("wholetext", True).text(path)
    m = F.from_json("value", T.MapType(T.StringType(), T.StringType()))
    return txt.select(F.explode(m).alias("code", "name"))


def scan_labelled_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """S12 (re-aimed): ``root/<split>/<class>/<file>`` -> (path, split, label,
    content). Class index = sorted label order, via a StringIndexer later."""
    df = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
          .option("recursiveFileLookup", "true").load(root))
    rx = r".*/([^/]+)/([^/]+)/[^/]+$"
    return df.select("path", F.regexp_extract("path", rx, 1).alias("split"),
                     F.regexp_extract("path", rx, 2).alias("label"), "content", "length")


def save_model(model, path: str) -> None:
    """Overwrite the saved model at ``path``."""
    model.write().overwrite().save(path)


def load_model(path: str):
    """Load a saved pipeline model."""
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


def write_partitioned(df: DataFrame, path: str, by: list[str], mode: str = "errorifexists",
                      fmt: str = "parquet") -> None:
    """Write a table partitioned by ``by`` (e.g. event day), so later reads
    that filter on those columns skip whole directories (partition pruning).
    Rows are clustered by the partition columns first, so each task writes
    few files per partition."""
    df.repartition(*by).write.mode(mode).partitionBy(*by).format(fmt).save(path)
