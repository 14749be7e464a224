"""Shared helpers: inputs, tables in the shared folder, checked broadcasts, components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import checkpoint_dir, ship_package

#: One run of ASCII white space (space, tab, LF, VT, FF, CR).
WHITE = r"[\x20\x09-\x0D]+"
#: A side is broadcast only up to this many bytes: its counted rows times their size in a hash table.
BROADCAST_BYTES = 32 * 1024 ** 2


#: Rows of an Arrow batch between the JVM and Python. Texts are long: Spark's default of 10,000 rows is tens of
#: megabytes of text on each side of every running task.
ARROW_ROWS = 500


def prepare(spark: SparkSession) -> None:
    """Make Python functions of this subpackage runnable: package shipped, Arrow batches
    of ``ARROW_ROWS`` rows unless the session has a smaller number."""
    ship_package(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= ARROW_ROWS:
        spark.conf.set(name, str(ARROW_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor costs the reread of a file) and runs
    expensive work once however often the result is used.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> bool:
    """True when all rows of ``df``, at ``row_bytes`` each, stay within ``limit``.

    Meant for written tables, where counting reads only footers.
    """
    return df.count() * row_bytes <= limit


def if_small(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its counted size allows one; otherwise the
    planner's shuffle join (with adaptive skew splitting) is left to work."""
    return F.broadcast(df) if small(df, row_bytes, limit) else df


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each lengthened until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        out.append(n)
        taken.add(n.lower())
    return out


def only(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with just ``columns``, whatever characters their names have."""
    return df.select(*[F.col("`" + c.replace("`", "``") + "`") for c in columns])


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z; every other character stays."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc_mod(doc_id: Column, m: int) -> Column:
    """crc32 of the id written as text, modulo ``m`` (null for a null id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(m)


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.col("v").cast("double"))).first())


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges`` (u, v: long).

    Returns one row per node that has an edge: ``node``, ``root`` (smallest node
    reachable). Alternates the large-star and small-star steps, each an
    aggregate for the smallest neighbour and a join back, so a hub's rows are
    pre-aggregated and its join partition can be split; every round is written
    to the shared folder, and no link reaches the driver.
    """
    e = written(edges.where(F.col("u") != F.col("v"))
                .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before = _state(e)
    while before[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.where(F.col("v") > F.col("u")).join(low, "u")
                 .where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")))
        # the nodes' own minima keep each node tied to what it knew
        large = large.unionByName(low.where(F.col("u") != F.col("m")).select("u", F.col("m").alias("v"))).distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        star = (large.join(low2, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
                .unionByName(low2.select("u", F.col("m").alias("v")))).distinct()
        e = written(star, "links")
        after = _state(e)
        if after == before:
            break
        before = after
    return e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()).groupBy("node").agg(F.min("root").alias("root"))
