"""Session construction and lineage cutting.

The library never hard-codes a cluster path: the checkpoint folder is whatever
the cluster names in ``spark.checkpoint.dir``. Only when that is unset (local
tests) do we pick a scratch folder ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_PACKAGE = os.path.dirname(os.path.abspath(__file__))


def get_spark(master: str | None = None, app: str = "tidemark",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """A session with the settings the operators assume.

    AQE stays on (coalescing small shuffle partitions and splitting skewed
    join partitions at runtime); the UI is off for batch runs.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir). If
    neither is set, a session inside one local process gets a scratch folder
    (its only machine sees it); on a cluster this is an error, since a folder
    on one machine is invisible to the others.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_table_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for a written intermediate."""
    return f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}"


def written_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the shared folder and read back: shared by several
    jobs, whoever runs them and whenever, without keeping blocks on executors."""
    path = scratch_table_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, once per context.

    Needed where the driver found it on a path of its own; called before a
    Python function is built.
    """
    sc = spark.sparkContext
    if getattr(sc, "_tidemark_shipped", False):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-zip-"), "tidemark_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for top, _, names in os.walk(_PACKAGE):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(top, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(_PACKAGE)))
    sc.addPyFile(path)
    sc._tidemark_shipped = True
